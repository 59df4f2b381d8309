"""Work that the text operators do once instead of once for each word, text or domain."""

import pyarrow as pa

from authledger.llm import mixing, records
from authledger.llm.queries import tokenizer


def test_words_are_looked_up_once_for_all_marks(spark):
    marks = {1: ["abcd", "abcdef", "noise"], 2: ["abce", "toxic", "toxicit"]}
    texts = ["abcd abc abcdefg Noisy noise abce abcf toxi toxicity", "", None, "abc xyz", "ABCDX noises toxicx"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = mixing._words(docs).withColumn("candidates", mixing.candidates(marks))
    got = words.select("doc_id", *mixing.measures(marks))
    for row in got.collect():
        found = (texts[row.doc_id] or "").lower().split()
        for k, keys in marks.items():
            hits = sum(any(w.startswith(key) for key in keys) for w in found)
            assert abs(row[f"marks{k}"] - min(hits * 100 / (len(found) + 16) ** 0.5, 50)) < 1e-9
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(words") == 1


def test_no_marks_leave_no_candidates(spark):
    words = mixing._words(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"))
    assert words.select(mixing.candidates({}).alias("c")).first().c == []
    assert words.withColumn("candidates", mixing.candidates({1: []})).select(*mixing.measures({1: []})).first().marks1 == 0


def test_new_words_of_a_piece_are_learnt_together(monkeypatch):
    file = tokenizer("word_bpe_49k.json")
    single, together = records.Encoder(file), records.Encoder(file)
    single.load()
    together.load()
    asked, learn = [], records.Encoder._learn
    monkeypatch.setattr(records.Encoder, "_learn", lambda self, words: (asked.append(len(words)), learn(self, words))[1])
    batch = [f"word{i} Shared, {i} été! <|endoftext|> ".encode() + b"x" * i for i in range(50)] + [b"", b"\xff bad"]
    got = together.ids_of(batch)
    assert len(asked) == 1
    assert got == [single.ids(text) for text in batch]
    assert together.ids_of(batch) == got and len(asked) == 1 + 51
    # With the memory full, what is forgotten is learnt again.
    monkeypatch.setattr(records.Encoder, "KEPT", 10)
    assert together.ids_of([*batch, b"unseen"])[:-1] == got


def test_words_of_letters_are_asked_for_without_special_tokens():
    encoder = records.Encoder(tokenizer("word_bpe_49k.json"))
    encoder.load()
    library, asked = encoder.tokenizer, []

    class Seen:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **how)

    encoder.tokenizer = Seen()
    batch = ["Plain été, words! İx 字か a,b 3,4 , .,. it's e\u0301t ‑".encode(), b"<|endoftext|>x \xff,\xfe <| more, words"]
    got = [records.np.frombuffer(ids, encoder.kind).tolist() for ids in encoder.ids_of(batch)]
    assert got == [library.encode(t.decode(errors="replace"), add_special_tokens=False).ids for t in batch]
    plain = [t for t in asked if "words" in t]
    assert plain and not any(encoder.between[0] in t for t in plain)


def test_pieces_are_bounded_by_rows_and_bytes():
    texts = [b"x" * 10, None, b"y" * 300, b"", *[b"z"] * 70]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(74)), "text": pa.array(texts, pa.binary())})
    found = list(records.pieces(batch, 64, 200))
    assert [row for piece in found for row in piece] == [(i, t or b"") for i, t in enumerate(texts)]
    assert [len(piece) for piece in found] == [3, 64, 7]


def test_the_memory_of_words_is_asked_once_for_each_word_of_a_piece():
    class Memory(dict):
        asked = 0

        def get(self, word, default=None):
            Memory.asked += 1
            return super().get(word, default)

        def __getitem__(self, word):
            Memory.asked += 1
            return super().__getitem__(word)

    encoder = records.Encoder(tokenizer("word_bpe_49k.json"))
    encoder.load()
    batch = [b" the same words\tagain " * 50, b"", b"\n", "the été".encode()] * 20
    expected = encoder.ids_of(batch)
    assert expected == [encoder.ids(text) for text in batch]
    encoder.known = Memory(encoder.known)
    assert encoder.ids_of(batch) == expected
    assert Memory.asked <= 6


def test_words_of_letters_are_told_apart_by_their_last_tokens():
    encoder = records.Encoder(tokenizer("word_bpe_49k.json"))
    encoder.load()
    library, asked = encoder.tokenizer, []

    class Seen:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **how)

    encoder.tokenizer = Seen()
    words = [f"{w}{x}" for w in ("plain", "unhewnly", "été", "straße", "か") for x in ("", "ing", "tionly")]
    got = encoder.ids_of([" ".join(words).encode()])[0]
    assert records.np.frombuffer(got, encoder.kind).tolist() == library.encode(" ".join(words), add_special_tokens=False).ids
    assert len(asked) == 1 and "," not in asked[0]
    # Without such tokens in the vocabulary a comma stands between them.
    encoder.known, encoder.last = {}, None
    assert encoder.ids_of([" ".join(words).encode()])[0] == got
    assert " , " in asked[-1]
