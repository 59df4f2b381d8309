"""Token ids as length-delimited binary records with an offset index.

A record is: length of the payload (8 bytes), masked checksum of these 8 bytes (4),
payload, masked checksum of the payload (4); all little-endian. The payload is one byte
for the width of an id (2 or 4 bytes, by the vocabulary) and the ids of one document with
the end id. The checksum is CRC-32, rotated right by 15 bits plus a constant, so that
checksums of data that hold checksums stay independent.

Files are written in ascending order of doc_id, one per task, under names that no other
attempt has. The rows that the job returns are the offset index, a Parquet table beside the
records: (doc_id, file number, record, offset, length, tokens before it in the file). A
lost executor costs a rerun of its tasks; files of failed attempts are in no index.

Edge cases: a null or empty text gives the end id alone; rows without id come first;
repeated ids stand together in the order of their texts; an empty table gives no records;
other columns are not read.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc, fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from authledger.llm.common import sent, texts
from authledger.session import scratch_dir

END = 1
_HEAD, _CHECK = 12, 4
INDEX = "doc_id bigint, part int, file string, record bigint, offset bigint, length bigint, before bigint, n_tokens bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def masked(data: bytes) -> int:
    c = crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(record: bytes) -> bytes:
    """The payload; raises ValueError if a length or checksum does not fit."""
    length, check = struct.unpack_from("<QI", record)
    payload = record[_HEAD : _HEAD + length]
    if masked(record[:8]) != check or len(record) != length + _HEAD + _CHECK:
        raise ValueError("damaged length of a record")
    if masked(payload) != struct.unpack_from("<I", record, len(record) - _CHECK)[0]:
        raise ValueError("damaged record")
    return payload


def unpack(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, "<u2" if payload[0] == 2 else "<u4", offset=1).astype("<u4")


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors reach, by its scheme."""
    return (fs.LocalFileSystem(), path.removeprefix("file://")) if path.startswith(("/", "file:///")) else fs.FileSystem.from_uri(path)


def _only_letters(word: bytes) -> bool:
    """Whether a word is letters only, also as the tokenizer sees it: composed and in lower case."""
    if word.isascii():
        return word.isalpha()
    text = word.decode(errors="replace")
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


class Encoder:
    """Ids of whole texts as bytes, word by word from a memory of words.

    The tokenizer drops white space before it looks for tokens, so that none spans any and a
    text's ids are those of its words in a row. Words that are not remembered go to the
    library many at a time, with a special token between them; words that may hold a special
    token themselves go alone. Words of letters have a space or a comma between them instead, which
    is cheaper for the library. Letters with marks behind them are two tokens' worth, whatever the
    case of the letters. When the memory is full, what has not been met since it was full the last
    time is forgotten, which costs time only. The memory is asked once for each distinct word of
    some texts; Arrow numbers the words, and the ids of the texts are gathered by these numbers.
    """

    KEPT, AT_ONCE = 700_000, 2048
    MARKS = b".,!?;:"

    def __init__(self, tokenizer_file: str):
        self.file, self.tokenizer, self.known, self.older = tokenizer_file, None, {}, {}

    def __getstate__(self) -> dict:
        return {"file": self.file, "tokenizer": None, "known": {}, "older": {}}

    def load(self) -> None:
        if self.tokenizer is not None:
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "<u2" if self.width == 2 else "<u4"
        special = sorted((t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)
        self.between = special[0] if special else None
        self.starts = {name[:2].encode() for name, _ in special}
        first, comma, both = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("a", ",", "a , a"))
        # A comma that is one token of its own: no token of letters holds it.
        self.comma = comma[0] if len(comma) == 1 and both == first + comma + first else None
        # Tokens that only the end of a piece can have, where the vocabulary marks them.
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = None
        if suffix:
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _learn(self, words: set[bytes]) -> None:
        """Remember these words: those of letters by their lower case and their marks."""
        known, older, parts, plain, need = self.known, self.older, [], set(), set()
        for w in words:
            before = older.get(w)
            if before is not None:
                known[w] = before
                continue
            letters = w.rstrip(self.MARKS).lower()
            if not (letters.isalpha() if letters.isascii() else _only_letters(letters)):
                need.add(w)
                continue
            marks = w[len(letters) :]
            if letters not in known:
                if letters in older:
                    known[letters] = older[letters]
                else:
                    plain.add(letters)
            if marks and marks not in known:
                need.add(marks)
            if letters != w:
                parts.append((w, letters, marks))
        if self.comma is None:
            need |= plain
        else:
            self._ask_letters(list(plain))
        self._ask(list(need))
        for w, letters, marks in parts:
            known[w] = known[letters] + known[marks] if marks else known[letters]

    def _alone(self, words: list[bytes]) -> list[bytes]:
        """The words that may hold a special token."""
        if self.between is None:
            return words
        together = b" ".join(words)
        starts = [s for s in self.starts if s in together]
        return [w for w in words if any(s in w for s in starts)] if starts else []

    def _ask(self, words: list[bytes]) -> None:
        alone = self._alone(words)
        for w, found in zip(alone, self.tokenizer.encode_batch_fast([w.decode(errors="replace") for w in alone], add_special_tokens=False), strict=True):
            self.known[w] = np.array(found.ids, self.kind).tobytes()
        if self.between is not None:
            self._ask_together(list(set(words).difference(alone)) if alone else words, *self.between)

    def _ask_letters(self, words: list[bytes]) -> None:
        """Ask for words of letters: by the tokens that end a word, where each has one such token."""
        known, width = self.known, self.width
        for start in range(0, len(words), self.AT_ONCE):
            part = words[start : start + self.AT_ONCE]
            ends = []
            if self.last is not None:
                ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode(errors="replace")], add_special_tokens=False)[0].ids, self.kind)
                ends = ((np.flatnonzero(self.last[ids]) + 1) * width).tolist()
            # A word has one such token at least, so that with as many as words each has its own.
            if len(ends) != len(part):
                self._ask_together(part, " , ", self.comma)
                continue
            data, first = ids.tobytes(), 0
            for w, end in zip(part, ends, strict=True):
                known[w] = data[first:end]
                first = end

    def _ask_together(self, words: list[bytes], between: str, mark: int) -> None:
        """Ask for words in which the token ``mark``, which is what ``between`` gives, cannot occur."""
        known, width = self.known, self.width
        for start in range(0, len(words), self.AT_ONCE):
            part = words[start : start + self.AT_ONCE]
            # What stands between is ASCII, so that no damaged character reaches over it.
            joined = between.encode().join(part).decode(errors="replace")
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
            data, marked = ids.tobytes(), np.flatnonzero(ids == mark) * width
            if len(marked) + 1 != len(part):
                raise ValueError("words and their ids do not match")
            first = 0
            for w, end in zip(part, [*marked.tolist(), len(data)], strict=True):
                known[w] = data[first:end]
                first = end + width

    def ids(self, text: bytes) -> bytes:
        return self.ids_of([text])[0]

    def ids_of(self, batch: list[bytes]) -> list[bytes]:
        """Ids of some texts; the words that are new in any of them are learnt together."""
        # ASCII white space only: what else counts as space is the tokenizer's affair.
        raw = pa.array(batch, pa.large_binary())
        lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(raw), raw.buffers()))
        numbered = lists.values.dictionary_encode()
        words = numbered.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        # What stands before the first and behind the last white space may be empty.
        self.known[b""] = b""
        found = list(map(self.known.get, words))
        if None in found:
            new = {w for w, ids in zip(words, found, strict=True) if ids is None}
            if len(self.known) > self.KEPT:
                self.known, self.older = {b"": b""}, self.known
                new = set(words).difference(self.known)
            self._learn(new)
            found = list(map(self.known.__getitem__, words))
        pool = np.frombuffer(b"".join(found), self.kind)
        n = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        at, number = np.cumsum(n) - n, numbered.indices.to_numpy()
        each = n[number]
        ends = np.cumsum(each)
        ids = pool[np.repeat(at[number] - ends + each, each) + np.arange(len(number) and ends[-1])].tobytes()
        bounds = (np.r_[0, ends][lists.offsets.to_numpy()] * self.width).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


def pieces(batch: pa.RecordBatch, rows: int = 1024, size: int = 4 << 20) -> Iterator[list[tuple[int | None, bytes]]]:
    """(doc_id, text) in runs of at most ``rows`` rows; a run ends with the text that brings it to ``size`` bytes."""
    run, held = [], 0
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
            run.append((doc_id, text or b""))
            held += len(text or b"")
            if len(run) == rows or held >= size:
                yield run
                run, held = [], 0
    if run:
        yield run


def write_records(docs: DataFrame, tokenizer_file: str, folder: str) -> DataFrame:
    """Write all records and their index below ``folder``; returns the index."""
    spark = docs.sparkSession
    shared = sent(spark, Encoder(tokenizer_file))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        # The memory of words lasts as long as the worker.
        encoder = shared()
        encoder.load()
        width, end = encoder.width, np.array([END], encoder.kind).tobytes()
        system, root = place(folder)
        name = f"part-{part:05d}-{uuid.uuid4().hex}.records"
        system.create_dir(f"{root}/records", recursive=True)
        offset = before = record = 0
        kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 5]
        names = [f.split()[0] for f in INDEX.split(", ")]
        with system.open_output_stream(f"{root}/records/{name}") as out:
            for batch in batches:
                for piece in pieces(batch):
                    rows = []
                    encoded = encoder.ids_of([text for _, text in piece])
                    for (doc_id, _), found in zip(piece, encoded, strict=True):
                        ids = found + end
                        data = frame(bytes([width]) + ids)
                        out.write(data)
                        n = len(ids) // width
                        rows.append((doc_id, part, name, record, offset, len(data), before, n))
                        record, offset, before = record + 1, offset + len(data), before + n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                    )

    ordered = texts(docs).repartitionByRange("doc_id", F.crc32("text")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files, whatever the order of the index rows."""
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("tokens"))
    offsets = files.select(
        "file", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("file_start")
    )
    rows = index.join(offsets, "file").select(
        "doc_id", "file", "offset", "length", (F.col("before") + F.col("file_start")).alias("start"), "n_tokens"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        name, source = None, None
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
            for row in batch.to_pylist():
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = row["file"], system.open_input_file(f"{root}/records/{row['file']}")
                source.seek(row["offset"])
                ids = unpack(unframe(source.read(row["length"])))
                if len(ids) != row["n_tokens"]:
                    raise ValueError(f"index and record differ in {name}")
                out["doc_id"].append(row["doc_id"])
                out["start"].append(row["start"])
                out["n_tokens"].append(len(ids))
                out["ids_crc32"].append(crc32(ids.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out.values()], names=list(out))
        if source is not None:
            source.close()

    return rows.mapInArrow(read, ROWS)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer_file: str) -> DataFrame:
    folder = scratch_dir(spark, "records")
    return read_records(write_records(docs, tokenizer_file, folder), folder)
