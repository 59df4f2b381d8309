"""Corpus operators on small tables: exact results, round trips and odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from authledger.llm import (
    decontamination, mixing, near_dedup, quality_crf, quality_rules, records, secret_scan, sharding,
    token_counts, toxicity,
)
from authledger.llm.queries import tokenizer

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, cell int"
PLAIN = "the river runs past the old mill and the road climbs slowly to the village on the hill"


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, copies, repeated ids, and columns with clashing names."""
    rows = [
        (1, words(40, "a")), (2, words(40, "a").upper()), (3, words(39, "a") + " changed"), (4, ""), (5, None),
        (6, " \n\t "), (7, "one two"), (8, "One TWO"), (9, words(3000, "long")), (None, PLAIN), (10, PLAIN),
        (10, PLAIN), (11, "x" * 20000), (12, "nul \x00 é 日本 ▁  end "),
    ]
    return spark.createDataFrame([(i, t, None, None, None, 1.0, 2, 3) for i, t in rows], COLUMNS)


@pytest.fixture(scope="module")
def clashing(odd):
    """The odd rows with columns named like those the operators make."""
    names = ["gone_id", "mix_id", "mix_copies", "mix_row", "component_id", "kept", "label", "weight", "copies", "id"]
    return odd.withColumns({name: F.lit(1) for name in names})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, i % 3 == 0) for i in range(1, 13)]
    return spark.createDataFrame([(i, q, int(t)) for i, q, t in rows], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PLAIN), (2, "one two"), (3, ""), (4, None), (None, PLAIN), (2, "one two")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_odd_rows_and_empty_tables_run_everywhere(odd, labels, benchmark):
    piece, word = tokenizer("piece_bpe_32k.model"), tokenizer("word_bpe_49k.json")
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        for found in (
            quality_crf.quality_crf(docs, labels),
            records.round_trip(docs.sparkSession, docs, word),
            toxicity.toxicity(docs, labels),
            decontamination.contamination(docs, benchmark),
            token_counts.token_counts(docs, piece),
            near_dedup.near_duplicates(docs, 3, 85),
            sharding.shard_documents(docs),
            quality_rules.quality_rules(docs, labels),
            mixing.mixing_rates(docs, labels),
        ):
            assert found.count() == n
        assert secret_scan.secret_scan(docs).count() >= 0
        mixed = mixing.mix(docs, labels)
        assert mixed.columns == docs.columns


def test_components_match_brute_force(odd):
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(odd, 3, 85).collect()}
    assert {(1, 38, 1, True), (2, 38, 1, False), (3, 38, 1, False), (7, 1, 7, True), (8, 1, 7, False)} <= found
    assert {(4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True)} <= found


def test_large_group_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[: i % 190], f"edit{i}", *base[i % 190 + 1 :]])) for i in range(300)]
    rows += [(1000 + i, words(60, f"other{i}x")) for i in range(50)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.component_id for r in found if r.doc_id < 1000} == {0}
    assert all(r.kept for r in found if r.doc_id >= 1000)


def test_links_to_the_smallest_of_a_large_node_are_joined_once(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[: i % 190], f"edit{i}", *base[i % 190 + 1 :]])) for i in range(100)]
    plans, confirm = [], near_dedup.confirm

    def seen(pairs, *args):
        plans.append(pairs._jdf.queryExecution().optimizedPlan().toString())
        return confirm(pairs, *args)

    monkeypatch.setattr(near_dedup, "confirm", seen)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.component_id for r in found} == {0}
    assert len(plans) > 1 and not any("Join" in plan for plan in plans)


def test_only_texts_that_may_be_wanted_are_shuffled(spark):
    rows = spark.range(20000).selectExpr("CAST(id AS INT) AS doc_id", "concat('t', id) AS text").unionByName(
        spark.createDataFrame([(None, "none"), (7, "again")], "doc_id int, text string")
    )
    ids = spark.createDataFrame([(i,) for i in range(0, 20000, 40)] + [(7,), (99999,)], "id bigint")
    among = near_dedup._among(rows, "doc_id", ids)
    assert among.columns == rows.columns
    got = [tuple(r) for r in among.collect()]
    assert {(i, f"t{i}") for i in range(0, 20000, 40)} | {(7, "t7"), (7, "again")} <= set(got)
    assert len(got) < 600
    assert near_dedup._among(rows, "doc_id", ids.filter("id < 0")).isEmpty()


def test_leaves_are_compared_by_the_low_bytes_alone(spark, monkeypatch):
    columns, compare = [], near_dedup._leaf_pairs
    monkeypatch.setattr(near_dedup, "_leaf_pairs", lambda leaves, least: (columns.append(set(leaves.columns)), compare(leaves, least))[1])
    rows = [(i, words(60, "w") + f" end{i}") for i in range(5)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.component_id for r in found} == {0}
    assert columns and all(c == {"id", "node", "n", "low"} for c in columns)


def test_hits_match_brute_force():
    match = decontamination.Matcher([(1, PLAIN.encode()), (2, b"one two")])
    text = ("Intro, ONE-Two; " + PLAIN.title() + "! one. tw").encode()
    listed = decontamination.words_of(text)
    want = set()
    for window in match.windows:
        part = window.split()
        for i in range(len(listed) - len(part) + 1):
            if listed[i : i + len(part)] == part:
                want |= set(range(i, i + len(part)))
    n, hit, items = match.scan(text)
    assert (n, set(hit.tolist()), items) == (len(listed), want, {1, 2})
    assert [text[a:b] for a, b in match.spans(text)] == [b"ONE-Two; " + PLAIN.title().encode()]


def test_prefix_counts_match_the_library():
    counter = token_counts.Counter(tokenizer("piece_bpe_32k.model"))
    for text in (PLAIN, "", " ", "a  b ", "é▁日 <s> x\n\ny", "  two  "):
        ends, counts = counter.prefixes(text)
        assert counts[-1] == len(counter.model.encode(text))
        assert all(c == len(counter.model.encode(text[:e])) for e, c in zip(ends[1:], counts[1:], strict=True) if e > 0)
    assert len(counter.model.encode(counter.longest_prefix(PLAIN, 7))) <= 7


def test_records_hold_every_id_and_show_damage(spark, odd):
    import numpy as np
    from tokenizers import Tokenizer
    from zlib import crc32

    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = records.round_trip(spark, odd.filter("doc_id IS NOT NULL"), path).orderBy("start").collect()
    start = 0
    texts = sorted((r.doc_id, r.text or "") for r in odd.filter("doc_id IS NOT NULL").collect())
    for row, (doc_id, text) in zip(got, texts, strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), crc32(ids.tobytes()))
        start += len(ids)
    damaged = bytearray(records.frame(b"payload"))
    damaged[13] ^= 1
    with pytest.raises(ValueError):
        records.unframe(bytes(damaged))


def test_shards_are_level_and_slots_gapless(spark):
    docs = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.shard_documents(docs, 16).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} == {62, 63}


def test_one_more_shard_moves_few_rows():
    counts = dict.fromkeys(range(0, sharding.CELLS, 8), 100)
    homes = [
        {(c, i): s for c, a, b, s, _ in sharding.place(counts, n) for i in range(a, b)} for n in (16, 17)
    ]
    moved = sum(homes[0][k] != homes[1][k] for k in homes[0]) / len(homes[0])
    assert moved < 0.5


def closest_rates(p, tokens, goal, least, rounds=20000):
    """The rates nearest to 1 that reach the totals, by alternating projections with corrections."""
    import numpy as np

    weighted = p * tokens[:, None]
    inverse = np.linalg.inv(weighted.T @ p)
    rate, fix = np.ones(len(p)), np.zeros(len(p))
    for _ in range(rounds):
        even = rate + p @ (inverse @ (goal - weighted.T @ rate))
        rate = np.maximum(least, even + fix)
        fix = even + fix - rate
    return rate


def test_rates_match_a_dense_solver_and_every_target(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    p = rng.dirichlet([2, 0.6, 0.4], 80)
    tokens = rng.integers(1, 400, 80)
    rows = [(i, int(t), *map(float, q)) for i, (t, q) in enumerate(zip(tokens, p))]
    members = spark.createDataFrame(rows, "doc_id long, tokens long, p0 double, p1 double, p2 double")
    for targets, budget, least in (({"clean": 0.9, "low": 0.08, "toxic": 0.02}, 1.0, 0.0), ({"clean": 0.78, "low": 0.15, "toxic": 0.07}, 1.0, 0.3)):
        rate, totals, miss = mixing.rates(members, targets, budget, least)
        assert miss <= 1e-6 and all(abs(got - goal) <= 0.01 * goal for got, goal in totals.values())
        got = np.array([r.rate for r in members.select("doc_id", rate.alias("rate")).orderBy("doc_id").collect()])
        q = p[:, : len(targets)]
        want = closest_rates(q, tokens, np.array([totals[d][1] for d in targets]), least)
        assert np.abs(got - want).max() < 1e-3
        assert (got >= least).all() and (got == least).any()


def test_targets_out_of_reach_are_reported(spark):
    members = spark.createDataFrame([(1, 10, 0.5, 0.5, 0.0), (2, 10, 0.5, 0.5, 0.0)], "doc_id long, tokens long, p0 double, p1 double, p2 double")
    _, totals, miss = mixing.rates(members, {"clean": 0.9, "low": 0.1}, 1.0)
    assert miss > 0.1 and abs(sum(t for t, _ in totals.values()) - 20) < 20


def test_mixing_keeps_clean_documents_and_reaches_each_target(spark, sample):
    folder = sample.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = mixing.mixing_rates(docs, labels)
    row = found.agg(F.max("miss"), *(F.sum(F.col("tokens") * F.col("rate") * F.col(f"p_{d}")).alias(d) for d in mixing.DOMAINS)).first()
    total = sum(row[d] for d in mixing.DOMAINS)
    assert row[0] <= 1e-5
    for domain, share in mixing.TARGETS.items():
        assert abs(row[domain] / total - share) <= 0.01 * share
    kept = mixing.mix(docs, labels)
    assert kept.columns == docs.columns
    clean = found.filter("p_clean > p_low AND p_clean > p_toxic").select("doc_id")
    assert clean.exceptAll(kept.select("doc_id").distinct()).count() == 0
    # Held-out rows: the domain of most is the likeliest one.
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("clean")
    best = F.when((F.col("p_clean") >= F.col("p_low")) & (F.col("p_clean") >= F.col("p_toxic")), "clean").when(
        F.col("p_low") >= F.col("p_toxic"), "low"
    ).otherwise("toxic")
    rows = found.join(labels, "doc_id").filter("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    assert rows.filter(domain == best).count() >= 0.9 * rows.count()


def test_clashing_names_do_not_matter(clashing, labels):
    assert mixing.mix(clashing, labels).columns == clashing.columns
    left = near_dedup.drop_near_duplicates(clashing, 3, 85)
    assert left.columns == clashing.columns and left.count() == clashing.count() - 3
    assert toxicity.drop_toxic(clashing, labels).columns == clashing.columns


def test_empty_labels_and_benchmark(odd, labels, benchmark):
    none = labels.limit(0)
    for found in (
        quality_crf.quality_crf(odd, none), toxicity.toxicity(odd, none), quality_rules.quality_rules(odd, none),
        mixing.mixing_rates(odd, none), decontamination.contamination(odd, benchmark.limit(0)),
    ):
        assert found.count() == odd.count()


def test_secrets_are_found_and_numbers_are_not(spark):
    key = "9f" * 20
    rows = [(i, f'the value token = "{i:04x}{key[4:]}" ends') for i in range(40)]
    rows += [(100 + i, f"call {4785380592391139 + i} now") for i in range(40)]
    found = secret_scan.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found if r.is_secret} == set(range(40))
    assert all(rows[r.doc_id][1][r.start :].startswith(r.value) for r in found if r.is_secret)


def test_held_out_quality(spark, sample):
    docs, labels = (
        spark.read.parquet(f"{sample.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels")
    )
    for found, verdict in ((quality_crf.quality_crf(docs, labels), "predicted"), (quality_rules.quality_rules(docs, labels), "score >= 0.5")):
        rows = found.join(labels, "doc_id").filter("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
        right = rows.filter(f"cast({verdict} as int) = quality").count()
        assert right >= 0.95 * rows.count()


def test_base_counts_match_plain_counting():
    text = "a b c a b c\n\nline # x\nline # x\n é|"
    listed = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(listed[i : i + 3]) for i in range(len(listed) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    raw = text.encode()
    assert quality_rules.base_counts(raw, raw.split()) == (len(listed), sum(map(len, listed)), 3, 1, len(covered))


def test_held_out_toxicity_in_every_language(spark, sample):
    """Rows that were never learnt from: found, and clean ones left alone."""
    folder = sample.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    found = toxicity.toxicity(labelled, labels).filter("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.groupBy("lang", "toxic").agg(F.avg("predicted").alias("share"), F.count("*").alias("n")).collect()
    assert {(r.lang, r.toxic) for r in rows} == {(lang, t) for lang in ("en", "de", "fr", "es") for t in (0, 1)}
    for r in rows:
        assert r.share >= 0.85 if r.toxic else r.share <= 0.03, r


def test_label_model_matches_enumerated_posteriors():
    """Independent voters of known accuracy: the estimate comes near Bayes' rule, and silence is no evidence."""
    import numpy as np

    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.2
    on, off = np.array([0.5, 0.4, 0.3, 0.6]), np.array([0.02, 0.05, 0.03, 0.04])
    votes = np.where(y[:, None], rng.random((6000, 4)) < on, rng.random((6000, 4)) < off)
    label = np.where(np.arange(6000) < 3000, y.astype(float), np.nan)
    got = toxicity.label_model(votes, label, 0.2)
    assert (got[:3000] == y[:3000]).all()
    logit = np.log(0.2 / 0.8) + votes @ np.log(on / off)
    exact = 1 / (1 + np.exp(-logit))
    rest = slice(3000, None)
    assert np.abs(got[rest] - exact[rest]).mean() < 0.05
    assert np.allclose(got[rest][~votes[rest].any(1)], 0.2, atol=1e-6)


def test_copies_of_a_voter_count_once():
    import numpy as np

    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.2
    one = np.where(y, rng.random(4000) < 0.4, rng.random(4000) < 0.1)
    label = np.where(np.arange(4000) < 2000, y.astype(float), np.nan)
    alone = toxicity.label_model(one[:, None], label, 0.2)
    tenfold = toxicity.label_model(np.repeat(one[:, None], 10, axis=1), label, 0.2)
    assert np.abs(alone - tenfold).max() < 0.1


def test_stems_group_what_begins_alike():
    gain = {"idio": 9.0, "idiot": 10.0, "idiot|": 8.0, "scum|": 5.0, "scum": 4.0, "lowei": 3.0, "lowe": 2.0}
    assert toxicity.stems(gain) == ["idiot", "lowei", "scum"]


def test_odd_words_encode_like_the_library():
    import random

    import numpy as np
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), records.Encoder(path)
    encoder.load()
    rng = random.Random(8)
    parts = [
        "a", "Word", "\u03a3", "e\u0301", "\u0301", "\u0130", "\u0958", "\u00a0", "\u2028", "\x1c", "\x85", " ", " ", "'s", "'", "\u00df", "1", "\u00bd",
        "<|endoftext|>", "<|start", "!", "...", "\u65e5\u672c", "\t", "\n", "\x00", "\ufeff", "\U0001f44d\U0001f3fd",
    ]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        ids = np.frombuffer(encoder.ids(text.encode()), encoder.kind).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_pipeline_stages_decide_what_goes_on(spark, sample):
    """Each stage against its own input: nothing but what it decides is lost, and copies go."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sample}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        made = spark.createDataFrame(stage(spark, docs, sample).toPandas())
        after = {r.doc_id for r in made.select("doc_id").collect()}
        assert after <= before
        if name == "sharding":
            assert made.count() == docs.count()
            break
        assert made.columns == columns
        if name == "near_dedup":
            assert after == {r.doc_id for r in near_dedup.near_duplicates(docs, 5, 80).filter("kept").collect()}
        if name == "decontamination":
            hit = decontamination.contamination(docs, spark.read.parquet(f"{sample}/benchmark.parquet")).filter("contaminated")
            assert before - after == {r.doc_id for r in hit.collect()}
        docs = made
    whole = corpus_pipeline.run(spark, sample)
    assert whole.count() == made.count() and {r.doc_id for r in whole.collect()} == after


def test_near_duplicates_reads_the_texts_of_large_nodes_once(spark, monkeypatch):
    import random

    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(400), i % 12):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    seen, compared, made, compare = [], [], near_dedup.map_texts, near_dedup._leaf_pairs
    monkeypatch.setattr(near_dedup, "map_texts", lambda docs, each, schema: (seen.append(schema), made(docs, each, schema))[1])
    monkeypatch.setattr(near_dedup, "_leaf_pairs", lambda leaves, least: (compared.append(1), compare(leaves, least))[1])
    monkeypatch.setattr(near_dedup, "LEAF", 2)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    sets = {i: set(near_dedup.shingles(text.encode(), 3).tolist()) for i, text in rows}
    root = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    assert {r.doc_id: r.component_id for r in found} == root
    # Sketches, sets of the members of large nodes, sets of the candidates; the leaves of all passes together.
    assert len(seen) == 3 and len(compared) == 1
