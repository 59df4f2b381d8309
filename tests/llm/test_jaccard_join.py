"""The Jaccard join against all pairs, with short and long lists."""

import random
import re

import numpy as np
import pytest

from authledger.llm import jaccard_join

SCHEMA = "doc_id long, text string, key string, size int, pos int, a string, label string"


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows, width, percent):
    """(id, set size, component) of every row, by comparing all distinct sets."""
    sets = [shingle_set(text, width) for _, text in rows]
    nodes = {i: i for i, _ in rows if i is not None}

    def root(i):
        while nodes[i] != i:
            i = nodes[i]
        return i

    holders = {}
    for (i, _), s in zip(rows, sets):
        if i is not None and s:
            holders.setdefault(s, []).append(i)
    listed = list(holders)
    for x, s in enumerate(listed):
        same = [t for t in listed[x:] if 100 * len(s & t) >= percent * len(s | t)]
        for t in same:
            for i in holders[t]:
                low, high = sorted((root(holders[s][0]), root(i)))
                nodes[high] = low
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets)), key=repr)


def corpus(seed):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(3000)]
    for group in range(25):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 5, 40, 120, 300]))
        for _ in range(rng.choice([1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy if rng.random() < 0.8 else [w.upper() for w in copy]))
    # A large group of near copies of one text, and texts around one shared passage.
    base = rng.choices(vocabulary, k=150)
    for _ in range(220):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(150)] = f"edit{rng.randrange(400)}"
        rows.append(" ".join(copy))
    passage = rng.choices(vocabulary, k=60)
    rows += [" ".join([*passage, *rng.choices(vocabulary, k=rng.randint(0, 9))]) for _ in range(90)]
    rows += ["", None, " \n\t", "one", "one two", "ONE two", "x" * 5000, " ".join(vocabulary * 3)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [*zip(ids, rows), (None, rows[0]), (None, None), (ids[3], rows[40]), (ids[5], rows[5]), (ids[7], None)]


def found(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, "k", 1, 2, "a", "l") for i, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in jaccard_join.jaccard_components(docs, **how).collect()), key=repr)


@pytest.mark.parametrize(("width", "percent", "leaf", "group"), [(3, 90, 16, 4096), (3, 90, 2, 50), (5, 80, 0, 4096)])
def test_components_match_all_pairs(spark, monkeypatch, width, percent, leaf, group):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", group)
    rows = corpus(4)
    assert found(spark, rows, width=width, percent=percent) == expected(rows, width, percent)


def test_lists_of_common_tokens_never_meet_in_one_task(spark, monkeypatch):
    """With few counters nearly every token counts as common."""
    monkeypatch.setattr(jaccard_join, "BUCKETS", 8)
    monkeypatch.setattr(jaccard_join, "COMMON", 0)
    monkeypatch.setattr(jaccard_join, "levels_of", lambda counts: (counts % 200).astype(np.uint8))
    counts = jaccard_join.token_counts
    monkeypatch.setattr(jaccard_join, "token_counts", lambda tables: counts(tables) * np.array([90, 1, 90, 1, 90, 90, 1, 90]))
    rows = corpus(7)
    assert found(spark, rows, width=3, percent=90) == expected(rows, 3, 90)


def test_empty_table_and_tables_without_links(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, ""), (None, "a b c")]) == [(1, 0, 1), (2, 0, 2), (None, 1, None)]


def test_skipped_blocks_hold_no_admissible_pair():
    rng = np.random.default_rng(5)
    for _ in range(50):
        size = rng.integers(1, 60, 40)
        pos = (rng.random(40) * (size - (-(-90 * size // 100)) + 1)).astype(int)
        order = np.lexsort((pos, size))
        size, pos = size[order], pos[order]
        x, y = jaccard_join.block_pairs(jaccard_join.admitted_blocks(size, pos, 90))
        want = {
            (i, j) for i in range(40) for j in range(i + 1, 40)
            if min(size[i] - pos[i], size[j] - pos[j]) >= jaccard_join.least_overlap(size[i], size[j], 90)
        }
        assert set(zip(x.tolist(), y.tolist())) == want


def test_derived_answers_join_a_group_like_all_pairs():
    rng = random.Random(6)
    for _ in range(20):
        base = [rng.getrandbits(63) for _ in range(60)]
        sets = []
        for _ in range(40):
            own = set(rng.sample(base, rng.randint(50, 60))) | {rng.getrandbits(6) for _ in range(rng.randint(0, 4))}
            sets.append(np.array(sorted(own), np.uint64))
        keys = [bytes([i]) for i in range(40)]
        links = jaccard_join.group_links(keys, np.arange(40), sets, 90)
        assert len(links) < 40
        wanted = [
            (keys[i], keys[j]) for i in range(40) for j in range(i)
            if 100 * len(set(sets[i]) & set(sets[j])) >= 90 * len(set(sets[i]) | set(sets[j]))
        ]

        def merged(pairs):
            label = {k: k for k in keys}
            for a, b in pairs:
                old, new = label[a], label[b]
                label = {k: new if v == old else v for k, v in label.items()}
            return {frozenset(k for k in keys if label[k] == v) for v in label.values()}

        assert merged(links) == merged(wanted)
        assert set(links) <= {pair for a, b in wanted for pair in ((a, b), (b, a))}


def test_the_driver_gets_each_counter_once_and_few_rows(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i % 40}x{j}" for j in range(30))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    got, collect = [], type(docs).collect

    def counted(df):
        got.append(collect(df))
        return got[-1]

    monkeypatch.setattr(type(docs), "collect", counted)
    marked = jaccard_join.marked_sets(docs, 3).cache()
    counts = jaccard_join.token_counts(marked.filter("counts IS NOT NULL"))
    assert int(counts.sum()) == 4000 * 28
    assert sum(len(r.counts) for r in got.pop()) <= 4 * jaccard_join.BUCKETS
    slots = jaccard_join._marked_slots(docs.select("doc_id"))
    assert int(np.bitwise_count(slots).sum()) > 3900
    assert len(got.pop()) < 400
    marked.unpersist()
