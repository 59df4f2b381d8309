"""Near-duplicate join by chosen paths over minwise tokens.

1. Every whole text becomes its set of word shingles. Equal sets are one class, held by
   its smallest id; only classes are compared.
2. A class has ``SKETCH`` minwise values. In each of ``TREES`` independent trees a class
   walks down by the values at the tree's own random coordinates. A node of at most
   ``LEAF`` classes is compared exhaustively by sketches; a larger one branches on.
   Several levels make one pass (``ROUNDS``): a pass writes each row's nodes at all its
   levels, and the small nodes whose parent is large are the leaves.
3. After a pass that ends at level ``STAR_FROM`` or deeper, members of a node that is still
   large are also linked to the node's smallest id. If all these links hold, the node is
   one component and done; else it branches on. What is left at ``LEVELS`` is completed by
   comparing the members that failed with all members of the node.
4. Pairs are confirmed on the full sets, recomputed from the whole texts. Inside a leaf,
   pairs far above the threshold are emitted as a spanning star only: the components are
   the same, and a group of copies never becomes all its pairs.
5. Components come from rounds of smallest-neighbour labels with pointer jumping.

A pair at similarity s that parts at level d is missed with (1 - s^d)^TREES.

Edge cases: texts without words have the empty set and link with nothing; a text of
fewer words than a shingle is one shingle; rows without id link with nothing; rows that
repeat an id are one document; an empty table gives an empty result; other columns are
not read, and the filter keeps them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from authledger.llm.common import map_texts, remove, stored, texts

TREES, LEVELS, LEAF, SKETCH, STAR_FROM = 16, 24, 16, 96, 4
# Levels that are walked in one pass. A pass writes all its levels, also those below nodes that
# have become small, so that few levels a pass keep the rows of a large group few.
ROUNDS = (range(0, 1), range(1, 4), range(4, 6), range(6, 9), range(9, 12), range(12, 16), range(16, LEVELS))
# Bits that tell which ids a join wants.
SLOTS = 1 << 24
# Distances from the threshold, in similarity, below and above which sketches decide.
BELOW, ABOVE = 0.13, 0.10
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 32, SKETCH, dtype=np.uint32) | np.uint32(1)
_TERMS = _rng.integers(0, 1 << 32, SKETCH, dtype=np.uint32)
_PATHS = np.array([_rng.permutation(SKETCH)[:LEVELS] for _ in range(TREES)])
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    n = len(h) - k + 1
    mixed = np.full(n, k, np.uint64)
    for i in range(k):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + h[i : i + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(mixed)


def sketch(items: np.ndarray) -> np.ndarray:
    """The smallest value of each of ``SKETCH`` hash functions over the set."""
    out = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    short = (items >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 1024):
        part = short[start : start + 1024, None] * _FACTORS
        part += _TERMS
        np.minimum(out, part.min(0), out=out)
    return out


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, sketch, low) of every document; ``low`` has the low byte of each value."""

    def each(ids: list[int | None], batch: list[bytes]) -> dict[str, list]:
        sets = [shingles(text, width) for text in batch]
        drawn = [sketch(s) if len(s) else None for s in sets]
        return {
            "doc_id": ids,
            "n_shingles": [len(s) for s in sets],
            "set_key": [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "sketch": [s if s is None else s.tobytes() for s in drawn],
            "low": [s if s is None else s.astype(np.uint8).tobytes() for s in drawn],
        }

    return map_texts(docs, each, "doc_id bigint, n_shingles bigint, set_key binary, sketch binary, low binary")


def _among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` is in the first column of ``ids``, and some others: an exact join has to follow.

    It spares that join the shuffle of wide rows that it drops. The ids become ``SLOTS`` bits, 2 MB
    whatever their number, so that more ids let more other rows pass, never fewer of their own.
    """
    slot = f"pmod(xxhash64(CAST({{}} AS BIGINT)), {SLOTS})"
    found = ids.selectExpr(f"{slot.format(f'`{ids.columns[0]}`')} AS slot").groupBy(F.expr("shiftright(slot, 15)").alias("chunk"))
    # One aggregate, and so one shuffle: a bitmap of 4 KB for each 32,768 slots.
    chunks = found.agg(F.expr("bitmap_construct_agg(slot & 32767L)").alias("bits"))
    at = slot.format(f"`{column}`")
    byte = f"substring(bits, CAST(shiftright({at} & 32767L, 3) AS INT) + 1, 1)"
    return (
        rows.join(F.broadcast(chunks), F.expr(f"shiftright({at}, 15) = chunk"))
        .filter(f"getbit(CAST(conv(hex({byte}), 16, 10) AS INT), CAST({at} & 7L AS INT)) = 1")
        .select(*[rows[c] for c in rows.columns])
    )


def _nodes(classes: DataFrame, levels: range, active: DataFrame | None) -> DataFrame:
    """(id, tree, level, node, parent) at some levels: from the roots, or from the active nodes down."""
    source, top = classes.select("id", "sketch"), active is None
    if not top:
        source = _among(source, "id", active.select("id")).join(active, "id")
    schema = "id bigint, tree int, level int, node bigint, parent bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH)
            if top:
                at = np.repeat(np.arange(len(ids)), TREES)
                tree = np.tile(np.arange(TREES), len(ids))
                parent = tree.astype(np.uint64)
            else:
                at = np.arange(len(ids))
                tree = batch.column("tree").to_numpy()
                parent = batch.column("node").to_numpy().view(np.uint64)
            for level in levels:
                value = values[at, _PATHS[tree, level]].astype(np.uint64)
                node = ((parent ^ (parent >> np.uint64(31))) * _MIX + value + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[at]), pa.array(tree.astype(np.int32)), pa.array(np.full(len(at), level, np.int32)),
                        pa.array(node.view(np.int64)), pa.array(parent.view(np.int64)),
                    ],
                    names=["id", "tree", "level", "node", "parent"],
                )
                parent = node

    return source.mapInArrow(run, schema)


def _compare(ids: np.ndarray, n: np.ndarray, low: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Candidate pairs of one leaf: a star over what surely links, and every doubtful pair."""
    order = np.argsort(ids)
    ids, n, low = ids[order], n[order], low[order]
    same = (low[:, None, :] == low[None, :, :]).mean(2)
    fits = np.minimum(n[:, None], n[None, :]) >= (least - 1e-9) * np.maximum(n[:, None], n[None, :])
    group = list(range(len(ids)))
    out = []
    sure = np.argwhere(np.triu(fits & (same >= least + ABOVE), 1))
    for i, j in sure:
        if group[i] != group[j]:
            a, b = sorted((group[i], group[j]))
            group = [a if g == b else g for g in group]
            out.append((int(ids[i]), int(ids[j])))
    for i, j in np.argwhere(np.triu(fits & (same >= least - BELOW), 1)):
        if group[i] != group[j]:
            out.append((int(ids[i]), int(ids[j])))
    return out


def _leaf_pairs(leaves: DataFrame, least: float) -> DataFrame:
    """Compare within each small node; rows come sorted by node, a node has ``LEAF`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            done = _leaf_batch(rest, least, last=False)
            rest = rest.slice(done[1])
            yield done[0]
        if rest is not None and rest.num_rows:
            yield _leaf_batch(rest, least, last=True)[0]

    return leaves.repartition("node").sortWithinPartitions("node").mapInArrow(run, "a bigint, b bigint")


def _leaf_batch(rows: pa.Table, least: float, last: bool) -> tuple[pa.RecordBatch, int]:
    node = rows.column("node").to_numpy()
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else []
    ends = [*starts[1:], len(node)]
    ids, n, raw = rows.column("id").to_numpy(), rows.column("n").to_numpy(), rows.column("low").to_pylist()
    pairs: list[tuple[int, int]] = []
    upto = len(starts) if last else max(0, len(starts) - 1)
    for start, end in zip(starts[:upto], ends[:upto], strict=True):
        if end - start > 1:
            low = np.frombuffer(b"".join(raw[start:end]), np.uint8).reshape(-1, SKETCH)
            pairs += _compare(ids[start:end], n[start:end], low, least)
    used = int(ends[upto - 1]) if upto else 0
    a, b = ([p[i] for p in pairs] for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]), used


def member_sets(pairs: DataFrame, docs: DataFrame, width: int) -> tuple[DataFrame, str]:
    """(doc_id, items) of all that the pairs name, from the whole texts; stored, with its folder."""
    members, listed = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "near-members")
    wanted = _among(texts(docs), "doc_id", members).join(members, "doc_id", "left_semi")
    chosen = wanted.groupBy("doc_id").agg(F.min("text").alias("text"))

    def each(ids: list[int | None], batch: list[bytes]) -> dict[str, list]:
        return {"doc_id": ids, "items": [shingles(text, width).view(np.int64).tolist() for text in batch]}

    sets, held = stored(map_texts(chosen, each, "doc_id bigint, items array<bigint>"), "near-sets")
    remove(docs.sparkSession, listed)
    return sets, held


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; ``sets`` has those of all members, if they are there."""
    held = []
    if sets is None:
        sets, folder = member_sets(pairs, docs, width)
        held.append(folder)
    left = _among(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")), "a", pairs.select("a"))
    right = _among(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b")), "b", pairs.select("b"))
    common = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - common
    good = pairs.join(left, "a").join(right, "b").filter(100 * common >= percent * union).select("a", "b")
    good, _ = stored(good, "near-confirmed")
    remove(docs.sparkSession, *held)
    return good


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the links, for every linked id."""
    edges, _ = stored(
        links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.*").distinct(),
        "near-edges",
    )
    labels = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component"))
    labels, _ = stored(labels, "near-labels")
    while True:
        near = (
            edges.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("m"))
        )
        best = labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.col("component").alias("old"), F.least("component", "m").alias("new")
        )
        jump = labels.select(F.col("id").alias("at"), F.col("component").alias("further"))
        step, _ = stored(
            best.join(jump, F.col("new") == F.col("at"), "left").select(
                "id", "old", F.least("new", F.coalesce("further", "new")).alias("component")
            ),
            "near-labels",
        )
        labels = step.select("id", "component")
        if step.filter("component <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    least = percent / 100
    marked, _ = stored(sketches(docs, width), "near-sketches")
    classes, _ = stored(
        marked.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), *(F.first(c).alias(c) for c in ("sketch", "low"))),
        "near-classes",
    )
    found: list[DataFrame] = []
    # Small nodes of all passes; what they hold is compared once, when the last pass is done.
    leaves: list[DataFrame] = []
    links: list[DataFrame] = []
    active = None
    # Folders that the next pass has no use for.
    read: list[str] = []
    kept: list[str] = []
    # Full sets of the members of large nodes. Later passes have the same members or fewer.
    sets: DataFrame | None = None
    for levels in ROUNDS:
        rows, held = stored(_nodes(classes, levels, active), "near-nodes")
        remove(docs.sparkSession, *read)
        read = [held]
        sizes, _ = stored(
            rows.groupBy("node")
            .agg(F.count("*").alias("members"), F.min("id").alias("first"), F.first("level").alias("level"), F.first("parent").alias("parent"))
            .filter("members > 1"),
            "near-sizes",
        )
        large = sizes.filter(F.col("members") > LEAF)
        # Nodes that are small while their parent is still large.
        small = sizes.filter(F.col("members") <= LEAF)
        small = small.filter(F.col("level") == levels[0]).select("node").unionByName(
            small.join(large.select(F.col("node").alias("parent")), "parent", "left_semi").select("node")
        )
        leaf, held_leaf = stored(rows.join(small, "node").select("id", "node"), "near-leaves")
        leaves.append(leaf)
        kept.append(held_leaf)
        last = large.filter(F.col("level") == levels[-1]).select("node", "first")
        if last.isEmpty():
            break
        active = rows.join(last, "node").select("tree", "node", "id", "first")
        if levels[-1] + 1 >= STAR_FROM:
            # The steps below read it several times.
            active, large_held = stored(active, "near-large")
            remove(docs.sparkSession, held)
            read = [large_held]
            star = active.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
            star, star_held = stored(star, "near-star")
            if sets is None:
                sets, sets_held = member_sets(star, docs, width)
                kept.append(sets_held)
            good = confirm(star, docs, width, percent, sets)
            remove(docs.sparkSession, star_held)
            links.append(good)
            failed = active.filter("id <> first").join(
                good.select(F.col("a").alias("first"), F.col("b").alias("id")), ["first", "id"], "left_anti"
            )
            open_nodes, _ = stored(failed.select("node", F.col("id").alias("other")), "near-open")
            if open_nodes.isEmpty():
                break
            if levels is ROUNDS[-1]:
                rest = active.join(open_nodes, "node").filter("id <> other")
                found.append(rest.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")))
                break
            active = active.join(open_nodes.select("node").distinct(), "node")
        active, held = stored(active.select("tree", "node", "id"), "near-active")
        remove(docs.sparkSession, *read)
        read = [held]
    leaf = reduce(DataFrame.union, leaves)
    compared = _among(classes.select("id", "n", "low"), "id", leaf).join(leaf, "id")
    found.append(_leaf_pairs(compared, least))
    pairs, _ = stored(reduce(DataFrame.union, found).distinct(), "near-candidates")
    remove(docs.sparkSession, *kept, *read)
    links.append(confirm(pairs, docs, width, percent))
    joined = components(stored(reduce(DataFrame.union, links).distinct(), "near-links")[0])
    roots = classes.select("set_key", "id").join(joined, "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("root")
    )
    component = F.coalesce("root", "doc_id")
    return marked.drop("sketch", "low").join(roots, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that hold the smallest id of their component, with all their columns."""
    gone = near_duplicates(docs, width, percent).filter("NOT kept").select("doc_id").distinct()
    # Only the id is compared, so that no other column can clash.
    return docs.join(stored(gone, "near-gone")[0], "doc_id", "left_anti").select(*docs.columns)
