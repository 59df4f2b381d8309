"""Exact Jaccard join of word shingle sets by set-relation skipping.

1. Equal sets are one class. Tokens (shingle hashes) are ordered by an estimate of their
   frequency, rare ones first: a fixed table of ``BUCKETS`` counters over all documents.
   The order decides the speed, never the result.
2. A class stands in the lists of the first tokens of its set, as many as a partner above
   the threshold cannot all miss. Lists are ordered by size and, within a size, by the
   position of the token, which makes blocks of equal (size, position). What is left
   behind a position bounds the overlap, so that one test rules out a whole block and all
   behind it in its size: they are skipped, not read.
3. Lists that have few pairs left for each class (``LEAF``) give those pairs. A parity table of
   each set, whose difference never exceeds that of the sets, rules out most; the others are
   confirmed on the full sets, first one for each class, then those whose classes are
   not in one component yet. Dense lists are cut into groups (size band, then bounded cells)
   that carry the whole texts. In a group the class least far down its list, which is the one with the
   fewest tokens of its own, is compared with all others. A set highly similar to
   it gets its answers from those: |y & z| = |p & z| - |(p - y) & z| + |(y - p) & z|, where
   only the few tokens of the differences are looked up, and only for such z that the
   bound |p & z| + |y - p| still admits and that are not yet in y's component. A
   group gives one link for each class that it joins to another, never all its pairs.
4. Components come from rounds of smallest-neighbour labels. Classes that share an id are joined.

Nothing is dropped or sampled: every pair at or above the threshold shares a list, in which
it is compared unless both are in one component already.

Edge cases: texts without words have the empty set and link with nothing; a text of
fewer words than a shingle is one shingle; rows that repeat an id are one document with the
sets of all its rows (each row has its own ``n_shingles``); rows without id keep a null
component and link with nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_128_digest

from authledger.llm.common import sent, stored, texts
from authledger.llm.near_dedup import components, shingles

BUCKETS = 1 << 20
# Parts of the table of counters, each added up by one task.
SLICES = 64
TABLES = "slice int, counts binary"
# Admitted pairs for each class of a list, on average, up to which the list gives its pairs.
LEAF = 16
# Occurrences, besides four times the mean of a bucket, from which its tokens count as common.
COMMON = 1024
# Bits of the table of wanted documents.
SLOTS = 1 << 24
# A group of a dense list holds about twice as much at most: classes, and MB of sets.
GROUP_ROWS, GROUP_BYTES = 2048, 4 << 20
# Rows that are taken out of an Arrow batch at once.
AT_ONCE = 256


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that long texts do not stand in memory twice."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(start, AT_ONCE)


def marked_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bits, slice, counts); the key is null for an empty set.

    Every task counts all its tokens into one table of ``BUCKETS`` counters, which comes in
    ``SLICES`` more rows at most, with ``slice`` and ``counts`` set and the rest null.
    """
    kinds = {
        "doc_id": pa.int64(), "n_shingles": pa.int64(), "set_key": pa.binary(), "bits": pa.binary(), "slice": pa.int32(), "counts": pa.binary()
    }
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in _slices(batches):
            sizes, keys, bits = [], [], []
            for text in batch.column("text").to_pylist():
                items = shingles(text or b"", width)
                np.add.at(total, _bucket(items), 1)
                sizes.append(len(items))
                keys.append(xxh3_128_digest(items.tobytes()) if len(items) else None)
                bits.append(parity(items) if len(items) else None)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bits, pa.binary())]
            nulls = [pa.nulls(len(sizes), kinds[c]) for c in ("slice", "counts")]
            yield pa.RecordBatch.from_arrays([*columns, *nulls], schema=schema)
        filled = {i: part for i, part in enumerate(np.array_split(total, SLICES)) if part.any()}
        nulls = [pa.nulls(len(filled), kind) for kind in list(kinds.values())[:4]]
        yield pa.RecordBatch.from_arrays([*nulls, *_packed(filled)], schema=schema)

    return texts(docs).mapInArrow(run, f"doc_id bigint, n_shingles bigint, set_key binary, bits binary, {TABLES}")


def _packed(slices: dict[int, np.ndarray]) -> list[pa.Array]:
    """Most counters of one task are 0."""
    raw = [zlib.compress(np.minimum(part, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1) for part in slices.values()]
    return [pa.array(list(slices), pa.int32()), pa.array(raw, pa.binary())]


def token_counts(tables: DataFrame) -> np.ndarray:
    """The counters of all tasks together: each slice is added up by one task, and the driver gets it once."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                slices[i] = slices.get(i, 0) + np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays(_packed(slices), names=["slice", "counts"])

    total = np.zeros(BUCKETS, np.int64)
    parts = np.array_split(total, SLICES)
    for row in tables.repartition("slice").mapInArrow(add, TABLES).collect():
        parts[row.slice][:] += np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return total


def levels_of(counts: np.ndarray) -> np.ndarray:
    """A byte for each bucket, rising with its count."""
    return np.minimum(255, np.round(12 * np.log2(1.0 + counts))).astype(np.uint8)


def _bucket(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(44)).astype(np.int64) % BUCKETS


def ranked(items: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The tokens of a set in the common order, rare ones first."""
    return items[np.lexsort((items, levels[_bucket(items)]))]


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The overlap that two sets of these sizes need."""
    return -(-percent * (a + b) // (100 + percent))


def entries(docs: DataFrame, width: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(token, key, size, pos, common) of the leading tokens of the documents' sets.

    Copies go within a task, before any shuffle. ``common`` marks tokens of buckets so full that
    a list may be too long for one task; those lists never meet in one.
    """
    limit = COMMON + 4 * int(counts.mean())
    get = sent(docs.sparkSession, (levels_of(counts), np.packbits(counts > limit)))
    schema = pa.schema([("token", pa.int64()), ("key", pa.binary()), ("size", pa.int32()), ("pos", pa.int32()), ("common", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, packed = get()
        full = np.unpackbits(packed).astype(bool)
        seen: set[bytes] = set()
        held: list[tuple[np.ndarray, bytes, int]] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            lengths = [len(lead) for lead, _, _ in held]
            token = np.concatenate([lead for lead, _, _ in held])
            arrays = [
                pa.array(token.view(np.int64)),
                pa.array([key for _, key, _ in held], pa.binary()).take(pa.array(np.repeat(np.arange(len(held)), lengths))),
                pa.array(np.repeat([n for _, _, n in held], lengths).astype(np.int32)),
                pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])),
                pa.array(full[_bucket(token)]),
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in _slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                items = shingles(text or b"", width)
                if doc_id is None or not len(items):
                    continue
                key = xxh3_128_digest(items.tobytes())
                if key in seen:
                    continue
                seen.add(key)
                n = len(items)
                held.append((ranked(items, levels)[: n + (-percent * n // 100) + 1], key, n))
                rows += len(held[-1][0])
                if rows >= 16384:
                    yield flush()
                    held, rows = [], 0
        if held:
            yield flush()

    return texts(docs).mapInArrow(run, "token bigint, key binary, size int, pos int, common boolean")


# --- lists -------------------------------------------------------------


def admitted_blocks(size: np.ndarray, pos: np.ndarray, percent: int) -> list[tuple[int, int, int, int]]:
    """(start, end, start, end) of the blocks of a list, in the order of (size, pos), that may pair up.

    For each block of equal (size, position) and each partner size, the admitted blocks are the
    first ones: behind them everything is skipped.
    """
    starts = np.flatnonzero(np.r_[True, (size[1:] != size[:-1]) | (pos[1:] != pos[:-1])])
    ends = np.r_[starts[1:], len(size)]
    out = []
    b_size, b_pos = size[starts], pos[starts]
    for k in range(len(starts)):
        own, at = int(b_size[k]), int(b_pos[k])
        top = np.searchsorted(b_size, 100 * own // percent, "right")
        j = k
        while j < top:
            partner = int(b_size[j])
            need = -(-percent * (own + partner) // (100 + percent))
            over = int(np.searchsorted(b_size, partner, "right"))
            if own - at >= need:
                # Blocks of this size up to the last admitted position.
                stop = j + int(np.searchsorted(b_pos[j:over], partner - need, "right"))
                if stop > j:
                    out.append((int(starts[k]), int(ends[k]), int(starts[j]), int(ends[stop - 1])))
            j = over
    return out


def block_pairs(blocks: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The index pairs x < y of these blocks."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi, other_lo, other_hi in blocks:
        x = np.repeat(np.arange(lo, hi), other_hi - other_lo)
        y = np.tile(np.arange(other_lo, other_hi), hi - lo)
        left.append(x[x < y])
        right.append(y[x < y])
    return np.concatenate(left), np.concatenate(right)


LISTED = "a binary, b binary, token bigint, key binary, size int, pos int"


def read_lists(index: DataFrame, percent: int) -> DataFrame:
    """One pass over the lists: (a, b) of the admitted pairs of thin ones, the entries of dense ones.

    Entries come sorted by token, size, position and key, copies next to each other. Lists
    of one class are passed over. Entries of common tokens are dealt out by class, not by
    token, and pass through without their copies.
    """
    schema = pa.schema([
        ("a", pa.binary()), ("b", pa.binary()), ("token", pa.int64()), ("key", pa.binary()), ("size", pa.int32()), ("pos", pa.int32())
    ])

    def read(table: pa.Table) -> pa.RecordBatch:
        token, size, pos, common = (table.column(c).to_numpy() for c in ("token", "size", "pos", "common"))
        key = table.column("key").to_pylist()
        edge = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        end = np.r_[edge[1:], len(token)]
        a: list[bytes] = []
        b: list[bytes] = []
        long_rows: list[int] = []
        for k in np.flatnonzero((end - edge > 1) | common[edge]).tolist():
            own = list(range(edge[k], end[k]))
            if len({key[i] for i in own}) < len(own):
                first = {}
                for i in own:
                    first.setdefault(key[i], i)
                own = list(first.values())
            if common[own[0]]:
                long_rows += own
            elif len(own) > 1:
                at = np.array(own)
                blocks = admitted_blocks(size[at], pos[at], percent)
                if sum((hi - lo) * (top - low) for lo, hi, low, top in blocks) > LEAF * len(own):
                    # A dense list; who has no admitted partner in it but himself has no part in it.
                    alone = np.ones(len(own), bool)
                    for lo, hi, low, top in blocks:
                        if (lo, hi) != (low, top) or hi - lo > 1:
                            alone[lo:hi] = alone[low:top] = False
                    long_rows += at[~alone].tolist()
                    continue
                for i, j in zip(*(x.tolist() for x in block_pairs(blocks)), strict=True):
                    x, y = key[own[i]], key[own[j]]
                    a.append(min(x, y))
                    b.append(max(x, y))
        n, m = len(a), len(long_rows)
        at = np.array(long_rows, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a + [None] * m, pa.binary()), pa.array(b + [None] * m, pa.binary()),
                pa.array([None] * n + token[at].tolist(), pa.int64()), pa.array([None] * n + [key[i] for i in long_rows], pa.binary()),
                pa.array([None] * n + size[at].tolist(), pa.int32()), pa.array([None] * n + pos[at].tolist(), pa.int32()),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            token = table.column("token").to_numpy()
            cut = int(np.searchsorted(token, token[-1], "left"))
            if cut:
                yield read(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None:
            yield read(rest)

    lane = F.when(F.col("common"), F.xxhash64("key")).otherwise(F.xxhash64("token"))
    dealt = index.repartition(lane).sortWithinPartitions("token", "size", "pos", "key")
    return dealt.mapInArrow(run, LISTED)


# --- dense lists --------------------------------------------------------------


def _cells(long_lists: DataFrame, percent: int) -> DataFrame:
    """(token, band, i, j, own, key, size, pos): the groups that each entry of a long list takes part in.

    Partners' sizes lie in one band or in neighbouring ones, so that an entry stands in
    its own band's group and, as a lower one, in the next. A group beyond the bounds is
    dealt into cells, of which every two meet once.
    """
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9) if percent < 100 else F.col("size")
    banded = long_lists.withColumn("own_band", band.cast("bigint"))
    spread = banded.withColumn("band", F.explode(F.array("own_band", F.col("own_band") + 1)))
    cells = spread.groupBy("token", "band").agg(
        F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(F.sum(F.col("size").cast("bigint") * 8) / GROUP_BYTES)).alias("cells"),
        F.max(F.col("own_band") == F.col("band")).alias("used"),
    ).filter("used")
    dealt = spread.join(cells, ["token", "band"]).withColumn("cell", F.pmod(F.xxhash64("key"), F.col("cells")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1))
    return dealt.withColumn("other", other).select(
        "token", "band", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"), "key", "size", "pos"
    )


def group_links(keys: list[bytes], pos: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that join the classes of a group into its components, each pair compared or derived."""
    m = len(keys)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    token, first = np.unique(flat, return_index=True)
    last = np.r_[first[1:], len(flat)]

    def holders(items: np.ndarray) -> np.ndarray:
        """How many of the items each set of the group holds."""
        at = np.searchsorted(token, items)
        hit = [owner[first[t] : last[t]] for t, v in zip(at, items, strict=True) if t < len(token) and token[t] == v]
        return np.bincount(np.concatenate(hit), minlength=m) if hit else np.zeros(m, np.int64)

    component = np.arange(m)
    links = []

    def join(y: int, z: int) -> None:
        if component[y] != component[z]:
            component[component == component[z]] = component[y]
            links.append((keys[y], keys[z]))

    waiting = np.argsort(pos, kind="stable").tolist()
    while waiting:
        p = waiting[0]
        shared = holders(sets[p])
        for z in np.flatnonzero(shared >= least_overlap(size[p], size, percent)).tolist():
            join(p, z)
        # Sets with few tokens more or fewer than the pivot get their answers from its own.
        near = {z for z in waiting if size[p] + size[z] - 2 * shared[z] <= size[z] // 2} | {p}
        for y in waiting:
            if y == p or y not in near:
                continue
            need = least_overlap(size[y], size, percent)
            open_ = (shared + (size[y] - shared[y]) >= need) & (component != component[y]) & (np.minimum(size[y], size) >= need)
            if open_.any():
                more = np.setdiff1d(sets[y], sets[p], assume_unique=True)
                fewer = np.setdiff1d(sets[p], sets[y], assume_unique=True)
                derived = shared - holders(fewer) + holders(more)
                for z in np.flatnonzero(open_ & (derived >= need)).tolist():
                    join(y, z)
        waiting = [z for z in waiting if z not in near]
    return links


def long_links(long_lists: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) of the links found in the dense lists."""
    grouped = _cells(long_lists, percent).join(members.select("key", "text"), "key")

    def each(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("key")
        sets = [shingles(text, width) for text in group["text"]]
        found = group_links(group["key"].tolist(), group["pos"].to_numpy(), sets, percent)
        return pd.DataFrame(found, columns=["a", "b"])

    return grouped.groupBy("token", "band", "i", "j").applyInPandas(each, "a binary, b binary")


# --- the join ----------------------------------------------------------------


def _marked_slots(ids: DataFrame) -> np.ndarray:
    """A table of ``SLOTS`` bits with those of the ids' hashes set.

    The driver gets its words packed, a row for a batch of them.
    """
    words = (
        ids.select(_slot().alias("slot")).select(F.shiftright("slot", 6).alias("word"), (F.col("slot") % 64).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = [batch.column(c).to_numpy().astype(np.int64).tobytes() for c in ("word", "bits")]
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.binary()) for r in raw], names=["word", "bits"])

    table = np.zeros(SLOTS // 64, np.int64)
    for r in words.mapInArrow(pack, "word binary, bits binary").collect():
        table[np.frombuffer(r.word, np.int64)] = np.frombuffer(r.bits, np.int64)
    return table


def _slot() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))


def member_texts(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(key, text) of the wanted classes, from the documents that stand for them.

    Texts are shorter than their sets and go through the shuffles in their place. A table of
    bits, of a fixed size, spares nearly all other documents the shuffle; those that slip
    through are classes that no pair asks for.
    """
    get = sent(docs.sparkSession, _marked_slots(wanted))
    schema = pa.schema([("key", pa.binary()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = get()
        for batch in _slices(batches):
            slot = batch.column("slot").to_numpy()
            chosen = batch.filter(pa.array((table[slot >> 6] >> (slot & 63)) & 1 == 1))
            found = {}
            for text in chosen.column("text").to_pylist():
                items = shingles(text or b"", width)
                if len(items):
                    found[xxh3_128_digest(items.tobytes())] = text
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], schema=schema)

    made = texts(docs).withColumn("slot", _slot()).mapInArrow(run, "key binary, text binary")
    return made.groupBy("key").agg(F.first("text").alias("text"))


def parity(items: np.ndarray) -> bytes:
    """For each of 2048 slots whether an odd number of tokens falls into it."""
    slots = np.bincount(((items >> np.uint64(20)) & np.uint64(2047)).astype(np.int64), minlength=2048)
    return np.packbits((slots & 1).astype(np.uint8)).tobytes()


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets may differ in few enough tokens: their parity tables differ in no more slots."""
    left, right = (
        classes.select(F.col("key").alias(c), F.col("size").alias(f"size_{c}"), F.col("bits").alias(f"bits_{c}")).hint("merge") for c in "ab"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size_a, size_b = (batch.column(f"size_{c}").to_numpy() for c in "ab")
            bits_a, bits_b = (
                np.frombuffer(b"".join(batch.column(f"bits_{c}").to_pylist()), np.uint64).reshape(-1, 32) for c in "ab"
            )
            differ = np.bitwise_count(bits_a ^ bits_b).sum(1)
            keep = differ <= size_a + size_b - 2 * least_overlap(size_a, size_b, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a binary, b binary")


def confirmed(pairs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity; the sets come from the whole texts."""
    # Both sides grow with the table: never a broadcast, whatever the size.
    sides = [members.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}")).hint("merge") for c in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            keep = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                x, y = shingles(x, width), shingles(y, width)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a binary, b binary")


def links(docs: DataFrame, marked: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) of set keys: links that connect the classes as all links at the threshold would."""
    counts = token_counts(marked.filter("counts IS NOT NULL").select("slice", "counts"))
    classes, _ = stored(
        marked.filter("doc_id IS NOT NULL AND set_key IS NOT NULL").groupBy(F.col("set_key").alias("key")).agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("bits").alias("bits")
        ),
        "join-classes",
    )
    listed, _ = stored(read_lists(entries(docs, width, percent, counts), percent), "join-lists")
    long_lists = listed.filter("key IS NOT NULL").select("token", "key", "size", "pos")
    pairs = listed.filter("a IS NOT NULL").select("a", "b").distinct()
    open_pairs, _ = stored(likely(pairs, classes, percent), "join-likely")
    wanted = (
        open_pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(long_lists.select("key")).distinct()
        .join(classes.select("key", "doc_id"), "key")
    )
    members, _ = stored(member_texts(docs, wanted, width), "join-members")
    # One pair for each class first: what it joins need not be compared any more.
    tree = open_pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    found = confirmed(tree, members, width, percent).unionByName(long_links(long_lists, members, width, percent))
    first, _ = stored(found.distinct(), "join-first")
    label = components(first)
    sides = [label.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"]
    rest = (
        open_pairs.join(tree, ["a", "b"], "left_anti").join(sides[0], "a", "left").join(sides[1], "b", "left")
        .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    )
    return first.unionByName(confirmed(rest, members, width, percent))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    both, _ = stored(marked_sets(docs, width), "join-marked")
    found = links(docs, both, width, percent)
    marked = both.filter("counts IS NULL").drop("slice", "counts", "bits")
    known = marked.filter("doc_id IS NOT NULL AND set_key IS NOT NULL").select("doc_id", "set_key").distinct()
    # An id with several sets joins them.
    together = (
        known.groupBy("doc_id").agg(F.min("set_key").alias("a"), F.count("*").alias("n")).filter("n > 1")
        .join(known, "doc_id").filter("a <> set_key").select("a", F.col("set_key").alias("b"))
    )
    linked, _ = stored(found.unionByName(together).distinct(), "join-links")
    label = components(linked).select(F.col("id").alias("set_key"), F.col("component").alias("label"))
    named = known.join(label, "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    ids = named.join(least, "label").select(F.col("doc_id").alias("id"), "component_id").groupBy("id").agg(
        F.min("component_id").alias("component_id")
    )
    return marked.join(ids, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
