"""Cheapest repair of damaged conversations by the auction shortest-path algorithm.

A conversation's rows, in order, span a lattice: a layer before every row, and in each
layer four states of the pattern ``(s?(ua)+)?`` (nothing yet, after a system turn, after a
user turn, after an assistant turn). Arcs are edits with whole costs: K keep (0), R give the
role that the state asks for (2), D delete (3), I insert an empty turn of that role (2); a
row that is kept or rerolled although it is cut off costs 1 more; blank and duplicate
rows can only go. A letter and a state determine the next state.

Every node has a price, at first a lower bound of the cost to the end, and prices never
exceed any arc's cost plus the price behind it. The auction grows a path from
the entry: if the end node's price is below its best arc, the price rises to it and the
path contracts; else the path extends along the best arc, the least letter among equals.
When the path arrives, all arcs of every cheapest path are tight, so that the path
is the cheapest edit sequence and the first of the cheapest in ASCII order. Long conversations
are priced backwards in blocks of ``BLOCK`` layers: the converged prices of the four
states at a block's start are the end prices of the block before it.

No task ever holds a conversation that is larger than ``PIECE_BYTES`` or that
reaches over a border of the range partitioning: its pieces are priced each on its own
(a 4 x 4 cost matrix), the small lattice of pieces is auctioned on the driver (at most
two pieces a task, and one for each ``PIECE_BYTES``), and the pieces are traced side by side. The
SHA-256 of such a conversation runs over its pieces one after another, as it must.

Defined results: rows of one turn come in the order of role, then of text; copies of a row
are counted, not repeated. Nulls in role and text are one space, so that such texts are
blank; null turns come first and count for no gap; rows of null ``conv_id`` are one
conversation. An empty role, or one with another initial, cannot be kept. A conversation
that lost all rows has zeros and an empty audit. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from authledger.llm.common import stored

BLANK = " \t\n\x0b\x0c\r"
BLOCK, PIECE_BYTES = 64, 32 << 20
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
# Cost and letters that end a conversation from each state.
END = (0, 4, 2, 0)
# Codes of a row: 0 only goes; else initial (1 s, 2 u, 3 a, 4 other), 4 more when cut off.
KEPT = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}
FAR = 1 << 60


# --- damage and faults, in DataFrame operations ------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage of the exercise, decided by a hash of id and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, text = F.col("kind"), F.coalesce("text", space)
    return (
        conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text", (F.crc32(key.cast("binary")) % 20).alias("kind"))
        .filter(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def judged(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies: (conv_id, turn, role, text, copies, code, forced).

    ``code`` is 0 for a row of which every copy must go, ``forced`` counts the copies that
    must go besides. Counted before any shuffle, so that a text repeated a million times is
    one row; the earliest turn of a text is joined, not found in a window.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    counted = counted.withColumn("tail", F.rtrim("text", F.lit(BLANK))).withColumn(
        "mark", F.when(F.col("tail") != "", F.sha2("text", 256))
    )
    # Null turns come first.
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = (
        counted.filter("mark IS NOT NULL").groupBy("conv_id", "role", "mark").agg(F.min(at).alias("first"))
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("k"), "first")
    )
    joined = counted.join(
        first,
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("k")),
        "left",
    )
    gone = (F.col("tail") == "") | (at > F.col("first"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    cut = F.when(F.right("tail", F.lit(1)).isin(".", "!", "?"), 0).otherwise(4)
    return joined.select(
        "conv_id", "turn", "role", "text", "copies",
        F.when(gone, 0).otherwise(kind + cut).cast("int").alias("code"),
        F.when(gone, F.col("copies")).otherwise(F.col("copies") - 1).alias("forced"),
        (F.col("tail") == "").alias("blank"),
    )


# --- the auction -------------------------------------------------------------


def steps_of(code: Iterable[int], forced: Iterable[int]) -> list[tuple[int, int]]:
    """Lattice steps (code, deletion cost): a row that may stay, then its copies that go as one step."""
    steps = []
    for c, f in zip(code, forced, strict=True):
        if c:
            steps.append((c, 3))
        if f:
            steps.append((0, 3 * f))
    return steps


def auction(steps: list[tuple[int, int]], lo: int, hi: int, price: list[list[int]], state: int) -> tuple[str, int]:
    """Letters from layer ``lo`` in ``state`` to layer ``hi``, whose prices are final, and the state there.

    Raises prices of the layers between in place; ``price[lo][state]`` is exact afterwards.
    """
    path, letters = [(lo, state)], []
    while True:
        i, s = path[-1]
        if i == hi:
            return "".join(letters), s
        code, gone = steps[i]
        here, behind, turn = price[i], price[i + 1], NEXT[s]
        best, letter, after = gone + behind[s], "D", (i + 1, s)
        if 2 + here[turn] < best:
            best, letter, after = 2 + here[turn], "I", (i, turn)
        if code:
            extra = code > 4
            kept = KEPT.get((s, code - 4 if extra else code))
            if kept is not None and extra + behind[kept] < best:
                best, letter, after = extra + behind[kept], "K", (i + 1, kept)
            if 2 + extra + behind[turn] < best:
                best, letter, after = 2 + extra + behind[turn], "R", (i + 1, turn)
        if here[s] < best:
            here[s] = min(best, FAR)
            if len(path) > 1:
                path.pop()
                letters.pop()
            elif best >= FAR:
                return "", -1
        else:
            path.append(after)
            letters.append(letter)


def priced(steps: list[tuple[int, int]], end: tuple[int, ...] | list[int], entries: Iterable[int]) -> tuple[list[list[int]], list[int]]:
    """(prices of all layers, borders of the blocks); exact at the borders, and for ``entries`` at the start."""
    n = len(steps)
    price: list[list[int]] = [[]] * n + [list(end)]
    borders = [*range(0, n, BLOCK), n]
    for b in range(len(borders) - 2, -1, -1):
        lo, hi = borders[b], borders[b + 1]
        low = min(price[hi])
        for i in range(hi - 1, lo - 1, -1):
            code, gone = steps[i]
            low += min(gone, int(code > 4)) if code else gone
            price[i] = [low] * 4
        for s in range(4) if lo else entries:
            auction(steps, lo, hi, price, s)
    return price, borders


def trace(steps: list[tuple[int, int]], end: tuple[int, ...] | list[int], entry: int) -> tuple[str, int]:
    """Letters of the first cheapest path from ``entry``, and the state after the last step."""
    price, borders = priced(steps, end, [entry])
    letters, state = [], entry
    for lo, hi in zip(borders, borders[1:]):
        part, state = auction(steps, lo, hi, price, state)
        letters.append(part)
    return "".join(letters), state


def matrix(steps: list[tuple[int, int]]) -> list[int | None]:
    """Cheapest cost from each entry state to each exit state of a piece, row by row; None: no way."""
    out: list[int | None] = [None] * 16
    whole = sum(gone for _, gone in steps)
    # States 0 and 1 are left for good: only deletions stay in them.
    out[0] = out[5] = whole
    keeps = [(code > 4) - 3 for code, _ in steps if code in (1, 5)]
    if keeps:
        out[1] = whole + min(keeps)
    for exit_state in (2, 3):
        price, _ = priced(steps, [0 if s == exit_state else FAR for s in range(4)], range(4))
        for s in range(4):
            cost = price[0][s] if steps else (0 if s == exit_state else FAR)
            out[4 * s + exit_state] = cost if cost < FAR else None
    return out


def end_prices(matrices: list[list[int | None]]) -> list[list[int]]:
    """For each piece of a conversation, the exact prices of the four states behind it.

    The same auction over the lattice of pieces, whose arcs are the pieces' matrices.
    """
    n = len(matrices)
    price = [[0] * 4 for _ in range(n)] + [list(END)]
    for k in range(n - 1, -1, -1):
        low = min(price[k + 1])
        price[k] = [low] * 4
        for s in range(4):
            path = [(k, s)]
            while path:
                i, at = path[-1]
                if i == k + 1:
                    break
                best, after = min(
                    ((FAR if c is None else c + price[i + 1][e]), e) for e, c in enumerate(matrices[i][4 * at : 4 * at + 4])
                )
                if price[i][at] < best:
                    price[i][at] = min(best, FAR)
                else:
                    path.append((i + 1, after))
                if best >= FAR:
                    break
    return price[1:]


# --- pieces ------------------------------------------------------------------

ROW = "conv_id bigint, piece bigint, pos bigint, turn bigint, role string, text string, copies bigint, code int, forced bigint, blank boolean"
TURNS = "array<struct<role: string, text: string>>"
PIECE = (
    f"conv_id bigint, piece bigint, whole boolean, edits string, turns {TURNS}, rows bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, cost bigint, turns_seen bigint, low bigint, high bigint, first string, last string"
)


def walked(rows: list[dict], letters: str, state: int) -> dict:
    """What becomes of the rows of a piece under its letters, and its counts.

    A letter D of copies that go stands for all of them in ``letters`` and is written out in ``edits``.
    """
    edits, turns, at = [], [], 0
    seen: set[int] = set()
    out = {"rows": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
    last = None

    def inserts() -> None:
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            state = NEXT[state]
            turns.append({"role": ROLE[state], "text": ""})
            edits.append("I")
            out["cost"] += 2
            at += 1

    for r in rows:
        initial = r["role"][:1]
        if r["turn"] is not None:
            seen.add(r["turn"])
        out["illegal"] += (last is not None and last + initial not in ("su", "ua", "au")) + r["copies"] - 1
        out["rows"] += r["copies"]
        last = initial
        out["blank" if r["blank"] else "duplicate"] += r["forced"]
        out["truncated"] += r["code"] > 4
        if r["code"]:
            inserts()
            letter = letters[at]
            at += 1
            edits.append(letter)
            if letter == "D":
                out["cost"] += 3
            else:
                state = KEPT[state, (r["code"] - 1) % 4 + 1] if letter == "K" else NEXT[state]
                turns.append({"role": r["role"] if letter == "K" else ROLE[state], "text": r["text"]})
                out["cost"] += (r["code"] > 4) + 2 * (letter == "R")
        if r["forced"]:
            inserts()
            at += 1
            edits.append("D" * r["forced"])
            out["cost"] += 3 * r["forced"]
    inserts()
    return out | {
        "edits": "".join(edits), "turns": turns, "turns_seen": len(seen), "low": min(seen, default=None),
        "high": max(seen, default=None), "first": rows[0]["role"][:1] if rows else None, "last": last,
    }


def _arrow(schema: str) -> pa.Schema:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    simple[TURNS] = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    simple["array<bigint>"] = pa.list_(pa.int64())
    fields = []
    for part in schema.replace(TURNS, "TURNS").split(", "):
        name, kind = part.split(" ")
        fields.append((name, simple[TURNS if kind == "TURNS" else kind]))
    return pa.schema(fields)


def _grouped(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of equal keys among rows that come sorted by them."""
    key, run = None, []
    for batch in batches:
        for r in batch.to_pylist():
            own = tuple(r[k] for k in keys)
            if run and own != key:
                yield key, run
                run = []
            key = own
            run.append(r)
    if run:
        yield key, run


def _sorted_rows(conversations: DataFrame) -> DataFrame:
    order = ["conv_id", "turn", "role", "text"]
    rows = judged(damage(conversations))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())


def _first_pass(conversations: DataFrame) -> DataFrame:
    """Whole conversations as finished pieces; of all others, the rows (``row`` is set then).

    The first and the last conversation of a task may go on in its neighbours; a
    conversation beyond ``PIECE_BYTES`` is cut into pieces.
    """
    result, raw = _arrow(PIECE), _arrow(ROW)
    schema = pa.schema([pa.field("done", pa.struct(list(result))), pa.field("row", pa.struct(list(raw)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return made

        held: list[dict] = []
        size, piece, edge, current = 0, 0, True, None

        def open_rows(rows: list[dict]) -> None:
            out.extend({"done": None, "row": r | {"piece": piece}} for r in rows)

        started = False
        for batch in batches:
            for r in batch.to_pylist():
                if started and r["conv_id"] != current:
                    if edge:
                        open_rows(held)
                    else:
                        letters, state = trace(steps_of((h["code"] for h in held), (h["forced"] for h in held)), END, 0)
                        letters += "I" * (END[state] // 2)
                        out.append({"done": walked(held, letters, 0) | {"conv_id": current, "piece": held[0]["pos"], "whole": True}, "row": None})
                    held, size, edge = [], 0, False
                if not held:
                    piece = r["pos"]
                started, current = True, r["conv_id"]
                held.append(r)
                size += len(r["text"]) + 64
                if size > PIECE_BYTES:
                    open_rows(held)
                    held, size, edge = [], 0, True
                if len(out) >= 1024:
                    yield flush()
        open_rows(held)
        yield flush()

    names = "conv_id", "turn", "role", "text", "copies", "code", "forced", "blank", "pos"
    ddl = f"done struct<{_ddl(PIECE)}>, row struct<{_ddl(ROW)}>"
    return _sorted_rows(conversations).select(*names).mapInArrow(run, ddl)


def _ddl(schema: str) -> str:
    return ", ".join(part.replace(" ", ": ", 1) for part in schema.replace(TURNS, "TURNS").split(", ")).replace("TURNS", TURNS)


def _by_piece(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select("conv_id", "piece", "pos", *columns).repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "pos")


def _matrices(rows: DataFrame) -> DataFrame:
    schema = "conv_id bigint, piece bigint, costs array<bigint>"
    fields = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, piece), held in _grouped(batches, "conv_id", "piece"):
            costs = matrix(steps_of((r["code"] for r in held), (r["forced"] for r in held)))
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "piece": piece, "costs": costs}], schema=fields)

    return _by_piece(rows, "code", "forced").mapInArrow(run, schema)


def _traced(rows: DataFrame, ends: dict[tuple, list[int]]) -> DataFrame:
    """Letters of every piece for each entry state, under the final prices behind it."""
    schema = "conv_id bigint, piece bigint, entry int, leave int, letters string"
    fields = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held in _grouped(batches, "conv_id", "piece"):
            steps = steps_of((r["code"] for r in held), (r["forced"] for r in held))
            found = [(entry, *trace(steps, ends[key], entry)) for entry in range(4)]
            rows_out = [
                {"conv_id": key[0], "piece": key[1], "entry": entry, "leave": leave, "letters": letters}
                for entry, letters, leave in found if leave >= 0
            ]
            yield pa.RecordBatch.from_pylist(rows_out, schema=fields)

    return _by_piece(rows, "code", "forced").mapInArrow(run, schema)


def _finished(rows: DataFrame, letters: DataFrame) -> DataFrame:
    """The pieces with what became of their rows; each piece's letters come in front of its rows."""
    fields = _arrow(PIECE)
    first = letters.select("conv_id", "piece", F.lit(-1).cast("bigint").alias("pos"), "entry", "letters")
    columns = ("turn", "role", "text", "copies", "code", "forced", "blank")
    both = rows.select("conv_id", "piece", "pos", *columns).unionByName(first, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, piece), held in _grouped(batches, "conv_id", "piece"):
            done = walked(held[1:], held[0]["letters"], held[0]["entry"])
            yield pa.RecordBatch.from_pylist([done | {"conv_id": conv, "piece": piece, "whole": False}], schema=fields)

    ordered = both.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "pos")
    return ordered.mapInArrow(run, PIECE)


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired conversations in pieces (``PIECE``), to be read in the order of ``piece``.

    ``edits`` are the initials of the edits, ``turns`` the turns that stay or come in; a
    conversation in one finished piece has ``whole`` set.
    """
    spark = conversations.sparkSession
    passed, _ = stored(_first_pass(conversations), "repair-pass")
    done = passed.filter("done IS NOT NULL").select("done.*")
    rows = passed.filter("row IS NOT NULL").select("row.*")
    # At most two pieces a task, and one for each PIECE_BYTES.
    pieces = defaultdict(list)
    for r in _matrices(rows).collect():
        pieces[r.conv_id].append((r.piece, r.costs))
    ends, tails = {}, {}
    for conv, listed in pieces.items():
        listed.sort()
        tails[conv] = listed[-1][0]
        for (piece, _), prices in zip(listed, end_prices([costs for _, costs in listed]), strict=True):
            ends[conv, piece] = prices
    traced, _ = stored(_traced(rows, ends), "repair-letters")
    leave = {(r.conv_id, r.piece, r.entry): r.leave for r in traced.select("conv_id", "piece", "entry", "leave").collect()}
    chosen = []
    for conv, listed in pieces.items():
        state = 0
        for piece, _ in listed:
            after = leave[conv, piece, state]
            chosen.append((conv, piece, state, "I" * (END[after] // 2) if piece == tails[conv] else ""))
            state = after
    picked = spark.createDataFrame(chosen, "c bigint, p bigint, e int, tail string")
    # As many rows as pieces.
    letters = traced.join(
        F.broadcast(picked),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p")) & (F.col("entry") == F.col("e")),
    ).select("conv_id", "piece", "entry", F.concat("letters", "tail").alias("letters"))
    return done.unionByName(_finished(rows, letters))


# --- report ------------------------------------------------------------------

REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def _joined(pieces: DataFrame) -> DataFrame:
    """Reports of conversations in several pieces: one running hash over each, a piece at a time."""
    fields = _arrow(REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def report() -> pa.RecordBatch:
            low, high = state["low"], state["high"]
            total = state["sums"] | {
                "conv_id": state["conv_id"],
                "gaps": 0 if low is None else high - low + 1 - state["distinct"],
                "audit": "".join(state["audit"]),
                "repaired_sha256": state["hash"].hexdigest(),
            }
            return pa.RecordBatch.from_pylist([total], schema=fields)

        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if state is None or state["conv_id"] != r["conv_id"]:
                    if state is not None:
                        yield report()
                    state = {
                        "conv_id": r["conv_id"], "hash": hashlib.sha256(), "audit": [], "low": None, "high": None,
                        "distinct": 0, "last": None, "empty": True,
                        "sums": dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0),
                    }
                for name in state["sums"]:
                    state["sums"][name] += r[name]
                if state["last"] is not None:
                    state["sums"]["illegal"] += state["last"] + r["first"] not in ("su", "ua", "au")
                state["last"] = r["last"]
                if r["low"] is not None:
                    state["distinct"] += r["turns_seen"] - (state["high"] == r["low"])
                    state["low"] = r["low"] if state["low"] is None else state["low"]
                    state["high"] = r["high"]
                state["audit"].append(r["edits"])
                for turn in r["turns"]:
                    state["hash"].update(("" if state["empty"] else "\n").encode() + f"{turn['role']}:{turn['text']}".encode())
                    state["empty"] = False
        if state is not None:
            yield report()

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, REPORT)


def report(conversations: DataFrame) -> DataFrame:
    """A row for every conversation of the input: faults, cost, edits and the hash of the repaired text."""
    pieces, _ = stored(repair(conversations), "repair-pieces")
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.filter("whole").select(
        "conv_id",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns_seen"), F.lit(0).cast("bigint")).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", F.col("edits").alias("audit"),
        F.sha2(joined.cast("binary"), 256).alias("repaired_sha256"),
    )
    found = whole.unionByName(_joined(pieces.filter("NOT whole")))
    known = conversations.select(F.col("conv_id").alias("known")).distinct()
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return known.join(found, F.col("known").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("known").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in sums],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
