"""Conversation repair against an exhaustive search, whole and in many pieces."""

import hashlib
import random
import re
from functools import cache
from zlib import crc32

import pytest

from authledger.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, code string, steps int, row string"
LAST = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows):
    """The report of one conversation, by trying everything from the end."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        marks = LAST.findall(text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]

    @cache
    def best(i, state, inserted):
        """(cost, letters, repaired rows) from row i on."""
        options = []
        turn = "assistant" if state == 2 else "user"
        after = {"user": 2, "assistant": 3}[turn]
        if i == len(rows) and state in (0, 3):
            options.append((0, "", ()))
        if inserted < 2:
            cost, letters, rest = best(i, after, inserted + 1)
            options.append((cost + 2, "I" + letters, (f"{turn}:", *rest)))
        if i < len(rows):
            cost, letters, rest = best(i + 1, state, 0)
            options.append((cost + 3, "D" + letters, rest))
            if faults[i] not in ("blank", "duplicate"):
                extra, text = int(faults[i] == "truncated"), rows[i][3]
                cost, letters, rest = best(i + 1, after, 0)
                options.append((cost + 2 + extra, "R" + letters, (f"{turn}:{text}", *rest)))
                goes = {"s": 1 if state == 0 else None, "u": 2 if state != 2 else None, "a": 3 if state == 2 else None}.get(initials[i])
                if goes:
                    cost, letters, rest = best(i + 1, goes, 0)
                    options.append((cost + extra, "K" + letters, (f"{rows[i][2]}:{text}", *rest)))
        return min(options, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # from the end, against deep recursion
        for state in range(4):
            best(i, state, 0)
    cost, audit, kept = best(0, 0, 0)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    )


def compare(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in repair.report(docs).collect()}
    by = {}
    for r in damaged(rows):
        by.setdefault(r[0], []).append(r)
    want = {conv: expected(by.get(conv, [])) for conv in {r[0] for r in rows}}
    assert got == want


def sample(seed, conversations, most):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "no", "Why?", "", " \n", "a b!", None, "é.", "and so on", "Yes. \t"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None]
    for conv in [*range(conversations), None]:
        for turn in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {turn}."))
    return rows


def test_reports_match_an_exhaustive_search(spark):
    compare(spark, sample(1, 150, 9))


@pytest.mark.parametrize("piece", [1, 400])
def test_conversations_in_many_pieces(spark, monkeypatch, piece):
    """Every row, or every few rows, is a piece of its own."""
    monkeypatch.setattr(repair, "PIECE_BYTES", piece)
    monkeypatch.setattr(repair, "BLOCK", 3)
    compare(spark, sample(2, 12, 9) + [(77, t, "user" if t % 3 else "assistant", f"{t}.") for t in range(120)])


def test_long_conversation_and_repeated_rows(spark):
    rows = [(5, t, ("user", "assistant")[t % 2], f"text {t % 90}{'.' if t % 7 else ''}") for t in range(400)]
    compare(spark, rows + [(6, 1, "user", "Same.")] * 30 + [(6, 2, "assistant", "Well.")])


def test_empty_table(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dual_prices_are_exact_on_the_path():
    rng = random.Random(3)
    for _ in range(200):
        steps = [(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]), 3) for _ in range(rng.randint(1, 12))]
        price, _ = repair.priced(steps, repair.END, range(4))
        costs = repair.matrix(steps)
        for s in range(4):
            ways = [costs[4 * s + e] + repair.END[e] for e in range(4) if costs[4 * s + e] is not None]
            assert price[0][s] == min(ways)
