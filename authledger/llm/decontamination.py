"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of digits, Latin letters and characters beyond ASCII, lower-cased in A-Z.
A window is ten consecutive words of an item; an item of one to nine words is one window.
All windows go, as word sequences between single spaces, into one automaton. A document
is normalised the same way and scanned once; the end of each match is mapped through the
positions of the spaces to word numbers, and from those to bytes of the original text.

The automaton is built on the driver and broadcast, so the benchmark is bounded: above
``MAX_BENCHMARK_BYTES`` of text an error is raised and nothing is left out silently.

Edge cases: null and empty texts have no words and no hits; items without words, or
without id, have no windows; repeated items and documents count like any other; an empty
benchmark or table gives clean or no rows; other columns are not read, and the filter
keeps them as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, functions as F

from authledger.llm.common import keep_rows, map_texts, sent

WINDOW = 10
MAX_BENCHMARK_BYTES = 64 << 20
SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
    "contaminated boolean, first_byte bigint, end_byte bigint"
)
_WORD = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))
_RUN = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Matcher:
    """The automaton; it is built anew in each worker from the windows."""

    def __init__(self, items: Iterable[tuple[int, bytes]], window: int = WINDOW):
        self.windows: dict[bytes, set[int]] = {}
        for item, text in items:
            words = words_of(text)
            for start in range(max(1, len(words) - window + 1)) if words else ():
                part = words[start : start + window]
                self.windows.setdefault(b" ".join(part), set()).add(item)
        self._automaton = None

    def __getstate__(self) -> dict:
        return {"windows": self.windows, "_automaton": None}

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            built = ahocorasick.Automaton()
            for key, items in self.windows.items():
                built.add_word(f" {key.decode('latin-1')} ", (key.count(b" ") + 1, items))
            built.make_automaton()
            self._automaton = built
        return self._automaton

    def scan(self, text: bytes) -> tuple[int, np.ndarray, set[int]]:
        """(number of words, numbers of the words that are hit, items found)."""
        words = words_of(text)
        items: set[int] = set()
        if not self.windows or not words:
            return len(words), np.zeros(0, np.int64), items
        line = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(line.decode("latin-1")))
        if not found:
            return len(words), np.zeros(0, np.int64), items
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
        ends = np.searchsorted(spaces, [end for end, _ in found])
        change = np.zeros(len(words) + 1, np.int64)
        for end, (_, (length, owners)) in zip(ends, found, strict=True):
            change[end - length] += 1
            change[end] -= 1
            items |= owners
        return len(words), np.flatnonzero(np.cumsum(change)[:-1] > 0), items

    def spans(self, text: bytes) -> list[tuple[int, int]]:
        """Byte ranges of the original text whose words are hit, neighbours joined."""
        _, hit, _ = self.scan(text)
        places = [m.span() for m in _RUN.finditer(text.translate(_NORMAL))]
        out: list[tuple[int, int]] = []
        for before, word in zip([-2, *hit[:-1]], hit, strict=True) if len(hit) else ():
            if word == before + 1:
                out[-1] = (out[-1][0], places[word][1])
            else:
                out.append(places[word])
        return out


def matcher(benchmark: DataFrame, window: int = WINDOW) -> Matcher:
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).filter(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes of text; split it and run once per part")
    return Matcher(((r.item_id, bytes(r.text)) for r in items.collect()), window)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, hit words, items and the byte range from first to last hit."""
    shared = sent(docs.sparkSession, matcher(benchmark, window))

    def each(ids: list[int | None], batch: list[bytes]) -> dict[str, list]:
        out: dict[str, list] = {
            k: [] for k in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "first_byte", "end_byte")
        }
        for text in batch:
            n, hit, items = shared().scan(text)
            spans = shared().spans(text) if len(hit) else []
            out["n_words"].append(n)
            out["n_hit"].append(len(hit))
            out["n_items"].append(len(items))
            listed = ",".join(sorted(map(str, items)))
            out["items_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
            out["contaminated"].append(len(hit) > 0)
            out["first_byte"].append(spans[0][0] if spans else None)
            out["end_byte"].append(spans[-1][1] if spans else None)
        return {"doc_id": ids, **out}

    return map_texts(docs, each, SCHEMA)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit word, with all their columns."""
    shared = sent(docs.sparkSession, matcher(benchmark, window))
    return keep_rows(docs, lambda batch: np.array([not len(shared().scan(t)[1]) for t in batch], bool))
