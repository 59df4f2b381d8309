"""Quality rules: base rules, then a calibrated n-gram logistic regression.

Words are runs of anything but ASCII white space. A document fails the base rules
with fewer than 50 words, or when over half of its words lie in 3-word windows
that the text has twice or more. What passes is kept if the model's probability
of good quality reaches a fixed threshold.

Model: logistic regression on hashed word 1- and 2-grams and byte 3-grams, fitted
on at most ``SAMPLE_PER_CLASS`` labelled rows of each class, on three quarters of
them; the last quarter calibrates the probability. Scoring is row by row in Arrow
batches. Labels, language, source and id are no inputs.

Edge cases: a null or empty text has no words and fails the base rules; repeated
rows are each judged; an empty table gives an empty result; without labelled rows
of both classes every probability is 0.5; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

from authledger.llm import ngrams
from authledger.llm.common import (
    Rows, fit_calibration, fit_logistic, labelled_sample, map_texts, sent, sigmoid,
)

SAMPLE_PER_CLASS = 2000
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, score double"
)

_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)
_CONTINUATION_OR_SPACE = bytes([*range(0x80, 0xC0), 0x20, *range(0x09, 0x0E)])


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    windows = (
        h[:-2] * np.uint64(0x9E3779B97F4A7C15)
        ^ (h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(1))
        ^ h[2:] * np.uint64(0x165667B19E3779F9) << np.uint64(1)
    )
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= again
    return int(covered.sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """(words, characters in words, symbols, repeated lines, repeated words)."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _CONTINUATION_OR_SPACE)),
        len(text.translate(None, _NOT_SYMBOL)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


class Model:
    """Weights of the n-grams and the calibration of their sum."""

    def __init__(self, sample: list[tuple[bytes, int, float]]):
        rows = [ngrams.row(text, text.split()) for text, _, _ in sample]
        y = np.array([label for _, label, _ in sample], float)
        weight = np.array([w for _, _, w in sample], float)
        calibrating = np.arange(len(rows)) % 4 == 3
        fit = [r for r, c in zip(rows, calibrating, strict=True) if not c]
        if len(set(y[~calibrating])) < 2:
            self.weights, self.slope, self.offset = np.zeros(ngrams.WIDTH, np.float32), 1.0, 0.0
            return
        w, b = fit_logistic(
            Rows(fit), y[~calibrating], weight[~calibrating], ngrams.WIDTH, l2=1e-5, steps=200
        )
        self.weights = w.astype(np.float32)
        held = [r for r, c in zip(rows, calibrating, strict=True) if c]
        raw = Rows(held).times(self.weights.astype(float))
        self.slope, self.offset = fit_calibration(raw, y[calibrating], weight[calibrating])
        if len(set(y[calibrating])) < 2:
            self.offset = b

    def probability(self, text: bytes, words: list[bytes]) -> float:
        raw = ngrams.score(text, words, self.weights)
        return float(sigmoid(np.float64(self.slope * raw + self.offset)))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    sample_per_class: int = SAMPLE_PER_CLASS,
) -> DataFrame:
    """One row per document with its base counts, its probability and the verdict."""
    model = Model(labelled_sample(docs, labels, "quality", sample_per_class))
    shared = sent(docs.sparkSession, model)

    def each(ids: list[int | None], batch: list[bytes]) -> dict[str, list]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        out: dict[str, list] = {name: [] for name in [*names, "base_failed", "kept", "score"]}
        for text in batch:
            words = text.split()
            counts = base_counts(text, words)
            for name, count in zip(names, counts, strict=True):
                out[name].append(count)
            n, repeated = counts[0], counts[4]
            failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
            probability = shared().probability(text, words)
            out["base_failed"].append(failed)
            out["score"].append(probability)
            out["kept"].append(not failed and probability >= threshold)
        return {"doc_id": ids, **out}

    return map_texts(docs, each, SCHEMA)
