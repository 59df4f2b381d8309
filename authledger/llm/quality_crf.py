"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are measures of the line itself and of the lines
before and after it; transitions tie neighbouring lines. The chain is trained by maximum
likelihood on whole labelled documents, whose lines take the document's label. Marginals
come from the forward-backward recursion over all lines of the whole text; their mean,
weighted by line length, is the quality of the document, calibrated to a probability on
labelled documents that the chain did not see.

At most ``SAMPLE_PER_CLASS`` labelled rows of each class are used, one in four for the
calibration. Labels, language, source and id are no inputs of a score.

Edge cases: a null or empty text, or one of blank lines, is one line without words;
repeated rows are each scored; an empty table gives an empty result; without labelled rows
of both classes every score is 0.5; other columns are not read.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame

from authledger.llm.common import fit_calibration, labelled_sample, map_texts, sent, sigmoid

SAMPLE_PER_CLASS = 700
THRESHOLD = 0.7
STEPS, RATE, L2 = 150, 0.08, 1e-3
SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int, n_lines bigint, good_share double"
OWN = 12


def _without(characters: bytes) -> bytes:
    return bytes(b for b in range(256) if b not in characters)


_SYMBOLS, _BARS = _without(b"#*$%&<>"), _without(b"|")
_SHOUTS, _DIGITS = _without(b"!"), _without(b"0123456789")
_UPPER = _without(bytes(range(0x41, 0x5B)))


def measure(line: bytes, seen: set[bytes]) -> tuple[float, ...]:
    """The measures of one line; ``seen`` holds the earlier lines."""
    words = line.split()
    n, size = len(words), len(line) + 1
    repeated = line in seen
    seen.add(line)
    return (
        1.0,
        min(1.0, 8 * len(line.translate(None, _SYMBOLS)) / size),
        min(1.0, 8 * len(line.translate(None, _BARS)) / size),
        min(1.0, 8 * len(line.translate(None, _SHOUTS)) / size),
        min(1.0, 4 * len(line.translate(None, _DIGITS)) / size),
        min(1.0, 2 * len(line.translate(None, _UPPER)) / size),
        float(repeated),
        1 - len(set(words)) / n if n else 0.0,
        min(1.0, n / 40),
        min(1.0, size / (10 * n)) if n else 0.0,
        float(line.rstrip()[-1:] in (b".", b"?", b"!")),
        float(n < 3),
    )


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(one row per line that is not blank, with its neighbours' measures; line lengths)."""
    seen: set[bytes] = set()
    lines = [line for line in text.split(b"\n") if line.strip()] or [b""]
    own = np.array([measure(line, seen) for line in lines])
    edge = np.zeros((1, OWN))
    rows = np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])])
    return rows, np.array([len(line) + 1 for line in lines], float)


def _padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Scores with one column per document, and which cells hold a line."""
    lengths = np.array([len(p) for p in parts])
    mask = np.arange(lengths.max())[:, None] < lengths[None, :]
    out = np.zeros(mask.shape)
    out.T[mask.T] = np.concatenate(parts)
    return out, mask


def forward_backward(e: np.ndarray, mask: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good from the lines up to each line, and from the lines after it.

    ``e`` are the log odds of single lines, ``t[i, j]`` the potential of state j after i.
    """
    a, b = np.zeros_like(e), np.zeros_like(e)
    for k in range(len(e)):
        before = 0.0
        if k:
            x = a[k - 1]
            before = np.logaddexp(x + t[1, 1], t[0, 1]) - np.logaddexp(x + t[1, 0], t[0, 0])
        a[k] = e[k] + before
    for k in range(len(e) - 2, -1, -1):
        x = b[k + 1] + e[k + 1]
        after = np.logaddexp(t[1, 1] + x, t[1, 0]) - np.logaddexp(t[0, 1] + x, t[0, 0])
        b[k] = np.where(mask[k + 1], after, 0.0)
    return a, b


class Model:
    def __init__(self, sample: list[tuple[bytes, int, float]]):
        self.w, self.t = np.zeros(3 * OWN), np.zeros((2, 2))
        self.slope, self.offset = 1.0, 0.0
        data = [(*features(text), y, weight) for text, y, weight in sample]
        fit, held = [d for i, d in enumerate(data) if i % 4 != 3], data[3::4]
        if len({y for _, _, y, _ in fit}) < 2:
            return
        # Balanced classes while the chain is trained; the calibration has true shares.
        n = {y: sum(d[2] == y for d in fit) for y in (0, 1)}
        self._train([d[0] for d in fit], np.array([d[2] for d in fit], float), np.array([1 / n[d[2]] for d in fit]) / 2)
        if held:
            raw = np.array([self.raw(s) for s in self.shares([(d[0], d[1]) for d in held])])
            self.slope, self.offset = fit_calibration(
                raw, np.array([d[2] for d in held], float), np.array([d[3] for d in held])
            )

    def _train(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
        x = np.vstack(rows)
        cut = np.cumsum([len(r) for r in rows])[:-1]
        per_line = np.concatenate([np.full(len(r), v / len(r)) for r, v in zip(rows, weight, strict=True)])
        goal = np.concatenate([np.full(len(r), v) for r, v in zip(rows, y, strict=True)])
        theta = np.zeros(len(self.w) + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        share = weight / np.array([len(r) for r in rows])
        for step in range(1, STEPS + 1):
            w, t = theta[:-4], theta[-4:].reshape(2, 2)
            e, mask = _padded(np.split(x @ w, cut))
            a, b = forward_backward(e, mask, t)
            good = sigmoid((a + b).T[mask.T])
            g = -x.T @ (per_line * (goal - good))
            pair = np.empty((2, 2, *e[1:].shape))
            for i in (0, 1):
                for j in (0, 1):
                    pair[i, j] = i * a[:-1] + t[i, j] + j * (e + b)[1:]
            pair -= pair.max((0, 1))
            pair = np.exp(pair)
            pair = pair / pair.sum((0, 1)) * mask[1:] * share
            both = (mask[1:] * share).sum(0)
            gt = pair.sum((2, 3))
            gt[0, 0] -= both[y == 0].sum()
            gt[1, 1] -= both[y == 1].sum()
            gradient = np.r_[g, gt.ravel()] + L2 * theta
            m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
            theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.w, self.t = theta[:-4], theta[-4:].reshape(2, 2)

    def shares(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
        """The length-weighted share of good lines of each document."""
        out = [0.0] * len(documents)
        order = sorted(range(len(documents)), key=lambda i: len(documents[i][1]))
        for start in range(0, len(order), 64):
            group = order[start : start + 64]
            e, mask = _padded([documents[i][0] @ self.w for i in group])
            a, b = forward_backward(e, mask, self.t)
            good = sigmoid(a + b)
            for column, i in enumerate(group):
                size = documents[i][1]
                out[i] = float(good[: len(size), column] @ size / size.sum())
        return out

    @staticmethod
    def raw(share: float) -> float:
        share = min(max(share, 1e-4), 1 - 1e-4)
        return float(np.log(share / (1 - share)))

    def probability(self, share: float) -> float:
        return float(sigmoid(np.float64(self.slope * self.raw(share) + self.offset)))


def quality_crf(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_per_class: int = SAMPLE_PER_CLASS
) -> DataFrame:
    """One row per document: its score, the verdict, its lines and their share of good ones."""
    model = Model(labelled_sample(docs, labels, "quality", sample_per_class))
    shared = sent(docs.sparkSession, model)

    def each(ids: list[int | None], batch: list[bytes]) -> dict[str, list]:
        documents = [features(text) for text in batch]
        shares = shared().shares(documents)
        scores = [shared().probability(s) for s in shares]
        return {
            "doc_id": ids,
            "held_out": [i is not None and crc32(str(i).encode()) % 4 == 2 for i in ids],
            "score": scores,
            "predicted": [int(s >= threshold) for s in scores],
            "n_lines": [len(size) for _, size in documents],
            "good_share": shares,
        }

    return map_texts(docs, each, SCHEMA)
