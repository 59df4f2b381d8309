"""Toxicity by weak supervision.

1. Voters: lexicons, patterns, and word stems mined from labelled training rows in every
   language: all beginnings of words that toxic rows have far more often, counted in
   the executors, of which nested ones are one voter. Each votes on a text or abstains.
2. A generative label model estimates by expectation maximisation how often each voter
   speaks on toxic and on other texts, from labelled rows, whose class is fixed, and from
   unlabelled ones, whose class is what the votes make of it. A voter that abstains says
   nothing: its silence is no evidence. How far two voters go together within a class is
   estimated for every pair; the evidence of those that speak is weighted by the
   inverse of their correlations, so that ten voters for one word do not count ten times.
3. A linear classifier on hashed words and word beginnings is trained on the
   posteriors, weighted by their certainty, and scores every whole text.

At most ``SAMPLE_PER_CLASS`` labelled rows of each class and ``UNLABELLED`` other rows are used
for fitting, in the order of a hash of the id. The driver gets their votes and hashed
features, never their texts. Labels, language, source and id are no inputs of a score.

Edge cases: a null or empty text has no words and gets the score of the intercept;
repeated rows are each scored; an empty table gives an empty result; without
labelled rows of both classes the lexicons and patterns alone decide; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from authledger.llm.common import (
    Rows, fit_logistic, held_out, keep_rows, map_texts, sent, sigmoid, stored, texts,
)

SAMPLE_PER_CLASS, UNLABELLED = 2000, 1000
THRESHOLD = 0.3
# Share of toxic rows where labels do not tell it.
PRIOR = 0.1
# A beginning is taken up if toxic rows have it so many times more often, beyond chance by a
# likelihood ratio statistic of EVIDENCE (hundreds of thousands of beginnings are looked at).
ODDS, EVIDENCE = 4.0, 28.0
BITS = 18
SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"

# Words of abuse by kind.
LEXICONS = {
    "stupidity": "idiot idiots idiotic moron morons moronic stupid dumb imbecile fool dimwit",
    "contempt": "pathetic worthless loser losers clown clowns useless failure joke",
    "disgust": "disgusting trash garbage scum filth filthy vermin vile sickening",
    "threat": "kill hurt destroy beat punish die hang burn",
    "hostility": "hate hated despise shut liar traitor coward freak creep",
}
PATTERNS = {
    "address": r"\b(?:you|your|you're|they|he|she)\b(?: \w+){0,3} (?:idiot|moron|clown|loser|scum|trash|fool)s?\b",
    "command": r"\b(?:shut up|get lost|go away|drop dead)\b",
    "shouted": r"\b(?:IDIOT|MORON|STUPID|LOSER|SCUM|TRASH|CLOWN)S?\b",
}
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def beginnings(word: str) -> list[str]:
    """The word as a whole and its first 4 to 7 letters."""
    return [f"{word}|", *(word[:k] for k in range(4, min(8, len(word) + 1)))]


# --- voters ------------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, unlabelled: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, label) of a bounded sample, label null for rows without one; and the rows of each class.

    Held-out rows, labelled or not, and rows that are labelled differently in two places are left out.
    """
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
    )
    usable, _ = stored(known.filter((F.col("label") == F.col("other")) & ~held_out(F.col("doc_id"))).drop("other"), "toxic-labels")
    sizes = {value: usable.filter(F.col("label") == value).count() for value in (0, 1)}
    order = (F.xxhash64("doc_id"), "doc_id")
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    others = ids.join(known.select("doc_id"), "doc_id", "left_anti").orderBy(*order).limit(unlabelled)
    chosen = others.select("doc_id", F.lit(None).cast("int").alias("label"))
    for value in (0, 1):
        chosen = chosen.unionByName(usable.filter(F.col("label") == value).orderBy(*order).limit(per_class))
    # At most 2 * per_class + unlabelled ids.
    rows = texts(docs).join(F.broadcast(chosen.distinct()), "doc_id").filter("text IS NOT NULL").select("text", "label")
    return stored(rows, "toxic-sample")[0], sizes


def mine(sample: DataFrame) -> dict[str, float]:
    """Beginning -> gain, of all that toxic rows of the sample have far more often than others; no list is cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                keys = {k for w in set(words_of(text.decode(errors="replace"))) for k in beginnings(w)}
                yield pa.RecordBatch.from_arrays([pa.array(list(keys), pa.string()), pa.array([label] * len(keys), pa.int32())], names=["key", "label"])

    labelled = sample.filter("label IS NOT NULL")
    n = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}
    counted = labelled.mapInArrow(run, "key string, label int").groupBy("key").agg(
        F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("other")
    )
    toxic, other, share = F.col("toxic"), F.col("other"), n[1] / (n[0] + n[1])
    odds = (toxic / n[1]) / ((other + 0.5) / n[0])
    # log(0) is null in Spark; a class without the beginning adds nothing.
    parts = [x * F.log(x / ((toxic + other) * s)) for x, s in ((toxic, share), (other, 1 - share))]
    ratio = 2 * (parts[0] + F.coalesce(F.when(other > 0, parts[1]), F.lit(0.0)))
    found = counted.filter((toxic > 0) & (odds >= ODDS) & (ratio >= EVIDENCE)).select("key", ratio.alias("gain"))
    return {r.key: r.gain for r in found.collect()}


def stems(gain: dict[str, float]) -> list[str]:
    """The best beginnings, of which none begins another one: nested ones are one voter."""
    kept: set[str] = set()
    for key in sorted(gain, key=lambda k: (-gain[k], k)):
        own = key.rstrip("|")
        if any(own[:k] in kept for k in range(1, len(own) + 1)) or any(k.startswith(own) for k in kept):
            continue
        kept.add(key if key.endswith("|") and len(own) < 4 else own)
    return sorted(kept)


class Voters:
    def __init__(self, mined: list[str]):
        self.mined = {key: i for i, key in enumerate(mined)}
        self.lists = [set(listed.split()) for listed in LEXICONS.values()]
        self.patterns = [re.compile(p) for p in PATTERNS.values()]
        self.names = [*LEXICONS, *PATTERNS, *mined]

    def vote(self, text: str) -> np.ndarray:
        """Who speaks on a text, in the order of lexicons, patterns, mined stems."""
        words = set(words_of(text))
        out = np.zeros(len(self.names), bool)
        lower = text.lower()
        for i, listed in enumerate(self.lists):
            out[i] = not words.isdisjoint(listed)
        for i, pattern in enumerate(self.patterns, len(self.lists)):
            out[i] = bool(pattern.search(text if i == len(self.names) - len(self.mined) - 1 else lower))
        first = len(self.lists) + len(self.patterns)
        for word in words:
            for k in (*range(1, len(word) + 1),):
                i = self.mined.get(word[:k])
                if i is not None:
                    out[first + i] = True
        return out


# --- label model -------------------------------------------------------------


def evidence(votes: np.ndarray, log_odds: np.ndarray, correlation: np.ndarray) -> np.ndarray:
    """For each row, the log odds of those that speak, weighted by the inverse of their correlations."""
    out = np.zeros(len(votes))
    known: dict[bytes, float] = {}
    for i, row in enumerate(votes):
        key = row.tobytes()
        if key not in known:
            who = np.flatnonzero(row)
            part = correlation[np.ix_(who, who)]
            # Weights of the best linear estimate of what they have in common, never negative.
            weight = np.clip(np.linalg.solve(part, np.ones(len(who))), 0, 1) if len(who) else np.zeros(0)
            known[key] = float(weight @ log_odds[who])
        out[i] = known[key]
    return out


def label_model(votes: np.ndarray, label: np.ndarray, prior: float, rounds: int = 25) -> np.ndarray:
    """Posterior of each row; ``label`` is 0, 1, or NaN where it is to be estimated."""
    v = votes.astype(float)
    n, m = v.shape
    fixed = ~np.isnan(label)
    posterior = np.where(fixed, label, np.where(votes.any(1), 0.5, prior))
    base = math.log(prior / (1 - prior))
    for _ in range(rounds):
        q = posterior
        # A voter speaks rarely on either class until rows have shown more.
        on = (q @ v + 0.5) / (q.sum() + 10)
        off = ((1 - q) @ v + 0.05) / ((1 - q).sum() + 10)
        log_odds = np.maximum(np.log(on / off), 0)  # a voter never speaks for the other side
        shared = np.zeros((m, m))
        for weight, rate in ((q, on), (1 - q, off)):
            apart = v - rate
            shared += (apart * weight[:, None]).T @ apart
        spread = np.sqrt(np.maximum(np.diag(shared), 1e-9))
        correlation = np.clip(shared / np.outer(spread, spread), 0, 0.95)
        np.fill_diagonal(correlation, 1.0)
        # Pulled towards independence, so that it can be inverted.
        correlation = 0.9 * correlation + 0.1 * np.eye(m)
        new = sigmoid(base + evidence(votes, log_odds, correlation))
        updated = np.where(fixed, label, new)
        moved = np.abs(updated - posterior).max(initial=0)
        posterior = updated
        if moved < 1e-4:
            break
    return posterior


# --- classifier --------------------------------------------------------------


def _buckets(word: str) -> list[int]:
    return [_bucket(k) for k in beginnings(word)]


def _bucket(key: str) -> int:
    return (crc32(key.encode()) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - BITS)


def _scale(n_words: int) -> float:
    return 4 / math.sqrt(n_words + 16)


def features(text: str, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers, values) of a text's words and beginnings that fall into used buckets."""
    words = Counter(words_of(text))
    scale = _scale(sum(words.values()))
    out: Counter = Counter()
    for word, n in words.items():
        for bucket in _buckets(word):
            if used[bucket]:
                out[bucket] += n * scale
    return np.fromiter(out.keys(), np.int32, len(out)), np.fromiter(out.values(), np.float32, len(out))


class Model:
    """Linear weights per hashed beginning; a text is the sum over its words."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights, offset
        self.known: dict[str, float] = {}

    def probability(self, text: str) -> float:
        known, total, words = self.known, 0.0, words_of(text)
        for word in words:
            value = known.get(word)
            if value is None:
                if len(known) > 300_000:
                    known.clear()
                value = known[word] = float(sum(self.weights[b] for b in _buckets(word)))
            total += value
        return float(sigmoid(np.float64(total * _scale(len(words)) + self.offset)))

    def __getstate__(self) -> dict:
        return {"weights": self.weights.astype(np.float32), "offset": self.offset, "known": {}}


def described(sample: DataFrame, voters: Voters, used: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
    """(label or NaN, votes, buckets, values) of every sampled row, made in the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                decoded = text.decode(errors="replace")
                buckets, values = features(decoded, used)
                out.append((label, np.packbits(voters.vote(decoded)).tobytes(), buckets.tobytes(), values.tobytes()))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            arrays = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "votes", "buckets", "amounts"])

    schema = "label int, votes binary, buckets binary, amounts binary"
    m = len(voters.names)
    return [
        (
            math.nan if r.label is None else float(r.label),
            np.unpackbits(np.frombuffer(r.votes, np.uint8))[:m].astype(bool),
            np.frombuffer(r.buckets, np.int32),
            np.frombuffer(r.amounts, np.float32),
        )
        for r in sample.mapInArrow(run, schema).collect()
    ]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, unlabelled: int = UNLABELLED) -> Model:
    sample, sizes = training_rows(docs, labels, per_class, unlabelled)
    gain = mine(sample)
    listed = " ".join(LEXICONS.values()).split()
    voters = Voters(stems(gain))
    used = np.zeros(1 << BITS, bool)
    used[[_bucket(k) for k in gain] + [b for word in listed for b in _buckets(word)]] = True
    rows = described(sample, voters, used)
    label = np.array([r[0] for r in rows])
    both = bool((label == 0).any() and (label == 1).any())
    if not both:
        # Lexicon words and plain ones as texts of one word each, for want of labels.
        for word in [*listed, *"a the of and to in".split()]:
            rows.append((math.nan, voters.vote(word), *features(word, used)))
        label = np.append(label, [math.nan] * (len(rows) - len(label)))
    prior = float(np.clip(sizes[1] / (sizes[0] + sizes[1]), 0.005, 0.5)) if both else PRIOR
    posterior = label_model(np.array([r[1] for r in rows]).reshape(len(rows), -1), label, prior)
    weight = np.ones(len(rows))
    if both:
        # Labelled rows weigh as much as their class does outside the sample.
        for value in (0, 1):
            weight[label == value] = sizes[value] / (label == value).sum()
        weight[~np.isnan(label)] *= (~np.isnan(label)).sum() / weight[~np.isnan(label)].sum()
    certain = np.maximum(np.abs(2 * posterior - 1), 0.05)
    x = Rows([(r[2], r[3]) for r in rows])
    weights, offset = fit_logistic(x, posterior, weight * certain, 1 << BITS, l2=3e-5, steps=300)
    return Model(weights, offset)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = sent(docs.sparkSession, fit(docs, labels, per_class))

    def each(ids: list[int | None], batch: list[bytes]) -> dict[str, list]:
        scores = [shared().probability(text.decode(errors="replace")) for text in batch]
        return {
            "doc_id": ids,
            "held_out": [i is not None and crc32(str(i).encode()) % 4 == 2 for i in ids],
            "score": scores,
            "predicted": [int(score >= threshold) for score in scores],
        }

    return map_texts(docs, each, SCHEMA)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    shared = sent(docs.sparkSession, fit(docs, labels))
    return keep_rows(
        docs, lambda batch: np.array([shared().probability(t.decode(errors="replace")) < threshold for t in batch], bool)
    )
