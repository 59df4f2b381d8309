"""Mixing to target weights with soft domain membership. DataFrame functions only.

1. Domains are classes of the labelled table: ``clean``, ``low`` (quality 0) and ``toxic``.
   Beginnings of words that one domain's labelled rows have far more often than the
   others' are counted on a bounded sample. A multinomial logistic regression over the share
   of words with such a beginning and simple text measures gives every document its
   posteriors p. They are plain SQL expressions.
2. Every document has a rate r of at least its least rate. The rates minimise the squared
   misses of the expected domain totals S = sum(p * tokens * r) from the targets. A
   projected-gradient step moves r by p * step and back to the least rate; the step is the
   gradient scaled by the Gram matrix of the documents whose rate is free, sum(tokens * p p'),
   and halved until the potential, whose gradient the misses are, has fallen enough. It needs one aggregation over
   (tokens, p) for the totals and the matrix; rates need no storage, as they are
   max(least, 1 + p * steps so far).
3. Steps go on until every total is within ``TOLERANCE`` of its target. Targets that no
   rates reach (a least rate that alone exceeds one) end it as well: ``miss``, the largest
   relative miss, stands in every row, and ``mix`` warns beyond ``ALLOWED``.
4. A document is repeated floor(r + u) times, u in [0, 1) a hash of its row.

Targets share out ``budget`` times all tokens, or in ``mix`` the least that they can all be
reached with. There, a document that is likelier clean than not has the least rate 1, so that
none is lost, and others 0.

Edge cases: null and empty texts have no tokens and the posteriors of an empty text;
repeated rows count each; without labelled rows of two domains all posteriors are equal, and
misses are as they are; an empty table gives an empty result; other columns are not read, and
``mix`` keeps them, whatever their names.
"""

from __future__ import annotations

import warnings
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from authledger.llm.common import held_out, stored

DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.80, "low": 0.18, "toxic": 0.02}
# Where toxic documents have been dropped before, their domain has no target.
KEPT_TARGETS = {"clean": 0.82, "low": 0.18}
SAMPLE_PER_DOMAIN = 1500
BUDGET = 1.1
STEPS, TOLERANCE, ALLOWED = 60, 1e-6, 0.01
# A beginning marks a domain if its rows have it so many times more often than the others', beyond
# chance by a likelihood ratio statistic of EVIDENCE.
ODDS, EVIDENCE = 4.0, 28.0
LENGTHS = (4, 5, 6, 7)
MEASURES = ("words", "symbols", "upper", "lines", "variety", *(f"marks{k}" for k in range(1, len(DOMAINS))))


def _words(docs: DataFrame) -> DataFrame:
    """(doc_id, u, body, words): the text, and its runs between white space in lower case."""
    body = F.coalesce("text", F.lit(""))
    row_hash = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 24))
    return docs.select(
        "doc_id", (row_hash / F.lit(float(1 << 24))).alias("u"), body.alias("body"), F.split(F.lower(body), r"\s+").alias("words")
    )


def domain_marks(rows: DataFrame) -> dict[int, list[str]]:
    """For each domain but the first, the beginnings that mark it in the sampled (domain, words) rows."""
    sizes = {r.domain: r["count"] for r in rows.groupBy("domain").count().collect()}
    total = sum(sizes.values())
    if len(sizes) < 2:
        return {}
    starts = F.array(*(F.when(F.length("w") >= n, F.substring("w", 1, n)) for n in LENGTHS))
    keys = (
        rows.select("domain", F.monotonically_increasing_id().alias("row"), F.explode(F.array_distinct("words")).alias("w"))
        .filter("w RLIKE '^[^0-9|#*$%&<>!]{4}'")
        .select("domain", "row", F.explode(F.array_compact(starts)).alias("key")).distinct()
    )
    counted = keys.groupBy("key").agg(
        F.count("*").alias("n"), *(F.count_if(F.col("domain") == k).alias(f"n{k}") for k in range(1, len(DOMAINS)))
    )
    out = {}
    for k in range(1, len(DOMAINS)):
        if not sizes.get(k) or sizes[k] == total:
            continue
        own, other, share = F.col(f"n{k}"), F.col("n") - F.col(f"n{k}"), sizes[k] / total
        odds = (own / sizes[k]) / ((other + 0.5) / (total - sizes[k]))
        ratio = 2 * (own * F.log(own / (F.col("n") * share)) + F.when(other > 0, other * F.log(other / (F.col("n") * (1 - share)))).otherwise(0.0))
        out[k] = sorted(r.key for r in counted.filter((own > 0) & (odds >= ODDS) & (ratio >= EVIDENCE)).select("key").collect())
    return out


def candidates(marks: dict[int, list[str]]) -> Column:
    """The words that may have a marking beginning of any domain: each is looked up once, by the
    shortest beginning, and only those found are compared with the marks of every domain and length."""
    shortest = sorted({key[: LENGTHS[0]] for keys in marks.values() for key in keys})
    if not shortest:
        return F.array().cast("array<string>")
    return F.filter("words", lambda w: F.substring(w, 1, LENGTHS[0]).isin(shortest))


def measures(marks: dict[int, list[str]]) -> list[Column]:
    """The measures of one whole text, and its tokens (runs between white space)."""
    size = F.length("body") + F.lit(1)
    n = F.greatest(
        F.size("words") - (F.element_at("words", 1) == "").cast("int") - (F.element_at("words", -1) == "").cast("int"), F.lit(0)
    )

    def share(pattern: str) -> Column:
        return F.regexp_count("body", F.lit(pattern)) / size

    def marked(keys: list[str]) -> Column:
        by_length = {length: [key for key in keys if len(key) == length] for length in LENGTHS}

        def hit(w: Column) -> Column:
            return reduce(lambda x, y: x | y, (F.substring(w, 1, length).isin(found) for length, found in by_length.items() if found))

        if not keys:
            return F.lit(0.0)
        return F.least(F.size(F.filter("candidates", hit)) * 100.0 / F.sqrt(n + F.lit(16.0)), F.lit(50.0))

    return [
        n.cast("long").alias("tokens"),
        F.log1p(n.cast("double")).alias("words"),
        share("[#*$%&<>|!]").alias("symbols"),
        share("[A-Z]").alias("upper"),
        share("\n").alias("lines"),
        (F.size(F.array_distinct("words")) / F.greatest(n, F.lit(1))).alias("variety"),
        *(marked(marks.get(k, [])).alias(f"marks{k}") for k in range(1, len(DOMAINS))),
    ]


def posteriors(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_DOMAIN) -> tuple[DataFrame, str]:
    """(doc_id, tokens, u, p0, p1, p2), stored."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    known = (
        labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", domain.alias("domain")).filter("domain IS NOT NULL")
        .groupBy("doc_id").agg(F.min("domain").alias("domain"), F.max("domain").alias("other"))
        .filter("domain = other").select("doc_id", F.col("domain").cast("double").alias("domain"))
    )
    chosen, _ = stored(
        reduce(
            DataFrame.unionByName,
            (known.filter(F.col("domain") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in range(len(DOMAINS))),
        ),
        "mixing-chosen",
    )
    # At most ``sample`` ids of each domain.
    words = _words(docs)
    marks = domain_marks(stored(words.join(F.broadcast(chosen), "doc_id").select("domain", "words"), "mixing-words")[0])
    found = words.withColumn("candidates", candidates(marks))
    base, _ = stored(found.select("doc_id", "u", *measures(marks)), "mixing-measures")
    rows, _ = stored(base.join(F.broadcast(chosen), "doc_id"), "mixing-sample")
    shares = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    found = {r.domain: r["count"] for r in rows.groupBy("domain").count().collect()}
    logits = [F.lit(0.0)] * len(DOMAINS)
    if len(found) > 1:
        weight = F.create_map(*(F.lit(float(x)) for k, n in found.items() for x in (k, shares[k] / n)))
        vectors = VectorAssembler(inputCols=list(MEASURES), outputCol="features").transform(
            rows.withColumn("weight", weight[F.col("domain")])
        )
        model = LogisticRegression(
            labelCol="domain", weightCol="weight", family="multinomial", regParam=1e-4, maxIter=60
        ).fit(vectors)
        seen = model.numClasses
        w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        logits = [
            reduce(lambda x, j: x + F.lit(float(w[k, j])) * F.col(MEASURES[j]), range(len(MEASURES)), F.lit(float(b[k])))
            if k < seen
            else F.lit(-30.0)
            for k in range(len(DOMAINS))
        ]
    top = F.greatest(*logits)
    scaled = base.select("doc_id", "tokens", "u", *((z - top).alias(f"z{k}") for k, z in enumerate(logits)))
    total = reduce(lambda x, y: x + y, (F.exp(f"z{k}") for k in range(len(DOMAINS))))
    return stored(
        scaled.select("doc_id", "tokens", "u", *((F.exp(f"z{k}") / total).alias(f"p{k}") for k in range(len(DOMAINS)))),
        "mixing-posteriors",
    )


def _p() -> list[Column]:
    return [F.col(f"p{k}") for k in range(len(DOMAINS))]


def rates(
    members: DataFrame, targets: dict[str, float], budget: float | None, least: Column | float = 0.0
) -> tuple[Column, dict[str, tuple[float, float]], float]:
    """The rate as an expression over p, (expected total, target) of each domain, and the largest relative miss.

    Domains without a target are left as they come. Without a ``budget``, the totals are the
    least that leave room for the least rates.
    """
    names = [d for d in DOMAINS if d in targets]
    p, least = [_p()[DOMAINS.index(d)] for d in names], least if isinstance(least, Column) else F.lit(float(least))
    size = len(names)

    def sums(raw: Column) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals, the Gram matrix of the documents whose rate is not held at its least, and the
        potential whose gradient the totals are."""
        rate, free = F.greatest(least, raw), F.when(raw >= least, F.col("tokens")).otherwise(0)
        potential = F.when(raw >= least, raw * raw / 2).otherwise(least * raw - least * least / 2)
        row = members.agg(
            *(F.sum(F.col("tokens") * p[k] * rate).alias(f"s{k}") for k in range(size)),
            *(F.sum(free * p[j] * p[k]).alias(f"g{j}{k}") for j in range(size) for k in range(j, size)),
            F.sum(F.col("tokens") * potential).alias("potential"),
        ).first()
        gram = [[row[f"g{min(j, k)}{max(j, k)}"] or 0.0 for k in range(size)] for j in range(size)]
        return np.array([row[f"s{k}"] or 0.0 for k in range(size)]), np.array(gram), row["potential"] or 0.0

    def raw_of(moved: np.ndarray) -> Column:
        return reduce(lambda x, k: x + p[k] * F.lit(float(moved[k])), range(size), F.lit(1.0))

    share = np.array([targets[d] for d in names]) / sum(targets.values())
    at_least, mass = sums(least)[0], sums(F.lit(1.0))[0]
    if budget is None:
        budget = max([1.0, *(1.02 * at_least / np.maximum(share * mass.sum(), 1e-9))])
    goal = share * budget * mass.sum()
    scale = np.maximum(goal, 1e-9 * max(mass.sum(), 1.0))

    def misses(total: np.ndarray) -> float:
        return float(np.abs((total - goal) / scale).max()) if mass.sum() else 0.0

    moved = np.zeros(size)
    total, gram, potential = sums(raw_of(moved))
    for _ in range(STEPS):
        if misses(total) <= TOLERANCE:
            break
        # A little of the identity, for domains that no free document belongs to.
        step = np.linalg.solve(gram + (1e-9 * np.trace(gram) + 1e-12) * np.eye(size), goal - total)
        for _ in range(30):
            tried = moved + step
            new_total, new_gram, new_potential = sums(raw_of(tried))
            gained = (potential - goal @ moved) - (new_potential - goal @ tried)
            if gained >= 1e-4 * step @ (goal - total):
                break
            step = step / 2
        else:
            break
        moved, total, gram, potential = tried, new_total, new_gram, new_potential
    listed = dict(zip(names, zip(total.tolist(), goal.tolist(), strict=True), strict=True))
    return F.greatest(least, raw_of(moved)), listed, misses(total)


def _result(members: DataFrame, rate: Column, miss: float) -> DataFrame:
    return members.select(
        "doc_id", "tokens", *(F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(DOMAINS)),
        rate.alias("rate"), F.floor(rate + F.col("u")).cast("int").alias("copies"), F.lit(miss).alias("miss"),
    )


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    budget: float = BUDGET,
    least_rate: float = 0.0,
) -> DataFrame:
    """(doc_id, tokens, posteriors by domain, rate, copies, miss) of every document."""
    members, _ = posteriors(docs, labels)
    rate, _, miss = rates(members, targets, budget, least_rate)
    return _result(members, rate, miss)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = KEPT_TARGETS, allowed: float = ALLOWED) -> DataFrame:
    """The documents, each as often as its rate says; clean ones at least once.

    Rows that repeat an id are one document here: they share the largest rate. Warns if a
    domain's expected total misses its target by more than ``allowed``.
    """
    members, _ = posteriors(docs, labels)
    p = _p()
    likely_clean = reduce(lambda x, k: x & (p[0] >= p[k]), range(1, len(DOMAINS)), F.lit(True))
    rate, totals, miss = rates(members, targets, None, F.when(likely_clean, 1.0).otherwise(0.0))
    if miss > allowed:
        warnings.warn(f"no rates reach the targets, (expected, target) tokens by domain: {totals}", stacklevel=2)
    many = _result(members, rate, miss).filter("copies <> 1 AND doc_id IS NOT NULL")
    copies, _ = stored(many.groupBy("doc_id").agg(F.max("copies").alias("copies")), "mixing-copies")
    # The row travels as one struct, so that none of its columns can clash.
    joined = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).join(
        copies, F.col("row.doc_id") == F.col("doc_id"), "left"
    )
    times = F.explode(F.array_repeat(F.lit(1), F.coalesce("copies", F.lit(1)))).alias("again")
    return joined.select("row", times).select("row.*")
