"""Secret scan with a random forest that removes false positives. DataFrame functions only.

Candidates are runs of at least 16 characters of keys ([A-Za-z0-9_+/-] and '=') with a
digit, from whole texts. The forest sees, for each: its length, shares of characters and
changes between their kinds, how much of it common words cover, its look as a path, and
the words before and after it. It is trained on labelled findings
(value, before, after, label). The tables hold none, so ``label_findings`` labels the
candidates of training rows by strict forms: known key prefixes, and hexadecimal or mixed
values given to a name of a secret, are 1; plain numbers, paths, words with numbers and
values given to a harmless name are 0; others stay unlabelled and are only scored.
At most ``SAMPLE_PER_CLASS`` labelled findings of each class are used.

Edge cases: null and empty texts have no findings; a value that a text repeats is one
finding, at its first place; repeated rows each give theirs; without labelled findings of
both classes the score is that of the strict forms, else 0.5; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from authledger.llm.common import held_out, stored

SAMPLE_PER_CLASS = 2000
TREES, DEPTH, SEED = 24, 6, 7
THRESHOLD = 0.5
NEAR = 40
CANDIDATE = r"[A-Za-z0-9_+/\-]{16,}+={0,2}"
# Prefixes of published key formats, names of secrets, of harmless values, common words.
KEY_FORMS = r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^sk_(?:live|test)_[A-Za-z0-9]{16,}$|^xox[abpr]-[A-Za-z0-9-]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
SECRET_NAME = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|bearer|auth)[A-Za-z_ ]{0,12}[\"']?\s*[=:]?\s*[\"']?$"
HARMLESS_NAME = r"(?i)(?:sha\d*|md5|commit|rev(?:ision)?|hash|checksum|digest|uuid|guid|id|version|build|etag)[\"']?\s*[=:]?\s*[\"']?$"
COMMON_WORDS = (
    r"(?i)the|and|for|with|that|this|from|test|example|sample|dummy|index|image|page|file|data|user|name|value|config|"
    r"default|static|content|assets|http|www|com|net|org|html|path|lib|src|main|class|table|column|key|token|mail"
)
MEASURES = (
    "length", "digit_share", "upper_share", "lower_share", "hex", "only_digits", "changes", "vowel_share",
    "distinct_share", "covered", "slashes", "dashes", "known_form", "assigned", "quoted", "secret_before",
    "harmless_before", "letters_after",
)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, value, start, before, after): each value once per row, at its first place."""
    text = F.col("text")
    values = F.array_distinct(
        F.filter(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda v: v.rlike("[0-9]"))
    )
    begins = F.transform(values, lambda v: F.struct(v.alias("value"), F.position(v, text).alias("at")))
    near = F.transform(
        begins,
        lambda c: F.struct(
            c["value"].alias("value"),
            (c["at"] - 1).cast("long").alias("start"),
            F.substring(text, F.greatest(c["at"] - NEAR, F.lit(1)), F.least(c["at"] - 1, F.lit(NEAR))).alias("before"),
            F.substring(text, c["at"] + F.length(c["value"]), F.lit(NEAR)).alias("after"),
        ),
    )
    return docs.select("doc_id", F.explode(near).alias("c")).select("doc_id", "c.*")


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def measured(found: DataFrame) -> DataFrame:
    value, before = F.col("value"), F.col("before")
    flags = {
        "length": F.length(value).cast("double"),
        "digit_share": _share(value, "[0-9]"),
        "upper_share": _share(value, "[A-Z]"),
        "lower_share": _share(value, "[a-z]"),
        "hex": value.rlike("^[0-9a-fA-F]+$"),
        "only_digits": value.rlike("^[0-9]+$"),
        "changes": _share(value, "(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[a-z0-9]|(?<=[0-9])[A-Za-z]"),
        "vowel_share": _share(value, "[aeiouAEIOU]"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "covered": 1 - F.length(F.regexp_replace(value, COMMON_WORDS, "")) / F.length(value),
        "slashes": _share(value, "/"),
        "dashes": _share(value, "[-_]"),
        "known_form": value.rlike(KEY_FORMS),
        "assigned": before.rlike(r"[=:]\s*[\"']?$"),
        "quoted": before.rlike("[\"']$"),
        "secret_before": before.rlike(SECRET_NAME),
        "harmless_before": before.rlike(HARMLESS_NAME),
        "letters_after": F.col("after").rlike("^[.@:]?[A-Za-z0-9]"),
    }
    return found.withColumns({k: v.cast("double") for k, v in flags.items()})


def _strict() -> Column:
    mixed = (F.col("digit_share") > 0.1) & (F.col("covered") < 0.3) & (F.col("length") >= 20) & (F.col("slashes") < 0.1)
    return F.when((F.col("known_form") == 1) | ((F.col("secret_before") == 1) & (F.col("only_digits") == 0) & mixed), 1).when(
        (F.col("only_digits") == 1) | (F.col("harmless_before") == 1) | (F.col("slashes") >= 0.05) | (F.col("covered") >= 0.4), 0
    )


def label_findings(found: DataFrame) -> DataFrame:
    """(value, before, after, label) of the measured candidates of training rows that have a strict form."""
    return (
        found.filter(~held_out(F.col("doc_id")))
        .select("value", "before", "after", _strict().alias("label"))
        .filter("label IS NOT NULL")
    )


def secret_scan(
    docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD, sample: int = SAMPLE_PER_CLASS
) -> DataFrame:
    """One row per finding: doc_id, value, start (characters), score and verdict."""
    found, _ = stored(measured(candidates(docs)), "secrets")
    known = label_findings(found) if findings is None else findings
    rows = measured(
        reduce(
            DataFrame.unionByName,
            (
                known.filter(F.col("label") == k).select("value", "before", "after", "label").distinct()
                .orderBy(F.xxhash64("value", "before"), "value", "before", "after").limit(sample)
                for k in (0, 1)
            ),
        )
    )
    rows, _ = stored(rows.withColumn("label", F.col("label").cast("double")), "secrets-labelled")
    out = ["doc_id", "value", "start", "score"]
    if rows.select("label").distinct().count() < 2:
        scored = found.withColumn("score", F.coalesce(_strict().cast("double"), F.lit(0.5))).select(out)
    else:
        assembler = VectorAssembler(inputCols=list(MEASURES), outputCol="features")
        forest = RandomForestClassifier(
            labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED
        ).fit(assembler.transform(rows))
        scored = forest.transform(assembler.transform(found)).select(
            *out[:3], vector_to_array("probability")[1].alias("score")
        )
    return scored.withColumn("is_secret", F.col("score") >= threshold)
