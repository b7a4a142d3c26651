"""URL filter: domain rules first, else a logistic regression over hashed character n-grams.

Everything is DataFrame functions and Spark ML stages that run in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
GRAMS = (3, 4, 5)
FEATURES = 1 << 18
MAX_LABELLED = 20_000
THRESHOLD = 0.55  # above a half, so that urls of weak evidence stay
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """`where` is a host, from its first slash on a path: `org/`, `example.org/es/`."""

    where: str
    verdict: str


def with_parts(urls: DataFrame) -> DataFrame:
    """Add host and path. The host follows the first `://`, A-Z lower-cased, and ends at `/`, `?`,
    `#` or the end; the path goes on to `?`, `#` or the end. Both are empty without `://`."""
    rest = F.when(
        F.contains("url", F.lit("://")),
        F.substr(F.col("url"), F.locate("://", F.col("url")) + 3),
    )
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return urls.withColumns(
        {
            "host": F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")),
            "path": F.coalesce(path, F.lit("")),
        }
    )


def matching_rule(rules: Sequence[Rule]) -> Column:
    """Longest rule that fits host and path, as (where, verdict); equal lengths: block first."""
    out = F.when(F.lit(False), F.lit(None).cast("struct<rule: string, verdict: string>"))
    for rule in sorted(set(rules), key=lambda r: (-len(r.where), r.verdict != BLOCK, r.where)):
        name, slash, path = rule.where.partition("/")
        host = F.col("host")
        fits = (host == F.lit(name)) | F.endswith(host, F.lit(f".{name}"))
        value = F.struct(F.lit(rule.where).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = out.when(fits & F.startswith(F.col("path"), F.lit(slash + path)), value)
    return out


def _grams(text: Column) -> Column:
    """All character n-grams of a text with marked ends."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of(size: int) -> Column:
        last = F.char_length(marked) - F.lit(size - 1)
        cut = F.transform(
            F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
            lambda k: F.substring(marked, k, F.lit(size)),
        )
        return F.filter(cut, lambda gram: F.char_length(gram) == F.lit(size))

    return F.concat(*[of(size) for size in GRAMS])


def features(urls: DataFrame) -> DataFrame:
    """Add `_grams`: n-grams of host and path, apart from each other."""

    def tagged(part: str) -> Column:
        return F.transform(_grams(F.col(part)), lambda gram: F.concat(F.lit(part[0]), gram))

    return urls.withColumn("_grams", F.concat(tagged("host"), tagged("path")))


def train(labelled: DataFrame) -> PipelineModel:
    """Model from a small table (url, label 0 or 1), of MAX_LABELLED rows at most.

    Rows with a NULL in either are left out, other columns are ignored, repeated rows count as often
    as they stand there. Both labels weigh the same in all. A table with more rows, or with one label
    alone, is an error. The fit runs in one task, so it does not change with the partitions.
    """
    rows = labelled.select("url", F.col("label").cast("double")).dropna()
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share")).first()
    if size["n"] > MAX_LABELLED:
        raise ValueError(f"{size['n']} labelled urls; {MAX_LABELLED} at most")
    if not 0 < (size["share"] or 0) < 1:
        raise ValueError("urls of both labels are needed")
    weight = F.when(F.col("label") == 1, 0.5 / size["share"]).otherwise(0.5 / (1 - size["share"]))
    rows = features(with_parts(rows)).withColumn("_weight", weight)
    hashing = HashingTF(inputCol="_grams", outputCol="_vector", numFeatures=FEATURES, binary=True)
    regression = LogisticRegression(
        featuresCol="_vector", labelCol="label", weightCol="_weight",
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
        regParam=0.003, standardization=False, maxIter=50, tol=1e-4,
    )
    one = hashing.transform(rows).repartition(1).sortWithinPartitions("url", "label")
    return PipelineModel([hashing, regression.fit(one)])


def judge(
    pages: DataFrame, rules: Sequence[Rule], model: PipelineModel, threshold: float = THRESHOLD
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row of `pages` (page_id, url, ...).

    `rule` is NULL where none fits; the verdict then is the model's: block if its probability
    `score` is above the threshold. NULL urls have empty parts and are judged by the model like any
    other. Other columns are ignored; repeated rows give repeated results.
    """
    rows = features(with_parts(pages.select("page_id", "url")))
    score = vector_to_array("_probability")[1]
    by_model = F.when(score > F.lit(threshold), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return (
        model.transform(rows)
        .withColumn("_rule", matching_rule(rules))
        .select(
            "page_id",
            "host",
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce("_rule.verdict", by_model).alias("verdict"),
            score.alias("score"),
        )
    )
