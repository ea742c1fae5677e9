"""URL filter: host/path rules, and logistic regression on hashed character
n-grams of host and path for the urls that no rule judges.

Only DataFrame functions and Spark ML's DataFrame estimators are used; nothing
runs in Python on the executors and no step shuffles the pages.

The host runs from the first ``://`` to the next ``/``, ``?``, ``#`` or the
end, A-Z lower-cased; the path from there to the next ``?``, ``#`` or the end.
A rule ``host/path`` fits its host and every subdomain where the url's path
starts with the rule's path; the longest fitting rule wins (same length: the
one with the longer host).

The model is fitted once on a small labelled table of urls (``url, verdict``),
at most ``TRAIN_URLS`` of them, chosen by hash; scoring is a sparse dot product
per page.

Defined cases: a null url, or one without ``://``, has empty host and path and
no rule; it is scored on these.  If the labelled table lacks one of the
verdicts, every unjudged url gets the verdict it has (``allow`` if it is
empty).  Repeated rows are judged alike; only the id and the url are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: The rules of the registered query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
TRAIN_URLS = 4_000
GRAM_SIZES = (3, 4)
FEATURES = 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct(verdict, rule)`` of the longest rule that fits, else null.  The
    rules are a short list kept in the query; each is two string tests."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].find("/"))):
        cut = rule.find("/")
        name, prefix = (rule[:cut].lower(), rule[cut:]) if cut >= 0 else (rule.lower(), "")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """Character n-grams; a text shorter than n is one gram."""
    def of(n):
        last = F.greatest(F.length(text) - n + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, n))
    return F.concat(*[of(n) for n in sizes])


def features(df: DataFrame, host: str, path: str) -> DataFrame:
    """``df`` with hashed n-grams of ``^host`` and ``path$`` in ``_nx_features``.
    Host and path have disjoint grams (the marks differ)."""
    marked = (df.withColumn("_nx_h", F.concat(F.lit("\x01"), F.col(host), F.lit("\x02")))
                .withColumn("_nx_p", F.concat(F.lit("\x03"), F.col(path), F.lit("\x04"))))
    grams = marked.withColumn("_nx_grams", F.concat(
        F.transform(_grams(F.col("_nx_h"), GRAM_SIZES), lambda g: F.concat(F.lit("h"), g)),
        F.transform(_grams(F.col("_nx_p"), GRAM_SIZES), lambda g: F.concat(F.lit("p"), g))))
    tf = HashingTF(inputCol="_nx_grams", outputCol="_nx_features", numFeatures=FEATURES, binary=True)
    return tf.transform(grams).drop("_nx_h", "_nx_p", "_nx_grams")


def fit(labelled: DataFrame, limit: int = TRAIN_URLS):
    """The model, or the only verdict of the table (``allow`` if empty)."""
    sample = (labelled.where(F.col("verdict").isin(ALLOW, BLOCK)).select("url", "verdict").distinct()
              .orderBy(F.xxhash64("url"), "url", "verdict").limit(limit))
    rows = features(sample.select(host_of(F.col("url")).alias("_nx_host"), path_of(F.col("url")).alias("_nx_path"),
                                  (F.col("verdict") == BLOCK).cast("double").alias("_nx_label")),
                    "_nx_host", "_nx_path").select("_nx_features", "_nx_label").cache()
    try:
        seen = {r[0] for r in rows.select("_nx_label").distinct().collect()}
        if len(seen) < 2:
            return BLOCK if seen == {1.0} else ALLOW
        return LogisticRegression(featuresCol="_nx_features", labelCol="_nx_label", probabilityCol="_nx_prob",
                                  predictionCol="_nx_pred", rawPredictionCol="_nx_raw",
                                  maxIter=40, regParam=1e-3, standardization=False).fit(rows)
    finally:
        rows.unpersist()


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, p_block`` of each page; ``p_block``
    is the model's probability, also where a rule decides."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = (pages.select(F.col(f"`{id_col}`").alias("_nx_id"), host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("_nx_rule", longest_rule(F.col("host"), F.col("path"), rules)))
    model = fit(labelled)
    if isinstance(model, str):
        scored = rows.withColumn("p_block", F.lit(float(model == BLOCK)))
    else:
        scored = (model.transform(features(rows, "host", "path"))
                  .withColumn("p_block", vector_to_array("_nx_prob").getItem(1)))
    by_model = F.when(F.col("p_block") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(F.col("_nx_id").alias(id_col), "host", "path", F.col("_nx_rule.rule").alias("rule"),
                         F.coalesce(F.col("_nx_rule.verdict"), by_model).alias("verdict"), "p_block")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``pages``; the labelled table is the pages that a rule judges."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    url = F.col("url")
    labelled = pages.select("url", longest_rule(host_of(url), path_of(url), RULES)["verdict"].alias("verdict"))
    return judge(pages, labelled)
