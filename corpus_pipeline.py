"""A corpus pipeline of five stages over documents, each written and read again before the next.

Every stage works on all that the one before kept. All but the last return the columns of documents.
Defined results: an empty table passes through every stage as one; null or letterless texts go in the
first stage; rows alike in id and text count as copies of one document in the second; of documents that tie, the
smallest id stays; texts of any length are scanned, mixed and encoded whole; the columns of documents alone pass
through, so no name can clash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm import langid, mixing, neardup, pieces, secrets
from quillgraph.llm.common import keep, table, within

#: Documents of which a smaller share of n-grams belongs to the best language are rejected.
LEAST_SCORE = 0.25
#: Documents of this similarity of their five-word shingles, in percent, or more are near duplicates.
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the filter learns from a bounded sample of their labels."""
    found = langid.predict(docs, langid.fit(docs))
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, or any if none has one."""
    found = keep(neardup.near_duplicates(docs, NEAR_PERCENT))
    stay = found.filter("kept").groupBy(F.coalesce("label", "h").alias("g")).agg(F.min("h").alias("__h"))
    stay = keep(stay.select("__h").distinct())
    keys = keep(found.groupBy(F.col("h").alias("__h")).agg(F.count(F.lit(1)).alias("__rows")))
    gone = keep(keys.join(stay, "__h", "left_anti").select("__h"))
    again = keep(keys.filter(F.col("__rows") > 1).join(stay, "__h", "left_semi").select("__h"))
    # few go and fewer still are alike: mostly the texts stay where they are
    rows = docs.withColumn("__h", F.xxhash64("doc_id", "text")).join(within(gone), "__h", "left_anti")
    alone, alike = rows.join(within(again), "__h", "left_anti"), rows.join(within(again), "__h", "left_semi")
    return alone.unionByName(alike.dropDuplicates(["__h"])).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; n_chars follows the text."""
    out = secrets.redact(docs.withColumn("__was", F.length("text")))
    return out.withColumn("n_chars", F.col("n_chars") + F.coalesce(F.length("text") - F.col("__was"), F.lit(0))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by source weights takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document's best segmentation, and digests of the n best."""
    return pieces.digest(docs, ids=True)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("mix", mix), ("encode", encode)]

#: The stages learn, sketch, draw and search: SQL can't express them, so tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = keep(docs)
    return docs
