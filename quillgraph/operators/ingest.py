"""Segments from draft segments: scope, numbering, identity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources import documents
from .ordering import numbered


def scoped(drafts: DataFrame, start: int = 1, most: int | None = None, source: str = "sourceId", pos: str = "pos") -> DataFrame:
    """Of each source the segments from the start-th on, most of them at most, numbered from 1 as ordinal."""
    place = F.row_number().over(W.partitionBy(source).orderBy(pos))
    rows = drafts.withColumn("ordinal", place - (start - 1)).filter(F.col("ordinal") >= 1)
    return rows.filter(F.col("ordinal") <= most) if most else rows


def segments(drafts: DataFrame, start: int = 1, most: int | None = None, unicode: bool = True, number: Callable[[Column], Column] = X.padded) -> DataFrame:
    """The segments table of (sourceId, pos, title, text, locator); number: how an id spells the ordinal."""
    rows = scoped(drafts, start, most).withColumn("text", X.comparable(F.col("text"), unicode))
    rows = rows.withColumn("sha256", X.sha256(F.col("text")))
    name = F.concat_ws("-", "sourceId", number(F.col("ordinal")), F.substring("sha256", 1, 10))
    title = F.coalesce(F.when(F.col("title") != "", F.col("title")), F.format_string("Segment %d", "ordinal"))
    return rows.select(name.alias("id"), "sourceId", "ordinal", title.alias("title"), "text", "sha256", "locator")


def ingest(spark: SparkSession, sources: list[dict], root: str, start: int = 1, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(sources, segments) of configured sources: dicts with id, path and kind, which may be auto."""
    listed = spark.createDataFrame([(i, s["id"], s["path"], s.get("kind", "auto")) for i, s in enumerate(sources)], "place int, sourceId string, path string, kind string")
    listed = listed.withColumn("kind", F.when(F.col("kind") == "auto", X.detect_kind(F.col("path"))).otherwise(F.col("kind")))
    files = None
    for s in sources:
        one = documents.read_files(spark, f"{root}/{s['path']}").withColumn("sourceId", F.lit(s["id"])).drop("path")
        files = one if files is None else files.unionByName(one)
    drafts = documents.drafts(listed.join(files, "sourceId"))
    found = segments(drafts, start, most)
    title = drafts.groupBy("sourceId").agg(F.first("sourceTitle").alias("title"), F.first("kind").alias("kind"), F.first("path").alias("path"), F.first("sha256").alias("sha256"))
    counts = found.groupBy("sourceId").agg(F.count(F.lit(1)).cast("int").alias("segmentCount"))
    table = title.join(counts, "sourceId", "left").join(listed.select("sourceId", "place"), "sourceId")
    table = table.select(F.col("sourceId").alias("id"), "path", "kind", "sha256", "title", F.coalesce("segmentCount", F.lit(0)).alias("segmentCount"), "place")
    return table.orderBy("place").drop("place"), found


def stratified(segments: DataFrame, most: int = 6, by: tuple[str, ...] = ("sourceId", "ordinal"), within: tuple[str, ...] = ()) -> DataFrame:
    """Up to most rows spread evenly over the order: those at round(i * (n - 1) / (most - 1)).

    Over a whole table only the keys are numbered, and the few that are wanted pick their rows."""
    if not within:
        keys = numbered(segments.select(*by), *by)
        n = keys.count()
        wanted = range(n) if n <= most else {int(i * (n - 1) / (most - 1) + 0.5) for i in range(most)}
        keys = keys.filter(F.col("number").isin([k + 1 for k in wanted])).drop("number")  # at most `most` rows
        return segments.join(F.broadcast(keys), list(by), "left_semi")
    group = W.partitionBy(*within)
    rows = segments.withColumn("__at", F.row_number().over(group.orderBy(*by)) - 1).withColumn("__n", F.count(F.lit(1)).over(group))
    # halves round up, as they do everywhere in this engine
    wanted = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.floor(i * (F.col("__n") - 1) / (most - 1) + 0.5).cast("int"))
    return rows.filter((F.col("__n") <= most) | F.array_contains(wanted, F.col("__at"))).drop("__at", "__n")
