"""Collection of externally produced responses, one for each segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..sources import documents


class CollectError(ValueError):
    pass


def responses_in(spark: SparkSession, path: str) -> DataFrame:
    """(name, extraction columns) of a directory with one JSON file for each segment."""
    rows = spark.read.schema(schemas.EXTRACTIONS).option("mode", "FAILFAST").option("multiLine", True).json(path)
    return rows.select(F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("name"), *[f.name for f in schemas.EXTRACTIONS])


def recorded(spark: SparkSession, path: str, key: str, schema: T.StructType = schemas.EXTRACTIONS) -> DataFrame:
    """(name, ...) of the entries of a recordings file whose key begins with key and a colon."""
    outer = T.StructType([T.StructField("responses", T.MapType(T.StringType(), T.VariantType()))])
    rows = documents.read_json(spark, path, outer).select(F.explode("responses").alias("key", "value")).filter(F.col("key").startswith(f"{key}:"))
    value = F.from_json(F.to_json("value"), schema, {"mode": "FAILFAST"}).alias("v")
    return rows.select(F.substring("key", len(key) + 2, 1 << 30).alias("name"), value).select("name", "v.*")


def raw_in(spark: SparkSession, path: str) -> DataFrame:
    """(name, response) of the same directory: the files' text as it is."""
    rows = spark.read.option("wholetext", True).text(path).withColumn("file", F.col("_metadata.file_name"))
    return rows.filter(F.col("file").endswith(".json")).select(F.regexp_replace("file", r"\.json$", "").alias("name"), F.col("value").alias("response"))


def raw_recorded(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(name, response) of the entries of a recordings file whose key begins with key and a colon; of key itself, name is empty."""
    outer = T.StructType([T.StructField("responses", T.MapType(T.StringType(), T.VariantType()))])
    rows = documents.read_json(spark, path, outer).select(F.explode("responses").alias("key", "value"))
    rows = rows.filter((F.col("key") == key) | F.col("key").startswith(f"{key}:"))
    return rows.select(F.substring("key", len(key) + 2, 1 << 30).alias("name"), F.to_json("value").alias("response"))


def collect(segments: DataFrame, responses: DataFrame) -> DataFrame:
    """The extractions table in source order; every segment must have its response, others are ignored.

    A response that names another segment, or none for a segment, raises."""
    wanted = segments.select(F.col("id").alias("name"), "sourceId", "ordinal")
    joined = wanted.join(responses, "name", "left")
    bad = joined.filter(~F.col("segmentId").eqNullSafe(F.col("name"))).select("name", "segmentId").orderBy("name").limit(5).collect()
    if bad:
        raise CollectError("; ".join(f"no response for {r.name}" if r.segmentId is None else f"response for {r.name} names {r.segmentId}" for r in bad))
    return joined.orderBy("sourceId", "ordinal").select(*[f.name for f in schemas.EXTRACTIONS])


def missing(segments: DataFrame, responses: DataFrame) -> DataFrame:
    return segments.select(F.col("id").alias("name")).join(responses, "name", "left_anti")


def with_defaults(extractions: DataFrame) -> DataFrame:
    """Absent lists as empty ones, on the top level and in entities."""
    out = extractions
    for name in ("plotBeats", "themes", "entities", "relationships", "passages", "openQuestions"):
        kind = out.schema[name].dataType
        out = out.withColumn(name, F.coalesce(name, F.array().cast(kind)))
    entity = lambda e: e.withField("aliases", F.coalesce(e["aliases"], F.array().cast("array<string>"))).withField("claims", F.coalesce(e["claims"], F.array().cast("array<struct<text:string,certainty:string,excerpt:string>>"))).withField("attributes", F.coalesce(e["attributes"], F.parse_json(F.lit("{}"))))
    passage = lambda p: p.withField("entities", F.coalesce(p["entities"], F.array().cast("array<string>")))
    return out.withColumn("entities", F.transform("entities", entity)).withColumn("passages", F.transform("passages", passage))


def work_items(segments: DataFrame, instructions: str, taxonomy_json: str, directory: str = "work") -> DataFrame:
    """(path, content) of a prompt for each segment."""
    content = F.concat(F.lit(f"# Extraction work item\n\n{instructions}\n\n## Taxonomy\n\n{taxonomy_json}\n\n## Segment "), F.col("id"), F.lit("\n\n### "), F.col("title"), F.lit("\n\n"), F.col("text"), F.lit("\n"))
    return segments.select(F.concat(F.lit(f"{directory}/"), F.col("id"), F.lit(".md")).alias("path"), content.alias("content"))
