"""Segments as a stream: draft files that arrive in a folder become segments and evidence checks as they come.

The engine's stages are batch refreshes; these are the row-local ones, which need no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import text as X


def stream_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segment records (JSON lines) as they arrive, their text made comparable and hashed again."""
    rows = spark.readStream.schema(schemas.SEGMENTS).json(path)
    rows = rows.withColumn("text", X.comparable(F.col("text")))
    return rows.withColumn("sha256", X.sha256(F.col("text")))


def stream_evidence(excerpts: DataFrame, segments: DataFrame) -> DataFrame:
    """Streamed (segmentId, excerpt) that are not verbatim in their static segment."""
    text = segments.select(F.col("id").alias("segmentId"), "text")
    return excerpts.join(text, "segmentId").filter(~F.contains("text", "excerpt")).select("segmentId", "excerpt")


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
