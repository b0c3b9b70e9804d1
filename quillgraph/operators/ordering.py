"""Row numbers over a whole table without a window in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .identity import checkpoint_dir

_PLACE = (1 << 33) - 1


def numbered(rows: DataFrame, *by: Column | str, out: str = "number") -> DataFrame:
    """rows with their place in the order of by, from 1; ties are numbered in any order.

    Ranges are sorted where they lie and their sizes, one for each partition, give where each begins."""
    checkpoint_dir(rows)
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    sizes = dealt.groupBy(F.shiftright("__id", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, start = [], 0
    for r in sizes:
        starts.append((r.part, start))
        start += r.n
    before = dealt.sparkSession.createDataFrame(starts, "__part long, __before long")
    placed = dealt.join(F.broadcast(before), F.shiftright("__id", 33) == F.col("__part"))
    return placed.withColumn(out, F.col("__before") + F.col("__id").bitwiseAND(_PLACE) + 1).drop("__id", "__part", "__before")
