"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source has the inclusion expectation target / source size, between 0 and the most
repeats: its whole part is taken for sure, its fractional part is a probability; rows that are equal are one
unit. The flight phase moves the probabilities along the null space of the constraints (documents, words) until one of
them is 0 or 1, first inside hashed blocks of a source, then over the few that each block leaves, level
by level, until at most two are left for each source. Each move decides the longest open document if it can,
and the others make up for it. The landing phase drops the constraints one after the other for the shortest
that are left. All moves are fair games: no draw is chosen over another, so inclusion probabilities hold.

Defined results: a null or empty text has size 0 and is taken 0 words; a null source is a source of its
own, last in order; rows that repeat count each; an empty table gives no rows; a source of size 0 has
target 0; a text of any length is only counted; ties of size go by a key of the row; columns with the names of
results are replaced in shares(), all pass through in mix().
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keep, within

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed values of the mix: weights in turn, share of all words, repeats at most.
WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
BLOCK = 512
_NEAR = 1e-9


def targets(sizes: DataFrame, weights: Iterable[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Adds target to (source, source_size, ...): shares by weight, filled up to repeats * source_size.

    One row for each source, so the windows over all of them are as small as the list of sources."""
    weights = tuple(weights)
    order = W.orderBy(F.col("source").isNull(), "source")
    s = sizes.withColumn("src", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights) + 1).cast("int")))
    s = s.withColumn("most", F.col("source_size") * float(repeats)).withColumn("ratio", F.col("most") / F.col("weight"))
    rise = W.orderBy("ratio", "src").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    s = s.withColumns({
        "full": F.coalesce(F.sum("most").over(rise), F.lit(0.0)), "full_weight": F.coalesce(F.sum("weight").over(rise), F.lit(0.0)),
        "all_weight": F.sum("weight").over(every), "all_size": F.sum("source_size").over(every),
    })
    # the level if exactly the sources before this one are full; the first that this one can hold is right
    s = s.withColumn("level", (F.col("all_size") * share - F.col("full")) / (F.col("all_weight") - F.col("full_weight")))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "src", "level"))).over(every)["level"])
    target = F.least(F.col("most"), F.coalesce(F.col("weight") * F.col("level"), F.col("most")))
    return s.withColumn("target", target).drop("weight", "most", "ratio", "full", "full_weight", "all_weight", "all_size", "level")


def _direction(p: np.ndarray, size: np.ndarray, both: bool) -> np.ndarray:
    """A move by one of the first probability that the others make up for in words, and with both in number.

    They do so in proportion to their room p (1 - p), so that the first is mostly the one that reaches its end."""
    room, rest, own = p[1:] * (1 - p[1:]), size[1:], size[0]
    v = np.ones(len(p))
    n, w, ww = room.sum(), (room * rest).sum(), (room * rest * rest).sum()
    det = n * ww - w * w
    if both and len(p) > 2 and det <= 1e-9 * n * ww and abs(n * own - w) > 1e-9 * n * own:
        # the others are all of one size and cannot make up for both: they move among themselves
        v[0], v[1:] = 0, _direction(p[1:], rest, True)
    elif both and len(p) > 2 and det > 1e-9 * n * ww:
        v[1:] = -room * ((ww - w * own) + (n * own - w) * rest) / det
    elif own and ww:
        v[1:] = -room * rest * (own / ww)
    else:  # all of the same size, or of none
        v[1:] = -room / n
    return v


def fly(p: np.ndarray, size: np.ndarray, draw, land: bool) -> np.ndarray:
    """The probabilities p (sizes falling) moved along the null space of the constraints until at most two are
    fractional; with land the constraints are dropped, the number first, then the words, until none is.

    Each move is a fair game, so every unit keeps its probability. The longest unit that is still open is
    decided first, and all others make up for it a little; those that are left to land are the shortest."""
    p = np.where((p > _NEAR) & (p < 1 - _NEAR), p, np.rint(p))
    live = np.flatnonzero((p > 0) & (p < 1))
    while len(live) > (0 if land else 2):
        q = p[live]
        v = _direction(q, size[live], True) if len(live) > 1 else np.ones(1)
        with np.errstate(divide="ignore"):
            reach = np.where(v > 0, (1 - q) / v, np.where(v < 0, -q / v, np.inf))
            back = np.where(v > 0, q / v, np.where(v < 0, (q - 1) / v, np.inf))
        up, down = reach.min(), back.min()
        q = q + v * (up if draw() < down / (up + down) else -down)
        p[live] = np.where((q > _NEAR) & (q < 1 - _NEAR), q, np.rint(q))
        live = live[(p[live] > 0) & (p[live] < 1)]
    return p


def _flight(units: DataFrame, level: int, seed: int, land: bool) -> DataFrame:
    """units: (h, src, block, size, p, ...) with p moved inside each (src, block)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "h"], ascending=[False, True], kind="stable")
        first = pdf.iloc[0]
        rng = np.random.default_rng([seed, level, int(first["src"]), int(first["block"])])
        return pdf.assign(p=fly(pdf["p"].to_numpy(float), pdf["size"].to_numpy(float), rng.random, land))

    return units.groupBy("src", "block").applyInPandas(run, units.schema)


def decide(units: DataFrame, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """units (h, src, n, size, p; n: the units of the source) with p moved to 0 or 1."""
    most = units.agg(F.max("n")).first()[0] or 0
    done, level, bound = None, 0, most
    while True:
        # a block leaves two units at most, so the next level has at most so many
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long")
        dealt = units.withColumn("block", F.pmod(F.xxhash64("h", F.lit(level)), blocks))
        land = bound <= block
        moved = keep(_flight(dealt, level, seed, land))
        whole = moved.filter((F.col("p") <= 0) | (F.col("p") >= 1))
        done = whole if done is None else done.unionByName(whole)
        if land:
            return done.drop("block", "n")
        units = moved.filter((F.col("p") > 0) & (F.col("p") < 1)).withColumn("n", 2 * F.ceil(F.col("n") / block)).drop("block")
        level, bound = level + 1, 2 * -(-bound // block)


def _key():
    """A key of a row: rows that share it are interchangeable."""
    return F.xxhash64("doc_id", F.col("text").isNull(), "text", F.col("source").isNull(), "source")


def _decided(rows: DataFrame, **options) -> DataFrame:
    """(h, rows, target, source_size, total): how often the mix takes the rows of each key, together."""
    units = keep(rows.groupBy("h").agg(F.first("source").alias("source"), F.first("size").alias("size"), F.count(F.lit(1)).alias("rows")))
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = keep(targets(sizes, **options))
    known = sources.withColumnRenamed("source", "__source")
    units = units.join(known, units["source"].eqNullSafe(known["__source"])).drop("__source", "source")
    expected = F.when(F.col("source_size") > 0, F.col("rows") * F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.withColumn("whole", F.floor(expected)).withColumn("p", expected - F.col("whole"))
    decided = decide(units)
    return decided.select("h", "rows", "target", "source_size", (F.col("whole") + F.col("p").cast("long")).alias("total"))


def shares(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, h, source, size, source_size, target, copies): how often the mix takes each document whole."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = keep(docs.select("doc_id", "source", size.alias("size"), _key().alias("h"), F.spark_partition_id().alias("part")))
    decided = keep(_decided(rows, **options))
    names = ("doc_id", "h", "source", "size", "source_size", "target")
    found = rows.join(within(decided), "h")
    alone = found.filter("rows = 1").select(*names, F.col("total").alias("copies"))
    # equal rows are numbered inside the parts that they came in, so that no task holds all of a frequent row
    again = found.filter("rows > 1").withColumn("own", F.row_number().over(W.partitionBy("h", "part").orderBy("part")))
    parts = again.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("h").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    number = F.col("own") + F.col("before")
    again = again.join(parts.select("h", "part", before.alias("before")), ["h", "part"])
    extra = (number <= F.col("total") % F.col("rows")).cast("long")
    return alone.unionByName(again.select(*names, (F.floor(F.col("total") / F.col("rows")) + extra).alias("copies")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it, with their own columns only.

    Rows that are alike are interchangeable: one of them comes as often as the mix takes any of them."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    taken = _decided(docs.select("source", size.alias("size"), _key().alias("h")), **options)
    taken = keep(taken.filter(F.col("total") > 0).select(F.col("h").alias("__h"), F.col("total").alias("__copies"), F.col("rows").alias("__rows")))
    out = docs.withColumn("__h", _key()).join(within(taken), "__h")
    both = out.filter(F.col("__rows") == 1).unionByName(out.filter(F.col("__rows") > 1).dropDuplicates(["__h"]))
    return both.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
