"""Near-duplicate detection with SetSketch registers.

A document's set holds the distinct 64-bit fingerprints of its five-word shingles. Register i is the
minimum of an exponential variable over the set, on a scale of powers of B, truncated to 0 .. Q + 1; it
is mergeable by maximum, and equal with about the probability of the Jaccard similarity. Bands of
registers bring candidates together, the likelihood of how their registers compare prunes them, and
links are confirmed on the full sets.

Documents with equal sets form one class first. In each band's bucket every class is compared with the
bucket's most central one; then only pairs whose classes are still in different components are compared,
so no pair inside a component is ever listed again. Buckets of more than SMALL classes, where all such
pairs would be too many, are replaced by an exact filter: the shingles of their classes are ordered by how
few classes have them, and two sets can only be linked if the first that they share leaves enough
behind it in both. The least similarity of a link is a parameter, from which the number of bands and the
margin below it follow: pairs are dropped if their likely similarity is six standard errors less, and a pair
of just that similarity meets in some band with a probability of at least 1 - MISSED.

Defined results: null and empty texts and those of white space only have no shingles and are their own
component; texts under five words have their whole sequence as one shingle; ties go to the smaller
doc_id; rows that repeat a doc_id form one class only if their sets are equal; without a doc_id a row is kept
only if its class and component have none; a text of any length is one set; other columns are ignored or pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Words, drop, keep, lean, mix, slices, utf8, within
from .graph import components

SIZE, BANDS, ROWS = 5, 25, 5
REGISTERS, MISSED = BANDS * ROWS, 5e-7
#: SetSketch parameters: base, rate and the largest register value.
B, A, Q = 1.001, 20.0, 65534
PERCENT = 85
SMALL, BLOCK, GROUP = 16, 256, 64
_CHUNK = 1 << 20

_RNG = np.random.default_rng(20)
_TURN = _RNG.integers(1, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _maps(registers: int) -> tuple[np.ndarray, np.ndarray]:
    """A multiplier and a summand for each register."""
    rng = np.random.default_rng(21)
    return rng.integers(1, 2**63, registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, registers, dtype=np.uint64)


class Level(NamedTuple):
    """What follows from the least similarity of a link, in percent."""

    percent: int
    bands: int
    registers: int
    margin: float

    @classmethod
    def of(cls, percent: int) -> Level:
        if not 0 < percent < 100:
            raise ValueError("percent must lie between 0 and 100")
        least = percent / 100
        count = int(np.ceil(np.log(MISSED) / np.log1p(-(least**ROWS))))
        error = np.sqrt(least * (1 - least) / (count * ROWS))
        return cls(percent, count, count * ROWS, max(0.0, float(np.floor(100 * (least - 6 * error)) / 100)))


def sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle fingerprints of each text, concatenated, and their n + 1 offsets."""
    words = Words(data, offsets)
    n = words.count
    made = np.where(n >= SIZE, n - SIZE + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(n)), made)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(made) - made, made) + first[doc]
    held = np.concatenate([words.hash, np.zeros(SIZE, np.uint64)])
    value = np.zeros(len(doc), np.uint64)
    for k in range(SIZE):
        # a short text has no words after its own
        value += np.where(start + k < first[doc + 1], held[start + k], np.uint64(k + 1)) * _TURN[k]
    value = mix(value)
    at, parts = np.concatenate([[0], np.cumsum(made)]), []
    for i in range(len(n)):
        parts.append(np.unique(value[at[i] : at[i + 1]]))
    return np.concatenate(parts) if parts else value, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def sketches(values: np.ndarray, offsets: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """(sets, registers) of uint16; an empty set has zeros."""
    full = np.flatnonzero(np.diff(offsets))
    multiply, add = _maps(registers)
    out = np.zeros((len(offsets) - 1, registers), np.uint16)
    if not len(full):
        return out
    starts = offsets[full]
    low = np.empty((len(full), registers), np.uint64)
    step = np.flatnonzero(np.diff(starts // (1 << 16), prepend=-1))  # pieces that stay in the cache
    for i, j in zip(step, np.append(step[1:], len(full)), strict=True):
        piece = values[starts[i] : (starts[j] if j < len(full) else len(values))]
        at = starts[i:j] - starts[i]
        for r in range(registers):
            low[i:j, r] = np.minimum.reduceat(piece * multiply[r] + add[r], at)
    # 0 < u < 1 is the least of as many uniform variables as the set has members
    x = -np.log1p(-(low.astype(float) + 1) / 2.0**64 * (1 - 1e-12)) / A
    out[full] = np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1)
    return out


def likely(n_a: np.ndarray, n_b: np.ndarray, more: np.ndarray, less: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The most likely Jaccard similarity, given sizes and in how many registers one is above the other."""
    if len(n_a) > 1024:  # in parts, each a table of 101 columns
        return np.concatenate([likely(*(x[i : i + 1024] for x in (n_a, n_b, more, less)), registers) for i in range(0, len(n_a), 1024)])
    n_a, n_b = n_a.astype(float)[:, None], n_b.astype(float)[:, None]
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    grid = np.minimum(np.linspace(0, 1, 101)[None, :], np.minimum(u / v, v / u))
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)
    above, below = p(u - v * grid), p(v - u * grid)
    tiny = 1e-9
    score = more[:, None] * np.log(above + tiny) + less[:, None] * np.log(below + tiny) + (registers - more - less)[:, None] * np.log(np.maximum(1 - above - below, tiny))
    return np.take_along_axis(grid, score.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sizes_allow(n_a, n_b, percent):
    return 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)


def described(docs: DataFrame, registers: int) -> DataFrame:
    """(doc_id, h, n, low, high, sketch): each row's key, set size, 128-bit set hash and registers."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(2))
            for i, j in slices(at, _CHUNK):
                values, own = sets(data[at[i] : at[j]], at[i : j + 1] - at[i])
                hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(values[a:b].tobytes()) for a, b in zip(own[:-1], own[1:], strict=True)), np.int64).reshape(-1, 2)
                found = sketches(values, own, registers)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j].cast(pa.int64()), batch.column(1)[i:j], pa.array(np.diff(own)), pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.array([x.tobytes() for x in found], pa.binary())], ["doc_id", "h", "n", "low", "high", "sketch"])

    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, n long, low long, high long, sketch binary")


def bands(classes: DataFrame, count: int) -> DataFrame:
    """(key, node): a row for each band of each class."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(m, count, ROWS).astype(np.uint64)
            key = np.arange(count, dtype=np.uint64)[None, :] + np.uint64(1)
            for k in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, :, k])
            node = np.repeat(np.asarray(batch.column(0), np.int64), count)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().astype(np.int64)), pa.array(node)], ["key", "node"])

    return classes.select("node", "sketch").mapInArrow(run, "key long, node long")


def _promising(pairs: DataFrame, classes: DataFrame, level: Level) -> DataFrame:
    """(a, b) whose sizes allow a link and whose registers make it likely enough."""
    side = lambda s: classes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"s_{s}"))
    fit = pairs.join(side("a").drop("s_a"), "a").join(side("b").drop("s_b"), "b").filter(100 * F.least("n_a", "n_b") >= level.percent * F.greatest("n_a", "n_b"))
    both = fit.select("a", "b", "n_a", "n_b").join(side("a").drop("n_a"), "a").join(side("b").drop("n_b"), "b")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(m, level.registers) for k in (4, 5))
            good = likely(np.asarray(batch.column(2)), np.asarray(batch.column(3)), (x > y).sum(axis=1), (x < y).sum(axis=1), level.registers) >= level.margin
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))], ["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _members(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, members): the full sets of nodes (node), which are keys of rows, made from their texts again.

    Where the nodes are few enough to be broadcast, no other text is shuffled."""
    texts = docs.select(F.xxhash64("doc_id", "text").alias("node"), "text").join(within(nodes), "node").dropDuplicates(["node"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i, j in slices(at, _CHUNK):
                values, own = sets(data[at[i] : at[j]], at[i : j + 1] - at[i])
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array([values[a:b].tobytes() for a, b in zip(own[:-1], own[1:], strict=True)], pa.binary())], ["node", "members"])

    return keep(texts.mapInArrow(run, "node long, members binary"))


def _linked(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The sets of b travel to those of a, at most GROUP together, so a class that many are compared with
    is copied to as many tasks as it needs."""
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("salts"))
    left = groups.join(held.withColumnRenamed("node", "a"), "a").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("a", "salt", F.lit(None).cast("long").alias("b"), "members")
    right = pairs.join(groups, "a").join(held.withColumnRenamed("node", "b"), "b").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b", "members")
    # each group's own set comes first, then those that are compared with it, in one stream
    dealt = left.unionByName(right).repartition(F.col("a"), F.col("salt")).sortWithinPartitions(F.col("a"), F.col("salt"), F.col("b").asc_nulls_first())

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            a, b, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i, x in enumerate(batch.column(2)):
                members = np.frombuffer(x.as_py(), np.uint64)
                if b[i] is None:
                    own = members
                    continue
                at = np.minimum(np.searchsorted(own, members), len(own) - 1)
                common = int((own[at] == members).sum())
                out.append(100 * common >= percent * (len(own) + len(members) - common))
            rows = [i for i, v in enumerate(b) if v is not None]
            hit = [r for r, good in zip(rows, out, strict=True) if good]
            yield pa.RecordBatch.from_arrays([pa.array([a[r] for r in hit], pa.int64()), pa.array([b[r] for r in hit], pa.int64())], ["a", "b"])

    return dealt.select("a", "b", "members").mapInArrow(compare, "a long, b long")


def _open(rows: DataFrame) -> DataFrame:
    """rows (key, node, label, r, n) of keys that hold several components, with how many rows each has.

    The keys are written first: few are broadcast, and joined to a written table the rows of a frequent key can be split."""
    keys = rows.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("rows"))
    keys = keep(keys.filter(F.col("x") != F.col("y")).select("key", "rows"))
    return rows.join(within(keys), "key").select("key", "node", "label", "r", "n", "rows")


def _enough(n_a, r_a, n_b, r_b, percent, least=min):
    """Whether sets of n_a and n_b can be linked if the first that they share is the r-th of each."""
    return (100 + percent) * (1 + least(n_a - r_a, n_b - r_b)) >= percent * (n_a + n_b)


def _listed(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of different components in keys of few rows."""
    few = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("node", "label", "r", "n"))).alias("all"))
    good = lambda x, y: (y["node"] > x["node"]) & (y["label"] != x["label"]) & _enough(x["n"], x["r"], y["n"], y["r"], percent, F.least)
    listed = F.flatten(F.transform("all", lambda x: F.transform(F.filter("all", lambda y: good(x, y)), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))
    return few.select(F.explode(listed).alias("p")).select("p.a", "p.b")


def _blocked(rows: DataFrame, classes: DataFrame, level: Level) -> DataFrame:
    """The same for keys of many rows, in blocks of about BLOCK, and only pairs that are likely enough."""
    many = rows.join(classes.select("node", "sketch"), "node")
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    many = many.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    many = many.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "r", "n", "sketch")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        x, y = pdf[pdf["own"] == i], pdf[pdf["own"] == j]
        found = []
        registers = np.frombuffer(b"".join(y["sketch"]), np.uint16).reshape(len(y), level.registers)
        node, label, n, place = (y[c].to_numpy(np.int64) for c in ("node", "label", "n", "r"))
        for a, own, size, at, sketch in zip(x["node"], x["label"], x["n"], x["r"], x["sketch"], strict=True):
            mine = np.frombuffer(sketch, np.uint16)
            r = np.flatnonzero((label != own) & _sizes_allow(n, size, level.percent) & _enough(n, place, size, at, level.percent, np.minimum) & ((node > a) if i == j else True))
            if len(r):
                good = likely(np.full(len(r), size), n[r], (mine > registers[r]).sum(axis=1), (mine < registers[r]).sum(axis=1), level.registers) >= level.margin
                found.append((np.minimum(a, node[r][good]), np.maximum(a, node[r][good])))
        return pd.DataFrame({"a": np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]), "b": np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])})

    return many.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long")


def _rarest(nodes: DataFrame, classes: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """(key, node, label, r, n): of each node the rarest shingles, one of which a linked set must share, as keys, and their places.

    Of n shingles a linked set shares at least percent % of n, so it shares one of the n less that, plus
    one, that come first in any one order. Those that no other node has are left out."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                held = batch.column(1)[i : i + 64].to_pylist()
                node = np.repeat(np.asarray(batch.column(0)[i : i + 64], np.int64), [len(x) // 8 for x in held])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.frombuffer(b"".join(held), np.int64))], ["node", "key"])

    tokens = keep(held.join(nodes.select("node"), "node", "left_semi").mapInArrow(run, "node long, key long"))
    common = keep(tokens.groupBy("key").agg(F.count(F.lit(1)).alias("df")))
    ranked = tokens.join(common, "key").withColumn("r", F.row_number().over(W.partitionBy("node").orderBy("df", "key")))
    reach = classes.select("node", "n", (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).alias("reach"))
    return ranked.filter(F.col("df") > 1).join(reach, "node").filter(F.col("r") <= F.col("reach")).join(nodes, "node").select("key", "node", "label", "r", "n")


def _across(met: DataFrame, classes: DataFrame, labels: DataFrame, tried: DataFrame, held: DataFrame, level: Level) -> DataFrame:
    """Candidate pairs (a < b) that share a bucket but no component yet."""
    labelled = met.join(within(labels), "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"), F.lit(1).alias("r"), F.lit(0).cast("long").alias("n"))
    rows = keep(_open(keep(labelled)))
    small = _listed(rows.filter(F.col("rows") <= SMALL), level.percent)
    nodes = keep(rows.filter(F.col("rows") > SMALL).select("node", "label").distinct())
    if not nodes.isEmpty():
        rare = keep(_open(keep(_rarest(nodes, classes, held, level.percent))))
        small = small.unionByName(_listed(rare.filter(F.col("rows") <= SMALL), level.percent))
        large = _blocked(rare.filter(F.col("rows") > SMALL), classes, level).distinct().join(tried, ["a", "b"], "left_anti")
    small = _promising(small.distinct().join(tried, ["a", "b"], "left_anti"), classes, level)
    return small if nodes.isEmpty() else small.unionByName(large).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, h, n_shingles, component_id, label, kept) for every row of docs (doc_id, text); sets of a
    similarity of percent or more are linked. label tells components apart, also those without a doc_id or with
    the same one; rows without shingles have none."""
    level = Level.of(percent)
    rows = keep(described(docs, level.registers))
    classes = rows.filter(F.col("n") > 0).groupBy("low", "high").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("first"), F.min("n").alias("n"), F.min_by("sketch", "h").alias("sketch"))
    classes = keep(classes.select(F.col("first.h").alias("node"), F.col("first.h").alias("h"), "first.doc_id", "low", "high", "n", "sketch"))
    banded = keep(bands(classes, level.bands))
    several = keep(banded.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1))
    met = keep(banded.join(within(several), "key"))
    drop(banded)
    # the class that shares most buckets is the centre of each that it is in
    weight = keep(met.groupBy("node").agg(F.sum("rows").alias("weight")))
    nodes = within(weight)
    held = _members(weight.select("node"), docs)
    # from here on only classes that share a bucket matter, and their registers are looked up often
    near = keep(classes.join(nodes.select("node"), "node", "left_semi"))
    weighed = met.join(nodes, "node")
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", F.bitwise_not("node").alias("minus"))).alias("top")).select("key", F.bitwise_not("top.minus").alias("centre"))
    star = met.join(within(keep(centre)), "key").filter(F.col("node") != F.col("centre")).select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    star = keep(_promising(star, near, level))
    first = keep(_linked(star, held, percent))
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = keep(_across(met, near, components(first), tried, held, level))
    links = keep(first if rest.isEmpty() else first.unionByName(_linked(rest, held, percent)))
    for table in (held, met, near):
        drop(table)
    labels = components(links)
    # classes are named by a key of their text, as a doc_id can have several; a component's name is its smallest doc_id; classes without one have none to give
    named = classes.select("low", "high", "node", "doc_id").join(within(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(names, "label").select("low", "high", "component_id", "label")
    # rows without shingles meet nobody, however many they are
    out = rows.filter(F.col("n") > 0).drop("sketch").join(named, ["low", "high"])
    bare = rows.filter(F.col("n") == 0).drop("sketch").withColumns({"component_id": F.col("doc_id"), "label": F.lit(None).cast("long")})
    out = out.unionByName(bare)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "h", F.col("n").alias("n_shingles"), component.alias("component_id"), F.when(F.col("n") > 0, F.col("label")).alias("label"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
