"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds a mask at every slot, a bit for each language; AND-ing an n-gram's
slots gives the set of languages that contain it. A document's hits are counted per language, corrected
for the filter's false positives, and the largest corrected share decides.

The filter is fitted on a bounded sample: about SAMPLE distinct texts of each language, chosen by a hash
of the text, and the GRAMS most frequent n-grams of each; at most LANGUAGES languages, the most frequent, with a warning if there are more.
An n-gram counts as one of a language only if its rate there is at least RATIO of its highest rate in any,
so foreign quotations in a language's texts don't blur it.

Defined results: null texts and texts without a letter are `und` with score 0, as is everything where
nothing could be learned; a text whose n-grams are all unknown gets the language with most labels and
score 0; ties go to the first language by name; repeated rows get equal results; a text of any length counts with
all its n-grams; columns that share the
names of results are replaced, all others pass through.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lean, release, slices, utf8

SAMPLE, GRAMS, LANGUAGES = 1500, 30_000, 256
RATIO = 0.3
SLOT_BITS, HASHES, SIZE, PARTS = 20, 3, 4, 32
UNKNOWN = "und"
_CHUNK = 1 << 20

#: Lower-case letters and everything beyond ASCII stay, all else is a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, 4-byte n-gram) of folded texts framed by spaces; n-grams of spaces only are left out."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(size + 4)])  # two spaces before each text, two after
    framed = np.full(int(starts[-1]), 32, np.uint8)
    framed[np.arange(len(data)) + np.repeat(4 * np.arange(n) + 2, size)] = _FOLD[data]
    doc = np.repeat(np.arange(n, dtype=np.int32), size + 1)  # as many windows stay inside the frame
    first = np.arange(len(doc)) + np.repeat(3 * np.arange(n), size + 1)
    g = framed[first].astype(np.uint32)
    for k in range(1, SIZE):
        g |= framed[first + k].astype(np.uint32) << np.uint32(8 * k)
    kept = g != 0x20202020
    return doc[kept], g[kept]


def slots(g: np.ndarray) -> list[np.ndarray]:
    h = g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return [(h >> np.uint64(64 - SLOT_BITS * (k + 1))).astype(np.int64) & ((1 << SLOT_BITS) - 1) for k in range(HASHES)]


@dataclass
class Filter:
    """planes: for each eight languages a byte per slot; rates: the false-positive rate of each language."""

    languages: list[str]
    planes: list[np.ndarray]
    rates: np.ndarray
    fallback: int

    @classmethod
    def build(cls, members: dict[str, np.ndarray], fallback: str | None) -> Filter:
        names = sorted(members)
        planes = [np.zeros(1 << SLOT_BITS, np.uint8) for _ in range(-(-len(names) // 8))]
        rates = np.zeros(len(names))
        for i, name in enumerate(names):
            bit = np.uint8(1 << (i % 8))
            for s in slots(members[name]):
                planes[i // 8][s] |= bit
            rates[i] = np.count_nonzero(planes[i // 8] & bit) / (1 << SLOT_BITS)
        return cls(names, planes, rates**HASHES, names.index(fallback) if fallback in members else 0)

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, languages): the corrected share of each document's n-grams that a language contains."""
        docs = len(offsets) - 1
        doc, g = grams(data, offsets)
        total = np.maximum(np.bincount(doc, minlength=docs), 1)
        at = slots(g)
        hits = []
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        for plane in self.planes:
            mask = plane[at[0]]
            for s in at[1:]:
                mask &= plane[s]
            hits.append(np.bincount(doc.astype(np.int64) * 256 + mask, minlength=docs * 256).reshape(docs, 256) @ bits)
        found = np.concatenate(hits, axis=1)[:, : len(self.languages)] / total[:, None]
        return np.clip((found - self.rates) / (1 - self.rates), 0, 1)


def _has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any alphabet."""
    ascii_or_more = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False)
    return np.asarray(ascii_or_more, bool)


def fit(rows: DataFrame, sample: int = SAMPLE, keep_grams: int = GRAMS) -> Filter:
    """A filter from rows of (text, lang); rows whose text or lang is null teach nothing."""
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        warnings.warn(f"only the {LANGUAGES} most frequent languages are learned; langid.LANGUAGES bounds the filter, in which eight take 1 << SLOT_BITS bytes", stacklevel=2)
        counts = counts[:LANGUAGES]
    if not counts:
        return Filter([], [], np.zeros(0), 0)
    spark, top = rows.sparkSession, 1 << 30
    share = spark.createDataFrame([(r["lang"], min(top, -(-top * sample // r["count"]))) for r in counts], "lang string, below long")
    chosen = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(share), "lang").filter(F.pmod(F.col("h"), F.lit(top)) < F.col("below"))
    chosen = chosen.dropDuplicates(["lang", "h"]).select("lang", "text")

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            code, names = np.asarray(langs.indices, np.uint64), langs.dictionary
            data, at = utf8(batch.column(1))
            for i, j in slices(at, _CHUNK):
                doc, g = grams(data[at[i] : at[j]], at[i : j + 1] - at[i])
                key, n = np.unique(code[i:j][doc] << np.uint64(32) | g, return_counts=True)
                lang = names.take(pa.array((key >> np.uint64(32)).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([lang, pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    found = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = found.groupBy("lang").agg(F.sum("n").alias("total"))  # a row for each language
    found = found.join(F.broadcast(total), "lang").withColumn("rate", F.col("n") / F.col("total")).drop("total")
    found = found.withColumn("top", F.max("rate").over(W.partitionBy("gram"))).filter(F.col("rate") >= RATIO * F.col("top"))
    # the most frequent of each part of a language first, so that no task sorts all of a language
    parts = found.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(PARTS)))
    for group in (("lang", "part"), ("lang",)):
        best = W.partitionBy(*group).orderBy(F.desc("n"), "gram")
        parts = parts.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= keep_grams)
    table = parts.select("lang", "gram").toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    gram, code = np.asarray(table.column("gram"), np.int64).astype(np.uint32), np.asarray(names.indices)
    members = {name: gram[code == i] for i, name in enumerate(names.dictionary.to_pylist())}
    return Filter.build(members, counts[0]["lang"])


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """docs with lang_pred and score."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 32 MB: a byte a slot for eight languages
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("struct<lang_pred:string,score:double>")
    def identify(text: pa.Array) -> pa.Array:
        m = sent.value
        data, at = utf8(text)
        letters = _has_letter(text)
        best, score = np.zeros(len(text), np.int64), np.zeros(len(text))
        if m.languages:
            for i, j in slices(at, _CHUNK):
                share = m.shares(data[at[i] : at[j]], at[i : j + 1] - at[i])
                top = share.argmax(axis=1)
                score[i:j] = share[np.arange(j - i), top]
                best[i:j] = np.where(score[i:j] > 0, top, m.fallback)
        score[~letters] = 0
        release()
        names = np.asarray([*m.languages, UNKNOWN], object)
        best = np.where(letters & bool(m.languages), best, len(m.languages))
        return pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["lang_pred", "score"])

    out = docs.withColumn("__lang", identify(F.col("text")))
    return out.select(*[F.col(f"`{c}`") for c in kept], F.col("__lang.lang_pred").alias("lang_pred"), F.col("__lang.score").alias("score"))
