"""Removal of repeated passages with sharded suffix arrays.

A byte goes if a WINDOW-byte string that also starts anywhere else covers it. Equal windows share their
anchor (see anchors), so a window is compared only with those in contexts of the same anchor fingerprint:
1. every text yields its anchors, each with a hash of its context, the union of its windows;
2. contexts that occur more than once are repeated as a whole and need no comparison;
3. the distinct contexts of a fingerprint go to the same shard; its suffix array is built by induced
   sorting, and permuted common prefixes of WINDOW or more mark the windows that repeat;
4. a fingerprint with more than MOST_CONTEXTS distinct contexts would make its shard too large: its
   windows are counted by 64-bit fingerprints instead, which combines before it is shuffled;
5. marked windows are joined back to the anchors of all texts, and the texts lose what they cover.
All rows take part, and shards have about SHARD bytes each however many rows there are.

Passages of over fifty words, as words and not as bytes, are told beside that: windows of WORDS words (lower-cased
A-Z, cut at white space) meet by anchors of their own, in the same tables and the same pass over the texts, and
windows of differing contexts are compared in shards by 64-bit fingerprints. They are reported, not removed.

Defined results: null and empty texts stay empty; overlapping occurrences count, also within a text; each
of several equal rows is a repetition of the others; removed runs that touch are one; texts shorter than
WINDOW lose nothing; texts of 16 MB or more are anchored in parts; columns named like results are replaced in remove(), all others pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import WINDOW, WORDS, anchors, piece_hash, prefix, word_anchors, word_sums
from .common import FEW, SPACES, Words, drop, groups, keep_mapped, lean, slices, utf8
from .suffixes import common_prefixes, suffix_array

SHARD, MOST_CONTEXTS = 1_500_000, 6000
_CHUNK = (2 << 20) - 2  # with one more it is under a power of two, to which powers() rounds up


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and last places of the true runs of a mask."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


_ANCHORS = "h long, fp long, context long, start int, windows int, size int, words boolean"


def anchored(docs: DataFrame) -> DataFrame:
    """(h, fp, context, start, windows, size, words): each row's anchors, written; start and size of its context in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            key = np.asarray(batch.column(0))
            for i, j in slices(at, _CHUNK):
                if at[j] - at[i] >= 1 << 24:  # one text: cut where windows may overlap, anchors stay whole
                    yield from _long(data[at[i] : at[j]], int(key[i]))
                    continue
                part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
                doc, fp, start, count, context = anchors(part, own)
                yield _rows(key[i:j][doc], fp, context, start, count, count + WINDOW - 1, False)
                w = Words(part, own)
                first, fp, count, context = word_anchors(w.doc, w.hash)
                doc, size = w.doc[first], w.end[first + count + WORDS - 2] - w.start[first]
                yield _rows(key[i:j][doc], fp, context, w.start[first] - own[doc], count, size, True)

    return keep_mapped(docs.select("h", "text"), run, _ANCHORS)


def _rows(key, fp, context, start, count, size, words: bool) -> pa.RecordBatch:
    columns = [*(pa.array(c.astype(np.int64)) for c in (key, fp, context)), *(pa.array(c.astype(np.int32)) for c in (start, count, size)), pa.array(np.full(len(key), words))]
    return pa.RecordBatch.from_arrays(columns, ["h", "fp", "context", "start", "windows", "size", "words"])


def _long(data: np.ndarray, key: int) -> Iterator[pa.RecordBatch]:
    """Anchors of one very long text, in parts that share no window; a context cut by a part's end is two."""
    step = 8 << 20
    for a in range(0, len(data), step):
        part = data[a : a + step + WINDOW - 1]
        _, fp, start, count, context = anchors(part, np.asarray([0, len(part)]))
        yield _rows(np.full(len(fp), key), fp, context, start + a, count, count + WINDOW - 1, False)
    a, held = 0, [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
    while a < len(data):
        b = min(len(data), a + step)
        while b < len(data) and not SPACES[data[b]]:  # no word is cut
            gap = np.flatnonzero(SPACES[data[b : b + step]])
            b = b + int(gap[0]) if len(gap) else min(len(data), b + step)
        w = Words(data[a:b], np.asarray([0, b - a]))
        start, end, hashes = (np.concatenate([x, y]) for x, y in zip(held, (w.start + a, w.end + a, w.hash), strict=True))
        first, fp, count, context = word_anchors(np.zeros(len(hashes), np.int64), hashes)
        yield _rows(np.full(len(fp), key), fp, context, start[first], count, end[first + count + WORDS - 2] - start[first], True)
        held = [x[max(0, len(hashes) - WORDS + 1) :] for x in (start, end, hashes)]  # no window is whole in these
        a = b


def _pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, context, windows, shard, piece, words) of wanted (fp, context, h, start, windows, size, words, shard): the contexts' bytes, written.

    The piece of words is the fingerprints of its windows, eight bytes each."""
    cuts = wanted.groupBy("h").agg(F.collect_list(F.struct("fp", "context", "start", "windows", "size", "words", "shard")).alias("cuts"))
    keys = keep_mapped(wanted.select("h").distinct())
    rows = docs.select("h", "text")
    if keys.count() <= FEW:  # no other text is shuffled then
        rows = rows.join(F.broadcast(keys), "h", "left_semi")
    rows = rows.join(cuts, "h").dropDuplicates(["h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(0))
            lists = batch.column(1)
            first = np.asarray(lists.offsets, np.int64)
            first = first - first[0]
            fp, context, start, windows, size, words, shard = lists.flatten().flatten()  # unlike field(), it heeds an offset
            doc = np.repeat(np.arange(len(lists)), np.diff(first))
            begin = at[doc] + np.asarray(start, np.int64)
            end = begin + np.asarray(size, np.int64)
            step = 4096
            for i in range(0, len(doc), step):
                part = slice(i, i + step)
                is_words = words[part].to_numpy(zero_copy_only=False)
                own = [data[a:b].tobytes() for a, b in zip(begin[part].tolist(), end[part].tolist(), strict=True)]
                if is_words.any():
                    spelled = [own[k] for k in np.flatnonzero(is_words)]
                    edges = np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
                    w = Words(np.frombuffer(b"".join(spelled), np.uint8), edges)
                    whole = np.flatnonzero(w.doc[: max(0, len(w.doc) - WORDS + 1)] == w.doc[WORDS - 1 :])
                    sums, inverse = word_sums(w.hash)
                    hashes = piece_hash(sums, inverse, whole, whole + WORDS)
                    cut = np.searchsorted(w.doc[whole], np.arange(len(spelled) + 1))
                    for k, a, b in zip(np.flatnonzero(is_words), cut[:-1], cut[1:], strict=True):
                        own[k] = hashes[a:b].tobytes()
                yield pa.RecordBatch.from_arrays([fp[part], context[part], windows[part], shard[part], pa.array(own, pa.binary()), words[part]], ["fp", "context", "windows", "shard", "piece", "words"])

    return keep_mapped(rows.select("text", "cuts"), run, "fp long, context long, windows int, shard long, piece binary, words boolean")


def _marked(shard: pa.Table) -> pa.Table:
    """(fp, context, low, high) of a shard of bytes: runs of repeated windows, by its suffix array."""
    shard = shard.combine_chunks()
    windows = np.asarray(shard.column("windows"), np.int64)
    text = b"\x00".join(shard.column("piece").to_pylist())
    # 0 ends the string, 1 stands between contexts, bytes follow
    size = windows + WINDOW - 1
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    s = np.empty(len(text) + 1, np.uint16)
    s[:-1] = np.frombuffer(text, np.uint8)
    s += 2
    s[start[1:] - 1] = 1
    s[-1] = 0
    sa = suffix_array(s, 258)
    plcp, phi = common_prefixes(s, sa)
    hit = plcp >= WINDOW
    hit[phi[hit]] = True
    # only windows inside a context count, not what reaches over its end
    inside = np.zeros(len(s) + 1, np.int32)
    np.add.at(inside, start, 1)
    np.add.at(inside, start + windows, -1)
    hit &= np.cumsum(inside[:-1]) > 0
    low, high = _runs(hit)
    at = np.searchsorted(start, low, "right") - 1
    take = lambda c: shard.column(c).combine_chunks().take(pa.array(at))
    return pa.table([take("fp"), take("context"), pa.array((low - start[at]).astype(np.int32)), pa.array((high - start[at]).astype(np.int32))], ["fp", "context", "low", "high"])


def _matched(shard: pa.Table) -> pa.Table:
    """(fp, context, null, again) of a shard of words: how many windows of each context stand in another one as well."""
    shard = shard.combine_chunks()
    pieces = shard.column("piece").to_pylist()
    context = np.repeat(np.arange(len(pieces)), [len(p) // 8 for p in pieces])
    hashes = np.frombuffer(b"".join(pieces), np.uint64)
    order = np.lexsort((context, hashes))
    hashes, context = hashes[order], context[order]
    new = np.diff(hashes, prepend=~hashes[:1]) != 0
    group = np.cumsum(new) - 1
    kinds = np.bincount(group, new | (np.diff(context, prepend=-1) != 0))
    times = np.bincount(group)
    # within one context, too: a passage can repeat in the same text
    again = np.bincount(context, (kinds[group] > 1) | (times[group] > 1), minlength=len(pieces)).astype(np.int32)
    hit = np.flatnonzero(again)
    return pa.table([shard.column("fp").take(pa.array(hit)), shard.column("context").take(pa.array(hit)), pa.nulls(len(hit), pa.int32()), pa.array(again[hit])], ["fp", "context", "low", "high"])


def _compared(sharded: DataFrame) -> DataFrame:
    """(fp, context, low, high, words), written: what _marked and _matched tell of the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in groups(batches, "shard"):
            words = shard.column("words")[0].as_py()
            found = (_matched if words else _marked)(shard)
            yield from found.append_column("words", pa.array(np.full(len(found), words))).to_batches()

    return keep_mapped(sharded.repartition("shard").sortWithinPartitions("shard"), run, "fp long, context long, low int, high int, words boolean")


def _matched_many(pieces: DataFrame) -> DataFrame:
    """(fp, context, again), as _matched, for fingerprints of very many contexts, by counting windows, which combines before it is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                held = batch.column(2)[i : i + 1024].to_pylist()
                row = pa.array(np.repeat(np.arange(i, i + len(held)), [len(p) // 8 for p in held]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(np.frombuffer(b"".join(held), np.int64))], ["fp", "context", "window"])

    every = keep_mapped(pieces.select("fp", "context", "piece"), run, "fp long, context long, window long")
    again = every.groupBy("fp", "window").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return every.join(again, ["fp", "window"]).groupBy("fp", "context").agg(F.count(F.lit(1)).cast("int").alias("again"))


def _counted(pieces: DataFrame) -> DataFrame:
    """(fp, context, low, high), as _marked, for fingerprints of very many contexts, by counting window fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column(2)[i].as_py(), np.uint8)
                sums, inverse = prefix(data)
                at = np.arange(len(data) - WINDOW + 1)
                n = len(at)
                hashes = piece_hash(sums, inverse, at, at + WINDOW)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, batch.column(0)[i].as_py())), pa.array(np.full(n, batch.column(1)[i].as_py())), pa.array(at.astype(np.int32)), pa.array(hashes.astype(np.int64))], ["fp", "context", "low", "window"])

    every = keep_mapped(pieces.select("fp", "context", "piece"), run, "fp long, context long, low int, window long")
    again = every.groupBy("fp", "window").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return every.join(again, ["fp", "window"]).select("fp", "context", "low", F.col("low").alias("high"))


def repeated(docs: DataFrame) -> DataFrame:
    """(h, spans array<struct<low, high>>, passages) of docs (h, text), for rows that have any: runs of repeated window
    starts in bytes, and how many windows of words repeat."""
    rows = anchored(docs)
    contexts = rows.groupBy("words", "fp", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h", "start", "windows", "size")).alias("first"))
    contexts = contexts.select("words", "fp", "context", "n", "first.*")
    shared = contexts.groupBy("words", "fp").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("rows")).filter("rows > 1").select("words", "fp", "kinds")
    marked = keep_mapped(contexts.join(shared, ["words", "fp"]))
    several = marked.filter("kinds > 1")
    bulk = {r.words: r.size for r in several.groupBy("words").agg(F.sum(F.when(F.col("words"), 8 * F.col("windows")).otherwise(F.col("size") + 1)).alias("size")).collect()}
    # shards of bytes come before those of words
    byte_shards, word_shards = (max(1, (bulk.get(k) or 0) // size) for k, size in ((False, SHARD), (True, SHARD // 8)))
    own = F.when(F.col("words"), byte_shards + F.pmod(F.xxhash64("fp"), F.lit(word_shards))).otherwise(F.pmod(F.xxhash64("fp"), F.lit(byte_shards)))
    several = several.withColumn("shard", F.when(F.col("kinds") <= MOST_CONTEXTS, own))
    pieces = _pieces(docs, several.select("fp", "context", "h", "start", "windows", "size", "words", "shard"))
    few = F.col("shard").isNotNull()
    compared, many = _compared(pieces.filter(few)), pieces.filter(~few)
    spans = compared.filter(~F.col("words")).drop("words").unionByName(_counted(many.filter(~F.col("words"))))
    told = compared.filter("words").select("fp", "context", F.col("high").alias("again")).unionByName(_matched_many(many.filter("words")))
    twice = marked.filter("n > 1")
    whole = twice.filter(~F.col("words")).select("fp", "context", F.lit(0).alias("low"), (F.col("windows") - 1).alias("high"))
    # contexts that occur twice are repeated as a whole, whatever the comparison of the others has found
    once = told.join(twice.filter("words").select("fp", "context"), ["fp", "context"], "left_anti").select("fp", "context", F.lit(None).cast("int").alias("low"), F.col("again").alias("high"))
    every = twice.filter("words").select("fp", "context", F.lit(None).cast("int").alias("low"), F.col("windows").alias("high"))
    spans = spans.unionByName(whole).withColumn("words", F.lit(False))
    spans = keep_mapped(spans.unionByName(once.unionByName(every).withColumn("words", F.lit(True))))
    drop(pieces)
    drop(compared)
    drop(marked)
    placed = rows.select("h", "fp", "context", "start", "words").join(spans, ["words", "fp", "context"])
    span = F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
    # a set, as rows with equal h bring the same anchors
    found = placed.groupBy("h").agg(F.collect_set(F.when(~F.col("words"), span)).alias("spans"), F.collect_set(F.when(F.col("words"), F.struct("start", "high"))).alias("told"))
    return found.select("h", "spans", F.aggregate("told", F.lit(0).cast("long"), lambda n, x: n + x["high"]).alias("passages"))


_NAMES = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "passage_windows")
_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, passage_windows long"


def remove(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """docs with kept (the bytes that remain, with_text only), n_bytes, n_removed, n_spans, kept_sha256 and
    passage_windows: how many runs of WORDS words of a text start anywhere else as well.

    kept is binary: a removed run may begin inside a character."""
    names = [c for c in docs.columns if c not in ("kept", *_NAMES) and (with_text or c != "text")]
    keyed = docs.withColumn("__h", F.xxhash64("doc_id", "text"))
    found = keep_mapped(repeated(keyed.filter(F.length("text") > 0).select(F.col("__h").alias("h"), "text")).select(F.col("h").alias("__h"), F.col("spans").alias("__spans"), F.col("passages").alias("__passages")))
    # texts without a span are described where they are, without Python; if few have any, the others are not shuffled
    if found.count() <= FEW:
        keys = F.broadcast(found.select("__h"))
        touched = keyed.join(keys, "__h", "left_semi").join(found, "__h")
        bare = keyed.join(keys, "__h", "left_anti").withColumns({"__spans": F.lit(None).cast(found.schema["__spans"].dataType), "__passages": F.lit(0).cast("long")})
        joined = touched.unionByName(bare)
    else:
        joined = keyed.join(found, "__h", "left")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("text")
            data, at = utf8(batch.column(k))
            lists = batch.column(batch.schema.get_field_index("__spans"))
            n_removed, n_spans, digest, kept = [], [], [], []
            for i in range(batch.num_rows):
                text = data[at[i] : at[i + 1]]
                cut = np.zeros(len(text) + 1, np.int32)
                low, high = lists[i].values.flatten()
                np.add.at(cut, np.asarray(low, np.int64), 1)
                np.add.at(cut, np.asarray(high, np.int64) + WINDOW, -1)
                gone = np.cumsum(cut[:-1]) > 0
                rest = text[~gone].tobytes()
                n_removed.append(int(gone.sum()))
                n_spans.append(len(_runs(gone)[0]))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_text else None)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            columns += [pa.array(np.diff(at)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string()), batch.column(batch.schema.get_field_index("__passages"))] + [pa.array(kept, pa.binary())] * with_text
            yield pa.RecordBatch.from_arrays(columns, [*names, *_NAMES] + ["kept"] * with_text)

    shape = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in names]).schema]
    schema = ", ".join([*shape, _RESULT] + ["kept binary"] * with_text)
    cut = joined.filter(F.size("__spans") > 0).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, "text"])], "__spans", "__passages").mapInArrow(run, schema)
    raw = F.coalesce("text", F.lit("")).cast("binary")
    plain = joined.filter(~F.coalesce(F.size("__spans") > 0, F.lit(False))).select(*[F.col(f"`{c}`") for c in names], F.octet_length(raw).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"), F.coalesce("__passages", F.lit(0)).cast("long").alias("passage_windows"), *[raw.alias("kept")] * with_text)
    return cut.unionByName(plain)
