"""Language-model scoring by prediction by partial matching over bytes.

A trie of byte contexts up to ORDER long is counted over the whole training corpus. A symbol unseen in a
context is escaped to the next shorter one, where the symbols of the longer context are excluded. Each symbol
of a context gives DISCOUNT of its count to the escape (method D with a smaller share). As the
set of symbols after a context is always part of that after its suffix, what an escape leaves is a
property of the context and is computed once. A text's score is the log10 probability of its lower-cased
bytes and one end symbol. A unigram score over words comes beside it; the frequent words' counts are
broadcast, at most HEAVY of them, and all others are joined.

Counts of words and n-grams cover all training rows and none is left out. The n-grams are a table; contexts
that end in the same two bytes need only each other and the orders 0 and 1, which the alphabet bounds, so
the trie is built in shards by these two bytes, each of which scores its n-grams. The scores of the most
frequent n-grams are broadcast, at most MOST_GRAMS of them, and all others are joined. Scores add up as
whole parts of UNIT.

Defined results: null and empty texts hold only the end symbol; without training rows every byte is
equally likely and the base score is 0; repeated rows get equal scores; a text of any length is scored whole, its
rare n-grams and words as rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, keep, slices, utf8

ORDER, DISCOUNT = 5, 0.3
MOST_GRAMS, HEAVY = 1 << 19, 1 << 17
UNIT = 1 << 28
BEFORE, END, SYMBOLS = 0xFE, 0xFF, 256  # neither occurs in UTF-8
#: Bytes of texts worked on at once, and words, n-grams and rows that a task holds before it lets go of them.
_CHUNK, _FLUSH, _HELD, _STEP = 1 << 20, 200_000, 2_000_000, 1 << 18


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte and each text's end the last ORDER + 1 symbols as one number, the latest lowest."""
    n, size = len(offsets) - 1, np.diff(offsets)
    framed = np.full(len(data) + n * (ORDER + 1), BEFORE, np.uint8)
    framed[np.arange(len(data)) + np.repeat((ORDER + 1) * np.arange(n) + ORDER, size)] = LOWER[data]
    framed[offsets[1:] + (ORDER + 1) * np.arange(1, n + 1) - 1] = END
    last = np.arange(len(data) + n) + np.repeat(ORDER * np.arange(1, n + 1), size + 1)
    out = np.zeros(len(last), np.uint64)
    for k in range(ORDER, -1, -1):
        out <<= np.uint64(8)
        out |= framed[last - k]
    return out


def _low(x: np.ndarray, symbols: int) -> np.ndarray:
    return x & np.uint64((1 << (8 * symbols)) - 1)


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, *counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
    return keys[first], *(np.add.reduceat(n[order], first) for n in counts)


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n, held) of the longest n-grams of texts (text, learn): how often they occur in texts to learn
    from and in others; a row for each task and n-gram before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, ...]] = []

        def merged():
            return _summed(*(np.concatenate(x) for x in zip(*seen, strict=True)))

        def rows(keys, n, held):
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(held.astype(np.int64))], ["gram", "n", "held"])

        for batch in batches:
            for learn in (True, False):
                data, at = utf8(batch.column(0).filter(pc.equal(batch.column(1), learn)))
                for i, j in slices(at, _CHUNK):
                    keys, n = np.unique(grams(data[at[i] : at[j]], at[i : j + 1] - at[i]), return_counts=True)
                    seen.append((keys, n, np.zeros_like(n)) if learn else (keys, np.zeros_like(n), n))
                    if sum(len(x[0]) for x in seen) > _HELD:
                        seen[:] = [merged()]
                        if len(seen[0][0]) > _HELD // 2:
                            yield rows(*seen.pop())
        if seen:
            yield rows(*merged())

    return texts.select("text", "learn").mapInArrow(run, "gram long, n long, held long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(token, n): words of lower-cased texts, and the empty token for each text's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])
            seen.clear()
            return out

        for batch in batches:
            data, at = utf8(batch.column(0))
            for i, j in slices(at, _CHUNK):
                low = LOWER[data[at[i] : at[j]]].tobytes()
                for a, b in zip((at[i:j] - at[i]).tolist(), (at[i + 1 : j + 1] - at[i]).tolist(), strict=True):
                    seen.update(low[a:b].split())
                seen[b""] += j - i
                if len(seen) > _FLUSH:
                    yield rows()
        if seen:
            yield rows()

    return texts.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest count of which, with all larger ones, at most most rows have it or more.

    Counts above 64 go by powers of 2 ** (1 / 8), so that the histogram is of bounded size."""
    step = F.when(F.col("n") <= 64, F.col("n")).otherwise(64 + F.floor((F.log2("n") - 6) * 8)).cast("long")
    bins = sorted(((r[0], r[1], r[2]) for r in counts.groupBy(step.alias("b")).agg(F.count(F.lit(1)), F.max("n")).collect()), reverse=True)
    if sum(rows for _, rows, _ in bins) <= most:
        return 1
    total, least = 0, bins[0][2] + 1
    for b, rows, _ in bins:
        total += rows
        if total > most:
            break
        # the lowest whole count of the bin
        least = b if b <= 64 else int(np.ceil(2 ** ((b - 64) / 8 + 6) - 1e-9))
    return max(1, least)


class Trie:
    """The contexts of each order as sorted arrays."""

    def __init__(self, keys: list[np.ndarray], counts: list[np.ndarray]):
        counts = [c - DISCOUNT for c in counts]
        self.keys, self.log_count, self.contexts = keys, [np.log(c) for c in counts], []
        self.enter, self.enter_escape, self.left, self.left_escape = [], [], [], []
        kinds: list[np.ndarray] = []
        totals: list[np.ndarray] = []
        for k, (key, n) in enumerate(zip(keys, counts, strict=True)):
            context, first = np.unique(key >> np.uint64(8), return_index=True)
            total = np.add.reduceat(n, first).astype(float) if len(key) else np.zeros(0)
            kind = np.diff(np.append(first, len(key))) * DISCOUNT  # what escapes
            self.contexts.append(context)
            self.enter.append(np.log(total + kind))
            self.enter_escape.append(np.log(kind) - np.log(total + kind))
            if k:
                # what the suffix has left once this context's symbols are excluded
                gone = np.add.reduceat(counts[k - 1][np.searchsorted(keys[k - 1], _low(key, k))], first) if len(key) else np.zeros(0)
                up = np.searchsorted(self.contexts[k - 1], _low(context, k - 1))
                new = kinds[k - 1][up] - kind
                room = totals[k - 1][up] - gone + new
                with np.errstate(divide="ignore", invalid="ignore"):
                    self.left.append(np.log(room))
                    self.left_escape.append(np.where(room > 0, np.log(new) - np.log(room), 0.0))
            else:
                self.left.append(np.zeros(len(context)))
                self.left_escape.append(np.zeros(len(context)))
            kinds.append(kind)
            totals.append(total)
        self.floor = -np.log(SYMBOLS - (kinds[0][0] / DISCOUNT if len(kinds[0]) else 0))

    def predict(self, grams: np.ndarray) -> np.ndarray:
        """Natural log probability of each n-gram's last symbol after the others."""
        out, done, inside = np.zeros(len(grams)), np.zeros(len(grams), bool), np.zeros(len(grams), bool)
        room, escape = np.zeros(len(grams)), np.zeros(len(grams))
        for k in range(ORDER, -1, -1):
            context, key = _low(grams >> np.uint64(8), k), _low(grams, k + 1)
            if not len(self.contexts[k]):
                continue
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == context
            new = known & ~inside
            room[new], escape[new] = self.enter[k][at[new]], self.enter_escape[k][at[new]]
            inside |= known
            where = np.minimum(np.searchsorted(self.keys[k], key), len(self.keys[k]) - 1)
            hit = inside & ~done & (self.keys[k][where] == key)
            out[hit] += self.log_count[k][where[hit]] - room[hit]
            done |= hit
            go = inside & ~done
            out[go] += escape[go]
            room[go], escape[go] = self.left[k][at[go]], self.left_escape[k][at[go]]
        out[~done] += self.floor
        return out


class Table:
    """A hash table of n-grams' log probabilities in parts of UNIT."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(10, (2 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.value = np.zeros(1 << self.bits, np.int64)
        rest, self.probes = np.arange(len(keys)), 0
        while len(rest):
            at = self._slot(keys[rest], self.probes)
            free = self.table[at] == np.uint64(2**64 - 1)
            self.table[at[free]] = keys[rest[free]]
            placed = self.table[at] == keys[rest]
            self.value[at[placed]] = values[rest[placed]]
            rest = rest[~placed]
            self.probes += 1

    def _slot(self, key: np.ndarray, probe: int) -> np.ndarray:
        h = key * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return ((h >> np.uint64(64 - self.bits)).astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each n-gram's value, 0 if it has none, and the places of those that have none."""
        out, missing = np.zeros(len(grams), np.int64), np.ones(len(grams), bool)
        rest = np.arange(len(grams))
        for probe in range(self.probes):
            at = self._slot(grams[rest], probe)
            found = self.table[at]
            hit = found == grams[rest]
            out[rest[hit]] = self.value[at[hit]]
            missing[rest[hit]] = False
            rest = rest[~hit & (found != np.uint64(2**64 - 1))]
            if not len(rest):
                break
        return out, np.flatnonzero(missing)


def fit_trie(texts: DataFrame, most: int = MOST_GRAMS) -> Trie:
    """A trie small enough for one machine: of the n-grams of at least the count under which no order has more
    than most. score() needs no such bound and does not use it."""
    longest = keep(gram_counts(texts.select("text", F.lit(True).alias("learn"))).select("gram", "n"))
    orders = [longest.groupBy(F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram")).agg(F.sum("n").alias("n")) for k in range(ORDER)] + [longest]
    least = max(least_count(o, most) for o in orders)
    keys, counts = [], []
    for o in orders:
        kept = o.filter(F.col("n") >= least).toArrow()  # at most `most` rows
        gram, n = _summed(np.asarray(kept.column("gram"), np.int64).astype(np.uint64), np.asarray(kept.column("n"), np.int64))
        keys.append(gram)
        counts.append(n)
    return Trie(keys, counts)


def gram_logs(counts: DataFrame) -> DataFrame:
    """(gram, n, log) of every row of counts (gram, n, held): all occurrences, and the log probability in the
    trie of all n-grams that occur in texts to learn from."""
    low = counts.filter(F.col("n") > 0).groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.sum("n").alias("n")).toArrow()  # at most SYMBOLS ** 2 rows
    first = _summed(np.asarray(low.column("gram"), np.int64).astype(np.uint64), np.asarray(low.column("n"), np.int64))
    sent = counts.sparkSession.sparkContext.broadcast([_summed(_low(first[0], 1), first[1]), first])

    def rows(gram, n, held):
        known = n > 0
        longest = _summed(gram[known], n[known])
        orders = sent.value + [_summed(_low(longest[0], k + 1), longest[1]) for k in range(2, ORDER)] + [longest]
        log = Trie([k for k, _ in orders], [c for _, c in orders]).predict(gram)
        return pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(n + held), pa.array(np.rint(log * UNIT).astype(np.int64))], ["gram", "n", "log"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, limit = [], 0, _STEP
        for batch in batches:
            gram, n, held = (np.asarray(batch.column(k), np.int64) for k in range(3))
            parts.append((gram.astype(np.uint64), n, held))
            size += len(gram)
            if size >= limit:
                whole = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                shard = _low(whole[0] >> np.uint64(8), 2)
                cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on
                if cut:
                    yield rows(*(x[:cut] for x in whole))
                parts, size = [tuple(x[cut:] for x in whole)], size - cut
                limit = max(_STEP, 2 * size)
        if size:
            yield rows(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    shard = F.shiftright("gram", 8).bitwiseAND(0xFFFF)
    dealt = counts.withColumn("shard", shard).repartition("shard").sortWithinPartitions("shard")
    return dealt.select("gram", "n", "held").mapInArrow(run, "gram long, n long, log long")


def score(docs: DataFrame, training) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); training: a condition on doc_id."""
    learn = docs.filter(training).select("text")
    logs = keep(gram_logs(keep(gram_counts(docs.select("text", F.coalesce(training, F.lit(False)).alias("learn"))))))
    least_gram = least_count(logs, MOST_GRAMS)
    often = logs.filter(F.col("n") >= least_gram).toArrow()  # at most MOST_GRAMS rows
    scores = Table(np.asarray(often.column("gram"), np.int64).astype(np.uint64), np.asarray(often.column("log"), np.int64))
    words = keep(word_counts(learn))
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    below = total + 0.1 * (distinct + 1)
    least = least_count(words, HEAVY)
    heavy = words.filter(F.col("n") >= least).toArrow()  # at most HEAVY rows
    known = dict(zip(heavy.column("token").to_pylist(), np.log10((np.asarray(heavy.column("n"), np.int64) + 0.1) / below).tolist(), strict=True))
    sent = docs.sparkSession.sparkContext.broadcast((scores, known))

    kinds = {"row": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_rare": pa.int64(), "base": pa.float64(), "score": pa.int64(), "token": pa.binary(), "gram": pa.int64(), "n": pa.int64()}

    def rows(count, /, **columns):
        return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(count, t) for k, t in kinds.items()], list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, known = sent.value
        get = known.get
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i, j in slices(at, _CHUNK):
                part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
                symbols = grams(part, own)
                value, other = scores.find(symbols)
                logs = np.add.reduceat(value, own[:-1] + np.arange(j - i))
                # one row for each text and n-gram
                other_row, other = row + np.repeat(np.arange(j - i), np.diff(own) + 1)[other], symbols[other]
                order = np.lexsort((other, other_row))
                other_row, other = other_row[order], other[order]
                first = np.flatnonzero((np.diff(other_row, prepend=-1) != 0) | (np.diff(other, prepend=np.uint64(0)) != 0))
                other_n = np.diff(np.append(first, len(other)))
                low = LOWER[part].tobytes()
                n_tokens, n_rare, base, rare_row, rare_token, rare_n = [], [], [], [], [], []
                for d, (a, b) in enumerate(zip(own[:-1].tolist(), own[1:].tolist(), strict=True)):
                    tokens = low[a:b].split()
                    tokens.append(b"")
                    value = np.fromiter(map(get, tokens, repeat(np.nan)), float, len(tokens))
                    missing = np.flatnonzero(np.isnan(value)).tolist()
                    n_tokens.append(len(tokens))
                    n_rare.append(len(missing))
                    base.append(float(np.nansum(value)))
                    if missing:
                        few = Counter([tokens[m] for m in missing])
                        rare_row += [row + d] * len(few)
                        rare_token += few
                        rare_n += few.values()
                rows_of = np.arange(row, row + j - i)
                row += j - i
                yield rows(j - i, row=pa.array(rows_of), doc_id=batch.column(0)[i:j].cast(pa.int64()), held_out=batch.column(2)[i:j], n_tokens=pa.array(n_tokens, pa.int64()), n_rare=pa.array(n_rare, pa.int64()), base=pa.array(base, pa.float64()), score=pa.array(logs))
                if rare_row:
                    yield rows(len(rare_row), row=pa.array(rare_row, pa.int64()), token=pa.array(rare_token, pa.binary()), n=pa.array(rare_n, pa.int64()))
                if len(first):
                    yield rows(len(first), row=pa.array(other_row[first]), gram=pa.array(other[first].astype(np.int64)), n=pa.array(other_n))

    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_rare long, base double, score long, token binary, gram long, n long"
    marked = docs.select("doc_id", "text", F.coalesce(~training, F.lit(True)).alias("held_out"))
    both = keep(marked.mapInArrow(run, schema))  # written, so that the row numbers stay as they are
    rare = both.filter(F.col("token").isNotNull()).select("row", "token", "n")
    light = words.filter(F.col("n") < least).select("token", F.log10((F.col("n") + 0.1) / F.lit(below)).alias("log"))
    other = both.filter(F.col("gram").isNotNull()).select("row", "gram", "n")
    by_word = rare.join(light, "token").select("row", F.col("n").alias("found"), (F.col("n") * F.col("log")).alias("more"), F.lit(0).cast("long").alias("parts"))
    by_gram = other.join(logs.filter(F.col("n") < least_gram).select("gram", "log"), "gram").select("row", F.lit(0).cast("long").alias("found"), F.lit(0.0).alias("more"), (F.col("n") * F.col("log")).alias("parts"))
    found = by_word.unionByName(by_gram).groupBy("row").agg(F.sum("found").alias("found"), F.sum("more").alias("more"), F.sum("parts").alias("parts"))
    out = both.filter(F.col("n_tokens").isNotNull()).drop("token", "gram", "n").join(found, "row", "left")
    seen = F.coalesce("found", F.lit(0))
    unseen = F.col("n_rare") - seen
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_tokens") - unseen).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + unseen * F.lit(float(np.log10(0.1 / below)))).alias("base_score"),
        ((F.col("score") + F.coalesce("parts", F.lit(0))) / F.lit(float(UNIT * np.log(10)))).alias("score"),
    )
