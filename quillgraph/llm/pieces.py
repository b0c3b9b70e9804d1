"""N-best segmentation into SentencePiece pieces by A-star search over the piece lattice.

The forward Viterbi pass gives every position its best score from the left, which is the exact heuristic
of a backward search: hypotheses leave the agenda in the order of their full scores. No piece holds a
space after its first character, so the lattice of a text falls into chunks at each space that follows
another character; chunks are solved once and remembered. The n best of a text differ from its best only
in the n - 1 chunks whose runner-up is nearest, so the search over the text runs over those alone, again
backward with the exact rest. A vocabulary whose pieces do hold inner spaces makes a text one chunk.

Piece scores are the model's; where those are ranks, as in BPE vocabularies, a piece of rank r scores
-ln(1 + r), Zipf's log probability but for a constant. Characters without a piece fall back to bytes.

Defined results: a null text gives null pieces, an empty one none; a literal U+2581 falls back to bytes,
so every text decodes to itself; ties go to the segmentation found first, which depends on the text only;
repeated rows get equal results; a text of any length is one row, whose lattice is held a chunk at a time; columns with the names of results are replaced, others pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
SPACE = "▁"
#: Chunks that a worker remembers, characters of texts solved together, and cells of one lattice array.
_REMEMBER, _CHUNK, _CELLS = 160_000, 1 << 20, 400_000


@dataclass
class Vocabulary:
    """score: piece -> score, None for proper prefixes of pieces; ids: piece -> id; text: id -> UTF-8 bytes."""

    score: dict[str, float | None]
    ids: dict[str, int]
    text: list[bytes]
    bytes_from: list[int]
    byte_score: float
    chunked: bool
    longest: int

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ranks = all(sp.get_score(i) == int(sp.get_score(i)) for i in plain)
        score: dict[str, float | None] = {}
        ids, text, of_byte = {}, [b""] * n, [0] * 256
        for i in range(n):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:5], 16)
                of_byte[value], text[i] = i, bytes([value])
        for i in plain:
            piece = sp.id_to_piece(i).replace(SPACE, " ")
            ids[piece], text[i] = i, piece.encode()
            score[piece] = -log(1 - sp.get_score(i)) if ranks else sp.get_score(i)
            for k in range(1, len(piece)):
                score.setdefault(piece[:k], None)
        lowest = min(s for s in score.values() if s is not None)
        chunked = not any(" " in p.lstrip(" ") for p in ids)
        return cls(score, ids, text, of_byte, lowest - 10, chunked, max(map(len, ids)))

    def decode(self, ids) -> str:
        """The text of pieces; the space that encoding puts before a text goes."""
        return b"".join(map(self.text.__getitem__, ids)).decode()[1:]

    def alike(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether pieces spell the same bytes; what they begin and end with alike is not spelled."""
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        low = int(differ.argmax()) if differ.any() else n
        differ = a[len(a) - n + low :][::-1] != b[len(b) - n + low :][::-1]
        high = int(differ.argmax()) if differ.any() else n - low
        spell = lambda x: b"".join(map(self.text.__getitem__, x[low : len(x) - high].tolist()))
        return spell(a) == spell(b)

    def trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (node << 21 | character), the nodes that they lead to, and score and id of each node."""
        node = {"": 0}
        for prefix in sorted(self.score, key=len):
            node[prefix] = len(node)
        keys = np.asarray([node[p[:-1]] << 21 | ord(p[-1]) for p in self.score], np.int64)
        to = np.asarray([node[p] for p in self.score], np.int64)
        score, ids = np.full(len(node), np.nan), np.full(len(node), -1, np.int32)
        for p, v in self.score.items():
            if v is not None:
                score[node[p]], ids[node[p]] = v, self.ids[p]
        order = np.argsort(keys)
        return keys[order], to[order], score, ids


@dataclass
class Segmenter:
    """Remembers solved chunks: place numbers them, ranked has the n best of those that were searched.

    Between texts the memory is cut to the chunks that came up again, so it is bounded by _REMEMBER and one part's chunks."""

    vocabulary: Vocabulary
    place: dict[str, int] = field(init=False)
    ranked: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = field(init=False)

    def __post_init__(self):
        self.trie = self.vocabulary.trie()
        self.reset()

    def lattice(self, chunk: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each end the edges (start, score, ids)."""
        v = self.vocabulary
        get, n = v.score.get, len(chunk)
        edges: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, min(n, i + v.longest) + 1):
                s = get(chunk[i:j], 1.0)
                if s is None:
                    continue
                if s == 1.0 and chunk[i:j] not in v.score:
                    break
                edges[j].append((i, s, (v.ids[chunk[i:j]],)))
            if chunk[i] not in v.ids:
                raw = chunk[i].encode()
                edges[i + 1].append((i, v.byte_score * len(raw), tuple(v.bytes_from[b] for b in raw)))
        return edges

    @staticmethod
    def forward(edges: list) -> tuple[list[float], list]:
        best, back = [0.0] * len(edges), [None] * len(edges)
        for j in range(1, len(edges)):
            top = None
            for e in edges[j]:
                s = best[e[0]] + e[1]
                if top is None or s > top:
                    top, back[j] = s, e
            best[j] = top if top is not None else float("-inf")
        return best, back

    def solve(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For chunks of any length: best scores, how far each runner-up is behind, ids and their offsets.

        Viterbi forward and backward over all chunks at once, a start and a piece length at a time; the
        runner-up is the best path through any edge that the best path lacks."""
        keys, to, value, piece = self.trie
        m, longest = len(chunks), self.vocabulary.longest
        size = np.asarray([len(c) for c in chunks], np.int64)
        width = int(size.max())
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        chars = np.zeros((width + 1, m), np.int64)
        row = np.repeat(np.arange(m), size)
        chars[np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size), row] = points
        best = np.full((width + 1, m), -np.inf)
        best[0] = 0
        back, ids = np.zeros((width + 1, m), np.int32), np.zeros((width + 1, m), np.int32)
        edges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        byte_score = self.vocabulary.byte_score
        for i in range(width):
            live = np.flatnonzero(size > i)
            state = np.zeros(len(live), np.int64)
            for n in range(1, min(longest, width - i) + 1):
                key = state << 21 | chars[i + n - 1][live]
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                if n == 1:
                    # a character without a piece of its own goes as bytes
                    own = np.where(hit, value[to[at]], np.nan)
                    bare = np.flatnonzero(np.isnan(own))
                    code = chars[i, live[bare]]
                    raw = byte_score * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
                    edges[i, 0] = live[bare], raw
                    self._relax(best, back, ids, i, i + 1, live[bare], raw, -code - 1)
                hit = np.flatnonzero(hit)
                live, state = live[hit], to[at[hit]]
                if not len(live):
                    break
                score = value[state]
                full = np.flatnonzero(~np.isnan(score))
                edges[i, n] = live[full], score[full]
                self._relax(best, back, ids, i, i + n, live[full], score[full], piece[state[full]])
        every = np.arange(m)
        total = best[size, every]
        on, cur = np.zeros((width + 1, m), bool), size.copy()
        while (moving := np.flatnonzero(cur)).size:
            on[cur[moving], moving] = True
            cur[moving] = back[cur[moving], moving]
        after = np.full((width + 1, m), -np.inf)
        after[size, every] = 0
        second = np.full(m, -np.inf)
        for end in range(width, 0, -1):
            for n in range(min(longest, end) + 1):
                start = end - max(n, 1)
                if (start, n) not in edges:
                    continue
                who, score = edges[start, n]
                there = score + after[end][who]
                after[start][who] = np.maximum(after[start][who], there)
                off = np.flatnonzero(~(on[end][who] & (back[end][who] == start)))
                lacks = who[off]
                second[lacks] = np.maximum(second[lacks], best[start][lacks] + there[off])
        where, chunk = np.nonzero(on.T)[::-1]
        found = ids[where, chunk]
        bare = found < 0
        if bare.any():
            spelled = [[v] if v >= 0 else [self.vocabulary.bytes_from[b] for b in chr(-v - 1).encode("utf-8", "surrogatepass")] for v in found.tolist()]
            count = np.asarray([len(v) for v in spelled])
            flat = np.asarray([x for v in spelled for x in v], np.int32)
        else:
            count, flat = np.ones(len(found), np.int64), found
        offsets = np.concatenate([[0], np.cumsum(np.bincount(chunk, count, minlength=m).astype(np.int64))])
        return total, np.maximum(0.0, total - second), flat, offsets

    @staticmethod
    def _relax(best, back, ids, start: int, end: int, who: np.ndarray, score: np.ndarray, own: np.ndarray) -> None:
        there = best[start][who] + score
        up = np.flatnonzero(there > best[end][who])
        better = who[up]
        best[end][better] = there[up]
        back[end][better] = start
        ids[end][better] = own[up]

    def search(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of a chunk, best first: backward A-star under the forward scores."""
        edges = self.lattice(chunk)
        best, _ = self.forward(edges)
        end, count, out = len(edges) - 1, 0, []
        agenda = [(-best[end], 0, end, 0.0, None)]
        while agenda and len(out) < n:
            total, _, j, after, path = heapq.heappop(agenda)
            if j == 0:
                ids = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((-total, tuple(ids)))
                continue
            for i, s, own in edges[j]:
                count += 1
                heapq.heappush(agenda, (-(after + s + best[i]), count, i, after + s, (own, path)))
        return out

    def chunks(self, text: str) -> list[str]:
        return _CHUNKS.findall(" " + text) if self.vocabulary.chunked else [" " + text]

    def dealt(self, texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
        """The chunks of texts, those that repeat mostly once, and for each text the places of its own among them."""
        plain = [self.vocabulary.chunked and t != "" and t[0] != " " != t[-1] and "  " not in t for t in texts]
        try:
            words = pc.split_pattern(pa.array([t for t, p in zip(texts, plain, strict=True) if p], pa.large_string()), " ")
        except UnicodeEncodeError:  # half a character
            plain, words = [False] * len(texts), pa.array([], pa.list_(pa.large_string()))
        # single spaces only: each word is a chunk with the space before it
        found = words.flatten().dictionary_encode()
        chunks = [" " + w for w in found.dictionary.to_pylist()]
        own = iter(np.split(found.indices.to_numpy(), words.offsets.to_numpy()[1:-1]))
        more: dict[str, int] = {}
        places = [next(own) if p else np.asarray([more.setdefault(c, len(chunks) + len(more)) for c in (self.chunks(t) if t else [])], np.int64) for t, p in zip(texts, plain, strict=True)]
        return chunks + list(more), places

    def learn(self, chunks: list[str]) -> None:
        """Solves the chunks that are new, those of like length together."""
        new = sorted({c for c in chunks if c not in self.place}, key=len)
        size = [len(c) for c in new]
        scores, gaps, ids, firsts, n = [self.score], [self.gap], [self.ids], [self.first], len(self.ids)
        i = 0
        while i < len(new):
            # arrays of chunks times length stay small, whatever the lengths
            longest = max(12, size[i] + size[i] // 4)
            j = i + 1
            while j < len(new) and size[j] <= longest and (j - i + 1) * size[j] <= _CELLS:
                j += 1
            total, gap, flat, offsets = self.solve(new[i:j])
            scores.append(total)
            gaps.append(gap)
            ids.append(flat)
            firsts.append(offsets[1:] + n)
            n += len(flat)
            i = j
        self.place.update(zip(new, range(len(self.score), len(self.score) + len(new)), strict=True))
        self.score, self.gap, self.ids, self.first = map(np.concatenate, (scores, gaps, ids, firsts))
        self.parts = np.concatenate([self.parts, np.zeros(len(new), np.int32)])

    def reset(self) -> None:
        self.place, self.ranked = {}, {}
        self.score, self.gap = np.zeros(0), np.zeros(0)
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.parts = np.zeros(0, np.int32)

    def trim(self) -> None:
        """Forgets all but the chunks that most parts have had, at most half of what may be remembered."""
        most = _REMEMBER // 2
        keep = self.parts >= 2
        if keep.sum() > most:
            keep = self.parts > np.partition(self.parts, -most)[-most]
        size = np.diff(self.first)[keep]
        at = np.flatnonzero(keep)
        number = np.cumsum(keep) - 1
        self.ids = self.ids[np.arange(int(size.sum())) + np.repeat(self.first[at] - (np.cumsum(size) - size), size)]
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.score, self.gap, self.parts = self.score[keep], self.gap[keep], self.parts[keep] // 2
        self.place = {c: int(number[k]) for c, k in self.place.items() if keep[k]}
        self.ranked = {}

    def encode_all(self, texts: list[str], n: int = BEST) -> Iterator[list[tuple[float, np.ndarray]]]:
        """For each whole text its n best (score, ids), best first; fewer if there are fewer."""
        if len(self.place) > _REMEMBER or len(self.ids) > 8 * _REMEMBER or len(self.ranked) > _REMEMBER // 8:
            self.trim()
        chunks, places = self.dealt(texts)
        self.learn(chunks)
        at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        self.parts[at] += 1
        for own in places:
            yield self._ranked(chunks, own, at, n)

    def _ranked(self, chunks: list[str], own: np.ndarray, known: np.ndarray, n: int) -> list[tuple[float, np.ndarray]]:
        """own: a text's places among the chunks; known: where those are remembered."""
        if not len(own):
            return [(0.0, np.zeros(0, np.int32))]
        at = known[own]
        count = self.first[at + 1] - self.first[at]
        starts = np.cumsum(count) - count
        ids = self.ids[np.arange(int(count.sum())) + np.repeat(self.first[at] - starts, count)]
        score = float(self.score[at].sum())
        out = [(score, ids)]
        gap = self.gap[at]
        few = min(n - 1, int(np.isfinite(gap).sum()))
        if few < 1:
            return out
        edge = np.partition(gap, few - 1)[few - 1]
        less, equal = np.flatnonzero(gap < edge), np.flatnonzero(gap == edge)
        places = np.sort(np.concatenate([less, equal[: few - len(less)]])).tolist()
        choices = []
        for k in places:
            chunk = chunks[own[k]]
            ranked = self.ranked.get((chunk, n))
            if ranked is None:
                ranked = self.ranked[(chunk, n)] = self.search(chunk, n)
            choices.append(ranked)
        # backward over the chunks that may differ: what is left of a hypothesis is at its best
        agenda, pushed, picks = [(0.0, 0, len(places), ())], 0, []
        while agenda and len(picks) < n:
            loss, _, k, taken = heapq.heappop(agenda)
            if k == 0:
                picks.append((loss, taken))
                continue
            top = choices[k - 1][0][0]
            for r, (s, _) in enumerate(choices[k - 1]):
                pushed += 1
                heapq.heappush(agenda, (loss + top - s, pushed, k - 1, (r, *taken)))
        for loss, taken in picks[1:]:
            parts, last = [], 0
            for k, r, ranked in zip(places, taken, choices, strict=True):
                if r:
                    parts += [ids[last : starts[k]], np.asarray(ranked[r][1], np.int32)]
                    last = int(starts[k] + count[k])
            out.append((score - loss, np.concatenate([*parts, ids[last:]])))
        return out

    def encode(self, text: str, n: int = BEST) -> list[tuple[float, np.ndarray]]:
        return next(self.encode_all([text], n))


_CHUNKS = re.compile(r" +[^ ]*|[^ ]+")
_KEPT: dict[str, Segmenter] = {}


def segmenter(path: str = MODEL) -> Segmenter:
    """One for each Python worker and vocabulary."""
    if path not in _KEPT:
        _KEPT[path] = Segmenter(Vocabulary.load(path))
    return _KEPT[path]


_IDS = pa.list_(pa.int32())


def _arrow(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, np.int32), pa.int32()))


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in a row, null as empty, of about _CHUNK characters together; only one part is held as Python strings."""
    held, size = [], 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, n: int = BEST, path: str = MODEL, text: str = "text") -> DataFrame:
    """docs with nbest array<struct<score double, ids array<int>>>, best first."""
    from pyspark.sql.functions import arrow_udf

    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", _IDS)]))

    @arrow_udf("array<struct<score:double,ids:array<int>>>")
    def nbest(column: pa.Array) -> pa.Array:
        s = segmenter(path)
        none, made, at = column.is_null().to_pylist(), [], 0
        for part in _parts(column):
            best = [[{"score": v, "ids": ids} for v, ids in b] for b in s.encode_all(part, n)]
            made.append(pa.array([None if none[at + k] else b for k, b in enumerate(best)], kind))
            at += len(part)
        return pa.concat_arrays(made) if made else pa.array([], kind)

    return docs.withColumn("nbest", nbest(F.col(text)))


def decode(rows: DataFrame, ids: str = "ids", path: str = MODEL) -> DataFrame:
    """rows with decoded, the text of a column of piece ids; null where it is null."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        v = segmenter(path).vocabulary
        return pa.array([None if x is None else v.decode(x) if x else "" for x in column.to_pylist()], pa.string())

    return rows.withColumn("decoded", text(F.col(ids)))


DIGEST = "n_pieces long, best_score double, ids_sha256 string, nbest_scores array<double>, nbest_sha256 string, round_trip boolean"


def digest(docs: DataFrame, n: int = BEST, path: str = MODEL, ids: bool = False) -> DataFrame:
    """(doc_id, n_pieces, best_score, ids_sha256, nbest_scores, nbest_sha256, round_trip[, ids]) of each text.

    round_trip: each of the n best decodes to the text. A null text counts as empty here."""
    names = ["doc_id", *(c.strip().split()[0] for c in DIGEST.split(","))] + ["ids"] * ids

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = segmenter(path)
        decode, alike = s.vocabulary.decode, s.vocabulary.alike
        for batch in batches:
            at = 0
            for part in _parts(batch.column(1)):
                rows, kept = [], []
                for t, best in zip(part, s.encode_all(part, n), strict=True):
                    raw = [x.astype("<i4").tobytes() for _, x in best]
                    first = best[0][1]
                    same = decode(first.tolist()) == t and all(alike(x, first) for _, x in best[1:]) if t else True
                    rows.append((len(best[0][1]), best[0][0], hashlib.sha256(raw[0]).hexdigest(), [v for v, _ in best], hashlib.sha256(b"".join(len(x).to_bytes(8, "little") + x for x in raw)).hexdigest(), same))
                    kept.append(best[0][1])
                types = (pa.int64(), pa.float64(), pa.string(), pa.list_(pa.float64()), pa.string(), pa.bool_())
                columns = [batch.column(0)[at : at + len(part)].cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))]
                at += len(part)
                yield pa.RecordBatch.from_arrays(columns + [_arrow(kept)] * ids, names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + DIGEST + ", ids array<int>" * ids)
