"""Lossless WebP (VP8L): a full decoder to pixel arrays and an encoder for grey 8-bit samples.

The decoder reads prefix codes (simple and normal), meta prefix groups, back-references with the
two-dimensional distance codes and the colour cache, and inverts the predictor, cross-colour,
subtract-green and palette transforms. Where a single group holds literals only, token positions are
found by a table over all bit positions and the pixels are gathered at once; anything else goes
through the token loop.

Defined results: null and empty texts count as an empty payload, padded to one row; payloads of more
than 16384 rows become several RIFF files in a row; a broken stream raises ValueError in decode() and
gives null pixels in decode_media(); repeated rows give equal results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import utf8

WIDTH, MOST_ROWS = 192, 16384
LONGEST = 15
#: Fixed values of the format: the order in which lengths of the code length code are stored.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Neighbours by distance code: nearest first, then small |dx| first, right before left.
NEIGHBOURS = sorted(((dx, dy) for dy in range(8) for dx in range(-7, 9) if dy or dx > 0), key=lambda v: (v[0] ** 2 + v[1] ** 2, abs(v[0]), v[0] < 0))
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)


# ---------------------------------------------------------------- prefix codes


def code_lengths(counts: list[int], longest: int = LONGEST) -> list[int]:
    """Lengths of a prefix code for the counts, none above longest."""
    used = [i for i, c in enumerate(counts) if c]
    lengths = [0] * len(counts)
    if len(used) == 1:
        lengths[used[0]] = 1
    floor = 1
    while len(used) > 1:
        heap = [(max(counts[i], floor), n, (i,)) for n, i in enumerate(used)]
        heapq.heapify(heap)
        depth = dict.fromkeys(used, 0)
        n = len(used)
        while len(heap) > 1:
            a, _, left = heapq.heappop(heap)
            b, _, right = heapq.heappop(heap)
            for i in left + right:
                depth[i] += 1
            heapq.heappush(heap, (a + b, n, left + right))
            n += 1
        if max(depth.values()) <= longest:
            for i, d in depth.items():
                lengths[i] = d
            break
        floor = floor * 2 + max(counts) // (1 << longest)  # flatter counts make shorter codes
    return lengths


def canonical(lengths: list[int]) -> list[int]:
    """The code of each symbol, first bit lowest as it is stored."""
    codes, code = [0] * len(lengths), 0
    by = sorted((n, i) for i, n in enumerate(lengths) if n)
    last = 0
    for n, i in by:
        code <<= n - last
        last = n
        codes[i] = int(f"{code:0{n}b}"[::-1], 2)
        code += 1
    return codes


class Prefix:
    """A decoding table: entry = symbol << 4 | length, indexed by the next bits."""

    def __init__(self, lengths: list[int]):
        used = [i for i, n in enumerate(lengths) if n]
        if not used:
            raise ValueError("a prefix code without symbols")
        if len(used) == 1:
            self.bits, self.table = 0, np.asarray([used[0] << 4], np.int32)
        else:
            if sum(1 << (LONGEST - n) for n in lengths if n) != 1 << LONGEST:
                raise ValueError("a prefix code that is not complete")
            self.bits = max(lengths)
            self.table = np.zeros(1 << self.bits, np.int32)
            codes = canonical(lengths)
            for i in used:
                self.table[codes[i] :: 1 << lengths[i]] = i << 4 | lengths[i]
        self.mask = (1 << self.bits) - 1


class Reader:
    def __init__(self, data: bytes):
        self.data, self.at, self.end = data, 0, 8 * len(data)

    def peek(self) -> int:
        i = self.at >> 3
        return int.from_bytes(self.data[i : i + 8], "little") >> (self.at & 7)

    def read(self, n: int) -> int:
        out = self.peek() & ((1 << n) - 1)
        self.at += n
        if self.at > self.end:
            raise ValueError("the stream ends early")
        return out

    def symbol(self, code: Prefix) -> int:
        entry = int(code.table[self.peek() & code.mask])
        self.at += entry & 15
        if self.at > self.end:
            raise ValueError("the stream ends early")
        return entry >> 4

    def code(self, size: int) -> Prefix:
        lengths = [0] * size
        if self.read(1):
            two = self.read(1)
            first = self.read(8 if self.read(1) else 1)
            for s in [first, self.read(8)] if two else [first]:
                lengths[s] = 1
            return Prefix(lengths)
        inner = [0] * 19
        for k in range(4 + self.read(4)):
            inner[LENGTH_ORDER[k]] = self.read(3)
        tokens = 2 + self.read(2 + 2 * self.read(3)) if self.read(1) else size
        code, i, last = Prefix(inner), 0, 8
        while i < size and tokens:
            tokens -= 1
            s = self.symbol(code)
            if s < 16:
                lengths[i] = s
                i += 1
                last = s or last
            else:
                n, value = (3 + self.read(2), last) if s == 16 else (3 + self.read(3), 0) if s == 17 else (11 + self.read(7), 0)
                if i + n > size:
                    raise ValueError("code lengths run over")
                lengths[i : i + n] = [value] * n
                i += n
        return Prefix(lengths)

    def distance(self, prefix: int) -> int:
        if prefix < 4:
            return prefix + 1
        extra = (prefix - 2) >> 1
        return ((2 + (prefix & 1)) << extra) + self.read(extra) + 1


# ---------------------------------------------------------------- decoding


def _literals(r: Reader, codes: list[Prefix], n: int) -> np.ndarray | None:
    """All n pixels if every token is a literal, else None and the reader where it was."""
    green, red, blue, alpha = codes[:4]
    copies = int(green.table.max()) >> 4 >= 256  # then there may be fewer tokens than pixels
    base = r.at >> 3
    raw = np.frombuffer(r.data, np.uint8)[base:]
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = padded[:-4].astype(np.uint32)
    for k in (1, 2, 3):
        words |= padded[k : k - 4].astype(np.uint32) << np.uint32(8 * k)
    peek = (words[:, None] >> np.arange(8, dtype=np.uint32)).ravel()
    end = len(peek) - 1
    entry = green.table[peek & green.mask]
    step = entry & np.int32(15)
    rest = [c for c in (red, blue, alpha) if c.bits]
    if rest:
        at = np.arange(len(peek), dtype=np.int32)
        for c in rest:
            step += c.table[peek[np.minimum(at + step, end)] & c.mask] & 15
    start, limit = r.at - 8 * base, 8 * len(raw)
    if not step.any():  # one colour only, without a bit for each pixel
        walk = np.full(n, start, np.int32)
    elif int(step.max()) > 60:
        return None
    else:
        # the walk is serial, so it goes four tokens at a time and the rest is filled in at once
        here = np.arange(len(peek), dtype=np.int32)
        two = step + step[np.minimum(here + step, end)]
        four = two + two[np.minimum(here + two, end)]
        hop, p, out = four.astype(np.uint8).tobytes(), start, []
        add = out.append
        for _ in range((n + 3) >> 2):
            if p >= limit:
                if copies:
                    return None
                raise ValueError("the stream ends early")
            add(p)
            p += hop[p]
        walk = np.empty((len(out), 4), np.int32)
        walk[:, 0] = out
        for k in (1, 2, 3):
            walk[:, k] = walk[:, k - 1] + step[np.minimum(walk[:, k - 1], end)]
        walk = walk.ravel()[:n]
        if int(walk[-1]) >= limit:
            if copies:
                return None
            raise ValueError("the stream ends early")
    token = entry[walk]
    if (token >> 4 >= 256).any():
        return None
    pixels = np.empty((n, 4), np.uint8)
    pixels[:, 2] = token >> 4
    at = walk + (token & 15)
    for c, k in ((red, 1), (blue, 3), (alpha, 0)):
        if not c.bits:
            pixels[:, k] = c.table[0] >> 4
            continue
        token = c.table[peek[np.minimum(at, end)] & c.mask]
        pixels[:, k] = token >> 4
        at = at + (token & 15)
    if n and int(at[-1]) > 8 * len(raw):
        raise ValueError("the stream ends early")
    r.at = 8 * base + int(at[-1])
    return pixels


def _pixels(r: Reader, width: int, height: int, top: bool) -> np.ndarray:
    """An entropy-coded image as (height * width, 4) bytes: alpha, red, green, blue."""
    cache_bits = r.read(4) if r.read(1) else 0
    if cache_bits > 11:
        raise ValueError("a colour cache that is too large")
    groups, block, meta = 1, 0, None
    if top and r.read(1):
        block = r.read(3) + 2
        across = (width + (1 << block) - 1) >> block
        down = (height + (1 << block) - 1) >> block
        meta = _pixels(r, across, down, False).astype(np.int32)
        meta = ((meta[:, 1] << 8) | meta[:, 2]).reshape(down, across)
        groups = int(meta.max()) + 1
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    codes = [[r.code(s) for s in sizes] for _ in range(groups)]
    n = width * height
    if groups == 1 and not cache_bits and n >= 64:
        if (found := _literals(r, codes[0], n)) is not None:
            return found
    out: list[int] = []
    cache = [0] * (1 << cache_bits) if cache_bits else None
    shift = 32 - cache_bits
    stored = 0
    while len(out) < n:
        i = len(out)
        own = codes[int(meta[i // width >> block, i % width >> block])] if meta is not None else codes[0]
        s = r.symbol(own[0])
        if s < 256:
            red = r.symbol(own[1])
            blue = r.symbol(own[2])
            out.append(r.symbol(own[3]) << 24 | red << 16 | s << 8 | blue)
        elif s < 280:
            length = r.distance(s - 256)
            d = r.distance(r.symbol(own[4]))
            if d > 120:
                d -= 120
            else:
                dx, dy = NEIGHBOURS[d - 1]
                d = max(1, dx + dy * width)
            if d > i or i + length > n:
                raise ValueError("a back-reference out of bounds")
            if d >= length:
                out += out[i - d : i - d + length]
            else:
                part = out[i - d :]
                out += (part * (length // d + 1))[:length]
        else:
            while stored < i:  # the cache holds every pixel so far, the latest of each slot
                cache[(0x1E35A7BD * out[stored] & 0xFFFFFFFF) >> shift] = out[stored]
                stored += 1
            out.append(cache[s - 280])
    return np.asarray(out, ">u4").view(np.uint8).reshape(n, 4)


def _average(a, b):
    return (a + b) >> 1


def _predict(mode: int, left, top, right, corner):
    """One pixel's prediction from its neighbours: four int channels each."""
    if mode == 1:
        return left
    if mode == 5:
        return _average(_average(left, right), top)
    if mode == 6:
        return _average(left, corner)
    if mode == 7:
        return _average(left, top)
    if mode == 10:
        return _average(_average(left, corner), _average(top, right))
    if mode == 11:
        to_left, to_top = int(np.abs(top - corner).sum()), int(np.abs(left - corner).sum())
        return left if to_left < to_top else top
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    half = _average(left, top)
    step = half - corner
    return np.clip(half + np.where(step < 0, -((-step) // 2), step // 2), 0, 255)


def _unpredict(pixels: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    """pixels: (h, w, 4) residuals."""
    h, w, _ = pixels.shape
    rest = pixels.astype(np.int32)
    out = np.zeros((h, w, 4), np.int32)
    out[0, 0] = (rest[0, 0] + (255, 0, 0, 0)) & 255
    out[0, 1:] = rest[0, 1:]
    out[0] = np.cumsum(out[0], axis=0) & 255
    for y in range(1, h):
        above = out[y - 1]
        out[y, 0] = (rest[y, 0] + above[0]) & 255
        for b in range(modes.shape[1]):
            x0, x1 = max(1, b << bits), min(w, (b + 1) << bits)
            if x0 >= x1:
                continue
            mode = int(modes[y >> bits, b]) % 16
            mode = 0 if mode > 13 else mode
            # the pixel to the right of the last one above is the first of this row
            right = above[x0 + 1 : x1 + 1] if x1 < w else np.concatenate([above[x0 + 1 : w], out[y, :1]])
            top, corner, own = above[x0:x1], above[x0 - 1 : x1 - 1], rest[y, x0:x1]
            if mode == 1:
                out[y, x0:x1] = (out[y, x0 - 1] + np.cumsum(own, axis=0)) & 255
                continue
            easy = {0: np.asarray((255, 0, 0, 0)), 2: top, 3: right, 4: corner, 8: _average(corner, top), 9: _average(top, right)}
            if mode in easy:
                out[y, x0:x1] = (own + easy[mode]) & 255
                continue
            for x in range(x0, x1):
                k = x - x0
                out[y, x] = (own[k] + _predict(mode, out[y, x - 1], top[k], right[k], corner[k])) & 255
    return out.astype(np.uint8)


def _uncross(pixels: np.ndarray, factors: np.ndarray, bits: int) -> np.ndarray:
    h, w, _ = pixels.shape
    f = factors[np.arange(h)[:, None] >> bits, np.arange(w)[None, :] >> bits].view(np.int8).astype(np.int32)
    signed = lambda c: c.astype(np.uint8).view(np.int8).astype(np.int32)
    green = signed(pixels[..., 2])
    red = (pixels[..., 1] + (f[..., 3] * green >> 5)) & 255
    blue = (pixels[..., 3] + (f[..., 2] * green >> 5) + (f[..., 1] * signed(red) >> 5)) & 255
    out = pixels.copy()
    out[..., 1], out[..., 3] = red, blue
    return out


def decode(data: bytes) -> np.ndarray:
    """The (height, width, 4) pixels of one RIFF file: red, green, blue, alpha."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L" or len(data) < 25 or data[20] != 0x2F:
        raise ValueError("not a lossless WebP file")
    size = struct.unpack_from("<I", data, 16)[0]
    r = Reader(data[20 : 20 + size])
    r.read(8)
    width, height = r.read(14) + 1, r.read(14) + 1
    r.read(1)
    if r.read(3):
        raise ValueError("an unknown version")
    undo, full = [], width
    while r.read(1):
        kind = r.read(2)
        if kind in [u[0] for u in undo]:
            raise ValueError("a transform that comes twice")
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits = r.read(3) + 2
            across, down = (width + (1 << bits) - 1) >> bits, (height + (1 << bits) - 1) >> bits
            undo.append((kind, bits, _pixels(r, across, down, False).reshape(down, across, 4), width))
        elif kind == PALETTE:
            n = r.read(8) + 1
            colours = np.cumsum(_pixels(r, n, 1, False).astype(np.int64), axis=0).astype(np.uint8)
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append((kind, pack, colours, width))
            width = (width + (1 << pack) - 1) >> pack
        else:
            undo.append((kind, 0, None, width))
    pixels = _pixels(r, width, height, True).reshape(height, width, 4)
    for kind, bits, extra, was in reversed(undo):
        if kind == PREDICTOR:
            pixels = _unpredict(pixels, extra[..., 2], bits)
        elif kind == CROSS_COLOUR:
            pixels = _uncross(pixels, extra, bits)
        elif kind == SUBTRACT_GREEN:
            pixels = pixels.copy()
            pixels[..., 1] += pixels[..., 2]
            pixels[..., 3] += pixels[..., 2]
        else:
            index = pixels[..., 2]
            if bits:
                each = 8 >> bits
                index = (index[..., None] >> (each * np.arange(1 << bits)) & ((1 << each) - 1)).reshape(height, -1)[:, :was]
            lut = np.zeros((256, 4), np.uint8)
            lut[: len(extra)] = extra
            pixels = lut[index]
    assert pixels.shape[1] == full
    return pixels[..., [1, 2, 3, 0]]


def frames(data: bytes) -> Iterator[bytes]:
    """The RIFF files that stand in a row."""
    while data:
        if len(data) < 12 or data[:4] != b"RIFF":
            raise ValueError("not a RIFF file")
        n = 8 + struct.unpack_from("<I", data, 4)[0]
        yield data[:n]
        data = data[n:]


# ---------------------------------------------------------------- encoding


class Writer:
    def __init__(self):
        self.done, self.value, self.held = bytearray(), 0, 0

    @property
    def n(self) -> int:
        return 8 * len(self.done) + self.held

    def put(self, value: int, bits: int) -> None:
        self.value |= value << self.held
        self.held += bits
        if self.held > 4096:  # whole bytes leave, so that the number stays small
            k = self.held >> 3
            self.done += (self.value & ((1 << 8 * k) - 1)).to_bytes(k, "little")
            self.value, self.held = self.value >> 8 * k, self.held - 8 * k

    def code(self, lengths: list[int]) -> None:
        used = [i for i, n in enumerate(lengths) if n]
        if len(used) <= 2 and all(i < 256 for i in used):
            used = used or [0]
            self.put(1, 1)
            self.put(len(used) - 1, 1)
            self.put(1, 1)
            for s in used:
                self.put(s, 8)
            return
        tokens, i = [], 0
        end = used[-1] + 1
        while i < end:
            j = i
            while j < end and lengths[j] == lengths[i]:
                j += 1
            if lengths[i] == 0 and j - i >= 3:
                n = min(j - i, 138)
                tokens.append((17, n - 3, 3) if n < 11 else (18, n - 11, 7))
                i += n
            elif lengths[i] and j - i >= 4:
                tokens.append((lengths[i], 0, 0))
                n = min(j - i - 1, 6)
                tokens.append((16, n - 3, 2))
                i += n + 1
            else:
                tokens.append((lengths[i], 0, 0))
                i += 1
        counts = [0] * 19
        for t, _, _ in tokens:
            counts[t] += 1
        if len(tokens) < 2:
            raise ValueError("too few code lengths")
        inner = code_lengths(counts, 7)
        codes = canonical(inner)
        single = sum(1 for n in inner if n) == 1
        shown = max(k for k in range(19) if inner[LENGTH_ORDER[k]] or k < 4) + 1
        self.put(0, 1)
        self.put(shown - 4, 4)
        for k in range(shown):
            self.put(inner[LENGTH_ORDER[k]], 3)
        self.put(1, 1)
        wide = max(2, (len(tokens) - 2).bit_length())
        wide += wide & 1
        self.put((wide - 2) // 2, 3)
        self.put(len(tokens) - 2, wide)
        for t, extra, n in tokens:
            if not single:
                self.put(codes[t], inner[t])
            self.put(extra, n)

    def bytes(self) -> bytes:
        return bytes(self.done) + self.value.to_bytes((self.held + 7) // 8, "little")


def riff(stream: bytes) -> bytes:
    pad = b"\0" * (len(stream) & 1)
    return b"RIFF" + struct.pack("<I", 12 + len(stream) + len(pad)) + b"WEBPVP8L" + struct.pack("<I", len(stream)) + stream + pad


def header(w: Writer, width: int, height: int) -> None:
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(0, 4)


def _split(value: int) -> tuple[int, int, int]:
    """The prefix of a length or a distance, and the number and value of its extra bits."""
    value -= 1
    if value < 4:
        return value, 0, 0
    high = value.bit_length() - 1
    return 2 * high + (value >> (high - 1) & 1), high - 1, value & ((1 << (high - 1)) - 1)


def _image(w: Writer, tokens: list[tuple[int, ...]], top: bool) -> None:
    """An entropy-coded image of one group: pixels (alpha, red, green, blue) and copies (length, distance)."""
    w.put(0, 1)  # no colour cache
    if top:
        w.put(0, 1)
    parts: list[tuple[int, int, int, int]] = []  # code, symbol, number and value of extra bits
    for t in tokens:
        if len(t) == 4:
            parts += [(0, t[2], 0, 0), (1, t[1], 0, 0), (2, t[3], 0, 0), (3, t[0], 0, 0)]
        else:
            length, distance = _split(t[0]), _split(t[1] + len(NEIGHBOURS))
            parts += [(0, 256 + length[0], *length[1:]), (4, *distance)]
    counts = [[0] * 280, [0] * 256, [0] * 256, [0] * 256, [0] * 40]
    for code, symbol, _, _ in parts:
        counts[code][symbol] += 1
    lengths = [code_lengths(c) if any(c) else [1] + [0] * (len(c) - 1) for c in counts]
    codes, alone = [canonical(n) for n in lengths], [sum(map(bool, n)) == 1 for n in lengths]
    for n in lengths:
        w.code(n)
    for code, symbol, bits, extra in parts:
        if not alone[code]:
            w.put(codes[code][symbol], lengths[code][symbol])
        w.put(extra, bits)


def _packed(samples: np.ndarray, kinds: np.ndarray) -> bytes:
    """Samples of at most 16 kinds as indices into a palette, several to a pixel."""
    height, width = samples.shape
    pack = 3 if len(kinds) <= 2 else 2 if len(kinds) <= 4 else 1
    w = Writer()
    header(w, width, height)
    w.put(1, 1)
    w.put(PALETTE, 2)
    w.put(len(kinds) - 1, 8)
    steps = np.diff(kinds, prepend=0).tolist()  # each colour as its difference to the one before
    _image(w, [(0 if k else 255, v, v, v) for k, v in enumerate(steps)], False)
    w.put(0, 1)
    index = np.searchsorted(kinds, samples)
    index = np.pad(index, ((0, 0), (0, -width % (1 << pack)))).reshape(height, -1, 1 << pack)
    pixels = (index << ((8 >> pack) * np.arange(1 << pack))).sum(axis=2).ravel().tolist()
    tokens: list[tuple[int, ...]] = []
    i = 0
    while i < len(pixels):  # runs of one pixel are copies of the one before
        j = i + 1
        while j < len(pixels) and pixels[j] == pixels[i] and j - i <= 4096:
            j += 1
        tokens.append((255, 0, pixels[i], 0))
        if j - i > 1:
            tokens.append((j - i - 1, 1))
        i = j
    _image(w, tokens, True)
    return riff(w.bytes())


#: Bytes that a copy is found by, the longest copy, the farthest one, and the bytes that a token has to stand for.
_SEED, _LONGEST, _FARTHEST, _WORTH = 8, 4096, (1 << 20) - 128, 8


def _repeats(data: bytes) -> list[int | tuple[int, int]] | None:
    """Bytes and copies (length, distance) that spell data; None unless it mostly repeats itself."""
    n = len(data)
    spread = range(64, n - 16, max(64, n // 32))
    if 2 * sum(data.find(data[i : i + 16], 0, i + 15) >= 0 for i in spread) <= len(spread):
        return None
    seen: dict[bytes, int] = {}
    out: list[int | tuple[int, int]] = []
    i = 0
    while i < n:
        if len(out) > n // _WORTH:
            return None
        seed = data[i : i + _SEED]
        j = seen.get(seed, -1) if len(seed) == _SEED else -1
        if j < 0 or i - j > _FARTHEST:
            seen[seed] = i
            out.append(data[i])
            i += 1
            continue
        length, most = _SEED, min(_LONGEST, n - i)
        while length + 64 <= most and data[j + length : j + length + 64] == data[i + length : i + length + 64]:
            length += 64
        while length < most and data[j + length] == data[i + length]:
            length += 1
        for k in range(i, min(i + length, n - _SEED), _SEED):
            seen[data[k : k + _SEED]] = k
        out.append((length, i - j))
        i += length
    return out


def encode_grey(samples: np.ndarray) -> bytes:
    """A (height, width) array of grey samples as one RIFF file.

    Few kinds of samples go by a palette, what mostly repeats itself by back-references, all else as literals;
    the latter two under subtract-green."""
    height, width = samples.shape
    flat = samples.ravel()
    counts = np.bincount(flat, minlength=280)
    kinds = np.flatnonzero(counts)
    if len(kinds) <= 16:
        return _packed(samples, kinds)
    w = Writer()
    if (tokens := _repeats(flat.tobytes())) is not None:
        header(w, width, height)
        w.put(1, 1)
        w.put(SUBTRACT_GREEN, 2)
        w.put(0, 1)
        _image(w, [t if isinstance(t, tuple) else (255, 0, t, 0) for t in tokens], True)
        return riff(w.bytes())
    header(w, width, height)
    w.put(1, 1)
    w.put(SUBTRACT_GREEN, 2)
    w.put(0, 1)  # no more transforms
    w.put(0, 1)  # no colour cache
    w.put(0, 1)  # one group
    lengths = code_lengths(counts.tolist())
    w.code(lengths)
    for constant in (0, 0, 255, 0):
        w.code([int(i == constant) for i in range(256)])
    head, at = w.bytes(), w.n
    if sum(1 for n in lengths if n) == 1:
        return riff(head)
    size = np.asarray(lengths, np.int64)[flat]
    bits = np.asarray(canonical(lengths), np.uint64)[flat]
    ends = np.cumsum(size) + at
    where = ends - size
    # codes that begin in the same 32-bit word don't overlap, so a sum joins them
    word = where >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))
    joined = np.add.reduceat(bits << (where & 31).astype(np.uint64), first)
    out = np.zeros(int(ends[-1] >> 5) + 2, np.uint64)
    out[word[first]] += joined & np.uint64(0xFFFFFFFF)
    out[word[first] + 1] += joined >> np.uint64(32)
    stream = bytearray(out.astype("<u4").tobytes()[: (int(ends[-1]) + 7) // 8])
    for i, b in enumerate(head):
        stream[i] |= b
    return riff(bytes(stream))


def store(payload: np.ndarray) -> bytes:
    """A payload of whole rows as RIFF files of at most MOST_ROWS rows each."""
    rows = payload.reshape(-1, WIDTH)
    return b"".join(encode_grey(rows[i : i + MOST_ROWS]) for i in range(0, len(rows), MOST_ROWS))


def load(media: bytes) -> np.ndarray:
    """The grey samples of stored media."""
    return np.concatenate([decode(f)[..., 1].ravel() for f in frames(media)])


def padded(data: np.ndarray) -> np.ndarray:
    """Bytes 32 appended up to a positive multiple of WIDTH."""
    n = max(1, -(-len(data) // WIDTH)) * WIDTH
    out = np.full(n, 32, np.uint8)
    out[: len(data)] = data
    return out


def features(samples: np.ndarray) -> str:
    """Rows, mean, deviation, entropy in bits and mean vertical step of grey samples."""
    counts = np.bincount(samples, minlength=256)
    n = len(samples)
    value = np.arange(256)
    mean = int((counts * value).sum()) / n
    spread = max(0.0, int((counts * value * value).sum()) / n - mean * mean) ** 0.5
    p = counts[counts > 0] / n
    rows = samples.reshape(-1, WIDTH).astype(np.int16)
    step = int(np.abs(np.diff(rows, axis=0)).sum(dtype=np.int64)) / n
    return f"rows={n // WIDTH};mean={mean:.4f};deviation={spread:.4f};entropy={-(p * np.log2(p)).sum() + 0.0:.4f};step={step:.4f}"


# ---------------------------------------------------------------- tables

MEDIA = "doc_id long, n_bytes long, media binary"
DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def encode_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as lossless WebP."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i in range(batch.num_rows):
                text = data[at[i] : at[i + 1]]
                row = [pa.array([v], t) for v, t in ((batch.column(0)[i].as_py(), pa.int64()), (len(text), pa.int64()), (store(padded(text)), pa.binary()))]
                yield pa.RecordBatch.from_arrays(row, ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, MEDIA)


def digest(docs: DataFrame) -> DataFrame:
    """Store each text, read the stored bytes back and describe both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            rows = []
            for i in range(batch.num_rows):
                media = store(padded(data[at[i] : at[i + 1]]))
                back = load(media)
                payload = back.tobytes()
                rows.append((int(at[i + 1] - at[i]), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), features(back)))
            columns = [batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return docs.select("doc_id", "text").mapInArrow(run, DIGEST)


def decode_media(rows: DataFrame, media: str = "media") -> DataFrame:
    """rows with pixels array<struct<width, height, rgba binary>>, one for each stored file; null for broken media."""
    from pyspark.sql import functions as F
    from pyspark.sql.functions import arrow_udf

    shape = "array<struct<width:int,height:int,rgba:binary>>"
    kind = pa.list_(pa.struct([("width", pa.int32()), ("height", pa.int32()), ("rgba", pa.binary())]))

    @arrow_udf(shape)
    def pixels(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            try:
                out.append(None if not x.is_valid else [{"width": p.shape[1], "height": p.shape[0], "rgba": p.tobytes()} for p in map(decode, frames(x.as_py()))])
            except (ValueError, IndexError):
                out.append(None)
        return pa.array(out, kind)

    return rows.withColumn("pixels", pixels(F.col(media)))
