import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quillgraph.llm import webp


def test_query_digest(corpus, empty, texts):
    got = Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in webp.digest(corpus).collect())
    expected = Counter()
    for d, t in texts:
        raw = (t or "").encode()
        padded = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        expected[d, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:])] += 1
    assert got == expected
    assert webp.digest(empty).count() == 0


def test_tables_round_trip(corpus, texts):
    rows = webp.decode_media(webp.encode_texts(corpus.filter("doc_id = 160"))).first()
    image = rows.pixels[0]
    grey = np.frombuffer(image.rgba, np.uint8).reshape(-1, 4)
    assert image.width == 192 and (grey[:, 0] == grey[:, 2]).all() and (grey[:, 3] == 255).all()
    assert grey[: rows.n_bytes, 0].tobytes().decode() == dict(texts)[160]


def test_stored_payloads_use_what_fits_them():
    rng = random.Random(5)
    line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ,.") for _ in range(300))
    kinds = {"literal": [line * 2, "".join(chr(rng.randrange(32, 127)) for _ in range(9000)), "é💡ß" * 40 + line], "copies": [line * 60, (line[:100] + "X") * 400, line * 4000], "palette": ["", "a", "ab" * 5000, "0123456789abcde" * 90, "aaaabbbb" * 7, " " * 191 + "x"]}
    for kind, payloads in kinds.items():
        for t in payloads:
            raw = webp.padded(np.frombuffer(t.encode(), np.uint8))
            media = webp.store(raw)
            assert webp.load(media).tobytes() == raw.tobytes()
            stream = next(webp.frames(media))[20:]
            transform = int.from_bytes(stream[5:6], "little") >> 1 & 3
            assert (transform == webp.PALETTE) == (kind == "palette")
            if kind != "literal" and len(raw) >= 5000:
                assert len(media) < len(raw) / 4
    for _ in range(200):
        n = rng.randint(1, 2000)
        raw = webp.padded(np.frombuffer(bytes(rng.choice([rng.randrange(256), 7, 7, 9]) for _ in range(n)) * rng.randint(1, 30), np.uint8))
        assert webp.load(webp.store(raw)).tobytes() == raw.tobytes()


def test_broken_media_is_null(spark):
    rows = spark.createDataFrame([(1, b"RIFFxxxx"), (2, None)], "id int, media binary")
    assert [r.pixels for r in webp.decode_media(rows).collect()] == [None, None]
    with pytest.raises(ValueError):
        webp.decode(b"RIFF" + b"\0" * 30)
    good = webp.encode_grey(np.random.default_rng(1).integers(0, 256, (3, 192), dtype=np.uint8))
    with pytest.raises(ValueError):
        webp.decode(good[: len(good) // 2])


class Coder:
    """An encoder for tests: any transforms, tokens, cache and groups, pixels as 0xAARRGGBB."""

    def __init__(self, width, height):
        self.w = webp.Writer()
        webp.header(self.w, width, height)

    def prefix(self, n):
        if n <= 4:
            return n - 1, 0, 0
        n -= 1
        top = n.bit_length() - 1
        second = n >> (top - 1) & 1
        return 2 * top + second, top - 1, n & ((1 << (top - 1)) - 1)

    def image(self, tokens, cache_bits=0, top=False, group_of=None, meta=None):
        """tokens: ("lit", argb) | ("copy", length, distance code) | ("cache", index); group_of: the group of each token."""
        self.w.put(int(cache_bits > 0), 1)
        if cache_bits:
            self.w.put(cache_bits, 4)
        groups = 1
        if top:
            self.w.put(int(meta is not None), 1)
            if meta is not None:
                bits, pixels, groups = meta
                self.w.put(bits - 2, 3)
                self.image([("lit", p) for p in pixels])
        sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
        counts = [[[0] * s for s in sizes] for _ in range(groups)]
        group_of = group_of or [0] * len(tokens)

        def parts(t):
            if t[0] == "lit":
                return [(0, t[1] >> 8 & 255), (1, t[1] >> 16 & 255), (2, t[1] & 255), (3, t[1] >> 24)], []
            if t[0] == "cache":
                return [(0, 280 + t[1])], []
            length, distance = self.prefix(t[1]), self.prefix(t[2])
            return [(0, 256 + length[0]), (4, distance[0])], [length[1:], distance[1:]]

        for t, g in zip(tokens, group_of, strict=True):
            for k, s in parts(t)[0]:
                counts[g][k][s] += 1
        tables = []
        for g in range(groups):
            own = []
            for c in counts[g]:
                lengths = webp.code_lengths(c)
                self.w.code(lengths)
                own.append((lengths, webp.canonical(lengths)))
            tables.append(own)
        for t, g in zip(tokens, group_of, strict=True):
            symbols, extra = parts(t)
            for i, (k, s) in enumerate(symbols):
                lengths, codes = tables[g][k]
                if sum(map(bool, lengths)) > 1:
                    self.w.put(codes[s], lengths[s])
                if extra:
                    self.w.put(extra[i][1], extra[i][0])

    def file(self):
        return webp.riff(self.w.bytes())


def picture(rng, w, h):
    return np.asarray([[[rng.randrange(256) if rng.random() < 0.3 else (x * 7 + y * 3 + c) % 256 for c in range(4)] for x in range(w)] for y in range(h)], np.uint8)


def argb(p):
    return [int(a) << 24 | int(r) << 16 | int(g) << 8 | int(b) for r, g, b, a in p.reshape(-1, 4)]


def test_literals_copies_and_cache():
    rng = random.Random(1)
    colours = [rng.randrange(1 << 32) for _ in range(9)]
    width, height, bits = 13, 9, 3
    for _ in range(20):
        tokens, flat, cache = [], [], [0] * (1 << bits)
        done = 0
        while len(flat) < width * height:
            while done < len(flat):
                cache[(0x1E35A7BD * flat[done] & 0xFFFFFFFF) >> (32 - bits)] = flat[done]
                done += 1
            kind = rng.random()
            if kind < 0.3 and flat:
                code = rng.choice([1, 2, 3, 4, 120 + rng.randint(1, len(flat))])
                if code > 120:
                    d = code - 120
                else:
                    dx, dy = [(0, 1), (1, 0), (1, 1), (-1, 1)][code - 1]
                    d = max(1, dx + dy * width)
                n = rng.randint(1, min(30, width * height - len(flat)))
                if d <= len(flat):
                    tokens.append(("copy", n, code))
                    for _ in range(n):
                        flat.append(flat[-d])
                    continue
            if kind < 0.6 and (c := rng.choice(colours)) == cache[(0x1E35A7BD * c & 0xFFFFFFFF) >> (32 - bits)]:
                tokens.append(("cache", (0x1E35A7BD * c & 0xFFFFFFFF) >> (32 - bits)))
            else:
                c = rng.choice(colours)
                tokens.append(("lit", c))
            flat.append(c)
        coder = Coder(width, height)
        coder.w.put(0, 1)
        coder.image(tokens, bits, True)
        got = webp.decode(coder.file())
        assert argb(got) == flat


def test_groups():
    rng = random.Random(2)
    p = picture(rng, 10, 9)
    meta = [0 << 8, 1 << 8, 2 << 8, 1 << 8, 0, 2 << 8, 0, 1 << 8, 2 << 8]
    group_of = [meta[(y >> 2) * 3 + (x >> 2)] >> 8 for y in range(9) for x in range(10)]
    coder = Coder(10, 9)
    coder.w.put(0, 1)
    coder.image([("lit", v) for v in argb(p)], 0, True, group_of, (2, meta, 3))
    assert (webp.decode(coder.file()) == p).all()


def predicted(mode, l, t, tr, tl):
    """The fourteen rules, a channel at a time, from their definitions."""
    half = lambda a, b: (a + b) // 2
    clamp = lambda v: max(0, min(255, v))
    z = list(zip(l, t, tr, tl, strict=True))
    if mode == 11:
        pl = sum(abs(b - d) for a, b, c, d in z)
        pt = sum(abs(a - d) for a, b, c, d in z)
        return list(l) if pl < pt else list(t)
    rule = {
        0: lambda a, b, c, d: 0, 1: lambda a, b, c, d: a, 2: lambda a, b, c, d: b, 3: lambda a, b, c, d: c, 4: lambda a, b, c, d: d,
        5: lambda a, b, c, d: half(half(a, c), b), 6: lambda a, b, c, d: half(a, d), 7: lambda a, b, c, d: half(a, b), 8: lambda a, b, c, d: half(d, b), 9: lambda a, b, c, d: half(b, c),
        10: lambda a, b, c, d: half(half(a, d), half(b, c)), 12: lambda a, b, c, d: clamp(a + b - d), 13: lambda a, b, c, d: clamp(half(a, b) + int((half(a, b) - d) / 2)),
    }[mode]
    out = [rule(*v) for v in z]
    return [0, 0, 0, 255] if mode == 0 else out


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    rng = random.Random(mode)
    w, h = 9, 6
    p = picture(rng, w, h).astype(int)
    flat = p.reshape(-1, 4)
    rest = []
    for i in range(w * h):
        x, y = i % w, i // w
        if i == 0:
            guess = [0, 0, 0, 255]
        elif y == 0:
            guess = flat[i - 1]
        elif x == 0:
            guess = flat[i - w]
        else:
            guess = predicted(mode, flat[i - 1], flat[i - w], flat[i - w + 1], flat[i - w - 1])
        rest.append([(a - b) % 256 for a, b in zip(flat[i], guess, strict=True)])
    coder = Coder(w, h)
    coder.w.put(1, 1)
    coder.w.put(webp.PREDICTOR, 2)
    coder.w.put(0, 3)
    coder.image([("lit", 0xFF000000 | mode << 8)] * (3 * 2))
    coder.w.put(0, 1)
    coder.image([("lit", v) for v in argb(np.asarray(rest, np.uint8))], 0, True)
    assert (webp.decode(coder.file()) == p).all()


def test_cross_colour_then_subtract_green():
    rng = random.Random(7)
    w, h = 8, 5
    p = picture(rng, w, h).astype(int)
    factors = [[rng.randrange(256) for _ in range(3)] for _ in range(4)]  # red to blue, green to blue, green to red
    s8 = lambda v: v - 256 if v > 127 else v
    out = np.zeros((h, w, 4), np.uint8)
    for y in range(h):
        for x in range(w):
            r, g, b, a = p[y, x]
            r, b = (r - g) % 256, (b - g) % 256  # subtract green was applied first, so it is undone last
            rb, gb, gr = map(s8, factors[(y >> 2) * 2 + (x >> 2)])
            out[y, x] = ((r - (gr * s8(g) >> 5)) % 256, g, (b - (gb * s8(g) >> 5) - (rb * s8(r) >> 5)) % 256, a)
    coder = Coder(w, h)
    coder.w.put(1, 1)
    coder.w.put(webp.SUBTRACT_GREEN, 2)
    coder.w.put(1, 1)
    coder.w.put(webp.CROSS_COLOUR, 2)
    coder.w.put(0, 3)
    coder.image([("lit", 0xFF000000 | f[0] << 16 | f[1] << 8 | f[2]) for f in factors])
    coder.w.put(0, 1)
    coder.image([("lit", v) for v in argb(out)], 0, True)
    assert (webp.decode(coder.file()) == p).all()


@pytest.mark.parametrize("n", [1, 2, 4, 7, 16, 40])
def test_palettes(n):
    rng = random.Random(n)
    w, h = 11, 4
    colours = [[rng.randrange(256) for _ in range(4)] for _ in range(n)]
    index = [[rng.randrange(n) for _ in range(w)] for _ in range(h)]
    pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
    deltas = [[(c - d) % 256 for c, d in zip(a, b, strict=True)] for a, b in zip(colours, [[0] * 4, *colours], strict=False)]
    each = 8 >> pack
    packed = [sum(v << (each * k) for k, v in enumerate(row[i : i + (1 << pack)])) for row in index for i in range(0, w, 1 << pack)]
    coder = Coder(w, h)
    coder.w.put(1, 1)
    coder.w.put(webp.PALETTE, 2)
    coder.w.put(n - 1, 8)
    coder.image([("lit", v) for v in argb(np.asarray(deltas, np.uint8))])
    coder.w.put(0, 1)
    coder.image([("lit", 0xFF000000 | v << 8) for v in packed], 0, True)
    assert webp.decode(coder.file()).tolist() == [[colours[i] for i in row] for row in index]


def test_skewed_counts_keep_codes_short():
    counts = [int(1.9**i) + 1 for i in range(40)]
    lengths = webp.code_lengths(counts)
    assert max(lengths) <= 15 and sum(2.0**-n for n in lengths) == 1
