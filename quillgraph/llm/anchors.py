"""Anchors of fixed-length windows: for each window of WINDOW bytes, or of WORDS words, the leftmost least hash of its grams.

Equal windows have equal anchors at equal places, so windows that could repeat meet by their anchors."""

from __future__ import annotations

import numpy as np

from .common import mix, powers

WINDOW, GRAM = 400, 32
#: Over fifty words, and the words of a gram.
WORDS, WORD_GRAM = 51, 5
_PLACE = np.uint64((1 << 24) - 1)


def prefix(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over bytes, and what brings a difference of two to its place."""
    n = len(data)
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    return sums, inverse


def piece_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least of every width hashes in a row, under 2 ** 24 of them."""
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    return (low & _PLACE).astype(np.int64)


def word_sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over words, and what brings a difference of two to its place."""
    n = len(hashes)
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=sums[1:])
    return sums, inverse


def word_anchors(doc: np.ndarray, hashes: np.ndarray):
    """(first window's first word, fingerprint, windows, context hash) of every anchor of words, as numbers of words.

    doc: the text of each word, in order; windows of WORDS words do not cross texts."""
    windows, grams = len(hashes) - WORDS + 1, len(hashes) - WORD_GRAM + 1
    none = np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:windows] == doc[WORDS - 1 :]) if windows > 0 else none
    if not len(at):
        return none, none.astype(np.uint64), none, none.astype(np.uint64)
    sums, inverse = word_sums(hashes)
    h = mix((sums[WORD_GRAM:] - sums[:grams]) * inverse[:grams])
    place = _least(h, WORDS - WORD_GRAM + 1)
    first = np.flatnonzero((np.diff(place[at], prepend=-1) != 0) | (np.diff(doc[at], prepend=-1) != 0))
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    return start, h[place[start]], count, piece_hash(sums, inverse, start, start + count - 1 + WORDS)


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(document, fingerprint, first window, windows, context hash) of every anchor, windows relative to the document.

    data: under 16 MB of texts in a row. An anchor's context is the union of its windows."""
    grams, width = len(data) - GRAM + 1, WINDOW - GRAM + 1
    sums, inverse = prefix(data)
    windows = len(data) - WINDOW + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    h = mix((sums[GRAM:] - sums[:grams]) * inverse[:grams])
    place = _least(h, width)
    # windows must not cross documents
    size = np.diff(offsets)
    valid = np.zeros(windows + 1, np.int8)
    long = np.flatnonzero(size >= WINDOW)
    np.add.at(valid, offsets[long], 1)
    np.add.at(valid, offsets[long] + size[long] - WINDOW + 1, -1)
    at = np.flatnonzero(np.cumsum(valid[:windows]) > 0)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    doc = np.searchsorted(offsets, at, "right") - 1
    first = np.flatnonzero((np.diff(place[at], prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    context = piece_hash(sums, inverse, start, start + count - 1 + WINDOW)
    return doc[first], h[place[start]], start - offsets[doc[first]], count, context
