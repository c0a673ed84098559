"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. UTF-8 has
these bytes nowhere inside another character, so bytes and characters agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in blocks of about this many bytes, so memory does not follow a partition or a long text.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finisher of SplitMix64)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Breaks between words for `hash_words`: all ASCII other than letters and digits.
PUNCTUATED = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: One random value per byte, A-Z as a-z; the hash of a word is a polynomial in BASE over these values.
VALUE_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
BASE = 0x9E3779B97F4A7C1B
_UNBASE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for name, base in (("up", BASE), ("down", _UNBASE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def _hash_piece(data: np.ndarray, breaks: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word; no word crosses a position in breaks."""
    solid = ~gaps[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(VALUE_OF_BYTE[data] * up[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64)), starts, ends


def hash_words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts that lie at `offsets` in `data`.

    Returns hash, start and end byte of each word, and per text the number of its first
    word (one entry more than texts). Bytes marked in `gaps` part words. Long data is cut
    at gaps into pieces.
    """
    offsets = np.asarray(offsets, dtype=np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    parts = []
    at = low
    while at < high:
        to = min(at + BLOCK_BYTES, high)
        if to < high:
            gap = np.flatnonzero(gaps[data[at:to]])
            if len(gap):
                to = at + int(gap[-1]) + 1
            else:  # one word longer than a block
                while to < high and not gaps[data[to]]:
                    more = np.flatnonzero(gaps[data[to : min(to + BLOCK_BYTES, high)]])
                    to = to + int(more[0]) if len(more) else min(to + BLOCK_BYTES, high)
        h, s, e = _hash_piece(data[at:to], offsets - at, gaps)
        parts.append((h, s + at, e + at))
        at = to
    if not parts:
        none = np.empty(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64)
    h, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, s, e, np.searchsorted(s, offsets)


def raw_texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset)
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8), at


def text_blocks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts, about BLOCK_BYTES each."""
    data, at = raw_texts(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK_BYTES, side="right")) - 1)
        yield row, to, data, at[row : to + 1]
        row = to


def ngram_hashes(words: np.ndarray, firsts: np.ndarray, n: int, whole_if_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word sequences inside each text, and the index of each text's first.

    With whole_if_short a text of 1 to n - 1 words has its whole sequence as the only one.
    """
    lengths = np.diff(firsts)
    counts = np.maximum(lengths - n + 1, 0)
    short = (lengths > 0) & (lengths < n) & whole_if_short
    if len(words) >= n:
        rolled = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k])
    else:
        rolled = np.empty(0, dtype=np.uint64)
    inside = np.zeros(len(rolled) + 1, dtype=np.int64)
    full = counts > 0
    np.add.at(inside, firsts[:-1][full], 1)
    np.add.at(inside, (firsts[:-1] + counts)[full], -1)
    grams = rolled[np.cumsum(inside[:-1]) > 0]
    total = counts + short
    index = np.concatenate([[0], np.cumsum(total)])
    if short.any():
        out = np.empty(int(index[-1]), dtype=np.uint64)
        keep = np.ones(len(out), dtype=bool)
        for t in np.flatnonzero(short):
            own = words[firsts[t] : firsts[t + 1]]
            h = own[:1].copy()
            for w in own[1:]:
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
            out[index[t]] = mix(h + np.uint64(len(own)))[0]
            keep[index[t]] = False
        out[keep] = grams
        grams = out
    return grams, index
