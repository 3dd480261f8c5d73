"""Whole batches of texts as arrays of code points.

The text operators run inside Arrow batches. Looping over characters in Python
would dominate their cost, so a batch is turned into one array of code points
and everything after that (folding, token borders, token and shingle hashes)
is a handful of array passes over it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SEP, WORD, IDEO = 0, 1, 2
BMP = 0x10000
M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xBF58476D1CE4E5B9)
M3 = np.uint64(0x94D049BB133111EB)
BASE = 0x100000001B3


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, on arrays of uint64."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(class, fold) of each code point of the basic plane.

    Classes: separators, characters of spaced words, and characters that stand
    for themselves (Han and kana). Folding lowers case and narrows width.
    """
    kind = np.zeros(BMP + 1, np.uint8)
    fold = np.arange(BMP + 1, dtype=np.uint32)
    for c in range(BMP):
        if 0xD800 <= c < 0xE000 or 0xE000 <= c < 0xF900:
            continue
        ch = chr(c)
        cat = unicodedata.category(ch)
        if 0x3400 <= c < 0xA000 or 0xF900 <= c < 0xFB00 or 0x3041 <= c < 0x3100 and cat[0] == "L" or 0x31F0 <= c < 0x3200 or 0xFF66 <= c < 0xFFA0:
            kind[c] = IDEO
        elif cat[0] in "LNM":
            kind[c] = WORD
        low = ch.lower()
        if 0xFF01 <= c < 0xFF5F:
            low = chr(c - 0xFEE0).lower()
            kind[c] = WORD if low.isalnum() else SEP
        if len(low) == 1:
            fold[c] = ord(low)
    kind[BMP] = IDEO  # characters beyond the basic plane
    return kind, fold


@lru_cache(maxsize=1)
def char_hashes() -> np.ndarray:
    return mix(tables()[1].astype(np.uint64) + M1)


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    up = np.full(n, BASE, np.uint64)
    up[0] = 1
    down = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def portions(texts: list[str | None], chars: int = 400_000) -> Iterator[slice]:
    """Slices of a batch with about so many characters each, so that arrays stay in the cache and memory stays bounded."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 2  # so that the number of texts is bounded, too
        if size >= chars:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins; a null is an empty text."""
    parts = [t or "" for t in texts]
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=at[1:])
    return np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32), at


CHUNK = 1 << 14  # counters in a row of a table that is summed


def table_sum(rows: DataFrame, size: int, fill: Callable[[np.ndarray, pa.RecordBatch], None]) -> np.ndarray:
    """A table of ``size`` counters that ``fill`` adds each batch of ``rows`` to, summed over all of them.

    A task sends its table in chunks, not counter by counter; the chunks are
    added up where they are shuffled to, one after the other, so that neither
    a task nor the driver holds more than one table, whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.int64)
        for batch in batches:
            fill(table, batch)
        yield _chunks({k: table[k * CHUNK : (k + 1) * CHUNK] for k in range(-(-size // CHUNK))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, width, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(data, f"i{width}").astype(np.int64)
                sums[k] = sums[k] + part if k in sums else part
        yield _chunks(sums)

    kind = "chunk int, width int, data binary"
    out = np.zeros(size, np.int64)
    for k, width, data in zip(*(c.to_pylist() for c in rows.mapInArrow(count, kind).repartition("chunk").mapInArrow(add, kind).toArrow().columns), strict=True):
        out[k * CHUNK : (k + 1) * CHUNK] = np.frombuffer(data, f"i{width}")
    return out


def _chunks(tables: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Rows (chunk, bytes of a counter, data) of the chunks that aren't empty."""
    full = {k: t for k, t in tables.items() if t.any()}
    widths = {k: next(w for w in (1, 2, 4, 8) if t.max() < 1 << 8 * w - 1) for k, t in full.items()}
    data = [t.astype(f"i{widths[k]}").tobytes() for k, t in full.items()]
    return pa.RecordBatch.from_arrays([pa.array(list(full), pa.int32()), pa.array(list(widths.values()), pa.int32()), pa.array(data, pa.binary())], names=["chunk", "width", "data"])


class Tokens:
    """Tokens of a batch: a run of word characters, or one ideograph or kana.

    hash   uint64 of each token's folded characters
    ideo   whether the token is a single ideograph or kana
    start, end   places in the batch's code points
    doc    the text each token is of
    first  where each text's tokens begin (one more entry than texts)
    """

    def __init__(self, texts: list[str | None]):
        raw, at = codes(texts)
        kind_of, _ = tables()
        low = np.minimum(raw, BMP)
        kind = kind_of[low]
        n = len(raw)
        self.n_texts = len(texts)
        if not n:
            self.hash = np.zeros(0, np.uint64)
            self.ideo = np.zeros(0, bool)
            self.start = self.end = self.doc = np.zeros(0, np.int64)
            self.first = np.zeros(len(texts) + 1, np.int64)
            return
        opens = np.empty(n, bool)
        opens[0] = True
        opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == IDEO)
        opens[at[:-1][at[:-1] < n]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], n)
        keep = kind[starts] != SEP
        starts, ends = starts[keep], ends[keep]
        up, down = powers(1 << max(12, int(n).bit_length()))
        run = np.zeros(n + 1, np.uint64)
        each = char_hashes()[low]
        beyond = np.flatnonzero(low == BMP)
        each[beyond] = mix(raw[beyond].astype(np.uint64) + M1)
        each *= up[:n]
        np.cumsum(each, out=run[1:])
        self.hash = mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        self.ideo = kind[starts] == IDEO
        self.start, self.end = starts, ends
        self.first = np.searchsorted(starts, at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def shingles(self, words: int, ideographs: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the shingle that begins at each token, and whether it lies whole in its text.

        A shingle takes ``words`` tokens, or ``ideographs`` where it begins
        with an ideograph or kana.
        """
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        fits = np.zeros(n, bool)
        if not n:
            return out, fits
        last = self.first[1:][self.doc]
        for size, which in ((words, ~self.ideo), (ideographs, self.ideo)):
            h = np.zeros(n, np.uint64)
            for k in range(min(size, n)):
                h[: n - k] = h[: n - k] * M1 + self.hash[k:]
            out[which] = mix(h)[which]
            fits |= which & (np.arange(n) + size <= last)
        return out, fits
