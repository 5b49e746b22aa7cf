"""Helpers of the training-data operators: tables, and word hashing on whole Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ludolytics.session import scratch_path

#: Whether the shuffle files of a query are deleted as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SEED = np.random.default_rng(20_240_229)
#: One random 64-bit value for each byte, and an odd multiplier with its inverse modulo 2**64.
BYTE_VALUES = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 2**64)
WORD_MULTIPLIER = 0xD6E8FEB86659FD93
#: Bytes handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


#: After lower-casing A-Z: digits, a-z and all that is not ASCII.
ALNUM_WORDS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: All but space, tab, line feed, vertical tab, form feed and carriage return.
SPACED_WORDS = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once below the shared folder and read back: lineage is cut, and a lost executor loses nothing.

    What was shuffled for them is deleted when they are written.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_by_worker(key: tuple, build: Callable[[], object]) -> object:
    """An object that a Python worker builds once and keeps for its later tasks (a tokenizer with its memory of words).

    Only for what gives the same results whether it is kept or built anew. A worker keeps one such object; it goes when
    the worker needs another one.
    """
    held = sys.modules.setdefault("ludolytics_held_by_worker", types.ModuleType("ludolytics_held_by_worker"))
    if not hasattr(held, "objects"):
        held.objects = {}
    if key not in held.objects:
        held.objects.clear()
        held.objects[key] = build()
    return held.objects[key]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """64-bit hashes of the words of many texts at once.

    ``kind`` tells the bytes of words (after lower-casing A-Z, unless ``lower`` is false). A call takes the concatenated
    UTF-8 bytes and the offsets of the texts and returns (hash of each word, offsets of each text's words, start and end
    byte of each word).
    """

    def __init__(self, kind: np.ndarray, lower: bool = True) -> None:
        self.kind, self.lower, self.up, self.down = kind, lower, powers(MULTIPLIER, 1), powers(INVERSE, 1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        low = ASCII_LOWER[data] if self.lower else data
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = self.kind[low]
        cut = np.zeros(n + 1, dtype=bool)
        cut[offsets] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
        return self.ranges(low, starts, ends), np.searchsorted(starts, offsets), starts, ends

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ranges of bytes."""
        n = len(data)
        if len(self.up) <= n:
            self.up, self.down = powers(MULTIPLIER, n + n // 2 + 2), powers(INVERSE, n + n // 2 + 2)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.up[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts])


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions have none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(WORD_MULTIPLIER) + words[j : j + n]
    return mix(out)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of texts of about ``limit`` bytes; a NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    rows = len(column)
    if not rows:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, rows)
        low, high = offsets[first], offsets[last]
        yield first, data[low:high], offsets[first : last + 1] - low
        first = last


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a little-endian number; zeros follow the data."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    out = np.zeros(n + 8, dtype=np.uint64)
    for shift in range(min(8, n)):
        own = len(range(shift, n, 8))
        out[shift:n:8] = padded[shift : shift + 8 * own].view(np.uint64)
    return out


class WordMemory:
    """Token ids of words, remembered in arrays of bounded size and looked up for many words at once.

    An entry is found by the word's hash, length and first and last eight bytes, which is the whole word if it has 16
    bytes or less. When the table is three quarters full it is emptied. ``kind`` is the type of an id.
    """

    #: Places of the table, of 36 bytes each; an eighth as many words are looked up at once.
    PLACES = 1 << 20
    #: Ids after which the table is emptied too.
    IDS = 4 << 20

    def __init__(self, kind: np.dtype, places: int = PLACES) -> None:
        self.kind, self.words, self.mask = np.dtype(kind), places // 8, np.uint64(places - 1)
        self.clear()

    def clear(self) -> None:
        size = int(self.mask) + 1
        self.hash, self.first, self.last = (np.zeros(size, dtype=np.uint64) for _ in range(3))
        self.length = np.full(size, -1, dtype=np.int32)
        self.at, self.count = np.zeros(size, dtype=np.int32), np.zeros(size, dtype=np.int32)
        self.ids, self.used, self.held = np.zeros(1 << 16, dtype=self.kind), 0, 0

    def __call__(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, learn: Callable[[list[bytes]], tuple]
    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, how many each word has); ``learn`` gives the same of new words."""
        eight, found, counts = eight_bytes(data), [np.zeros(0, dtype=self.kind)], [np.zeros(0, dtype=np.int64)]
        for low in range(0, len(starts), self.words):
            own = slice(low, low + self.words)
            slots = self._slots(data, eight, starts[own], ends[own], hashes[own], learn)
            n = self.count[slots].astype(np.int64)
            before = np.cumsum(n) - n
            found.append(self.ids[np.repeat(self.at[slots] - before, n) + np.arange(n.sum())])
            counts.append(n)
        return np.concatenate(found), np.concatenate(counts)

    def _slots(self, data, eight, starts, ends, hashes, learn) -> np.ndarray:
        if self.held + len(starts) > 6 * self.words or self.used > self.IDS:
            self.clear()
        length = (ends - starts).astype(np.int32)
        unused = np.uint64(8) * np.maximum(8 - length, 0).astype(np.uint64)
        first = np.where(length > 0, eight[starts] << unused, np.uint64(0))
        last = np.where(length > 8, eight[np.maximum(ends - 8, 0)], first)
        key = (hashes, first, last, length)
        slots, missing = self._find(*key)
        if len(missing):
            # new words: one of each, in the order of their hashes
            order = missing[np.lexsort((last[missing], first[missing], length[missing], hashes[missing]))]
            new = np.ones(len(order), dtype=bool)
            new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in key])
            one = order[new]
            whole = data.tobytes()
            ids, counts = learn([whole[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())])
            self._insert(*(k[one] for k in key), ids, counts)
            slots[missing], none = self._find(*(k[missing] for k in key))
            assert not len(none)
        return slots

    def _find(self, hashes, first, last, length) -> tuple[np.ndarray, np.ndarray]:
        """(place of each word, the numbers of those that have none)."""
        slots = (hashes & self.mask).astype(np.int64)
        open_, missing = np.arange(len(slots)), [np.zeros(0, dtype=np.int64)]
        while len(open_):
            at = slots[open_]
            free = self.length[at] < 0
            same = (self.hash[at] == hashes[open_]) & (self.length[at] == length[open_])
            same &= (self.first[at] == first[open_]) & (self.last[at] == last[open_])
            missing.append(open_[free])
            open_ = open_[~free & ~same]
            slots[open_] = (slots[open_] + 1) & int(self.mask)
        return slots, np.sort(np.concatenate(missing))

    def _insert(self, hashes, first, last, length, data, counts) -> None:
        if self.used + len(data) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(self.ids), len(data)), dtype=self.kind)])
        self.ids[self.used : self.used + len(data)] = data
        places = self.used + np.cumsum(counts) - counts
        self.used += len(data)
        self.held += len(counts)
        slots, open_ = (hashes & self.mask).astype(np.int64), np.arange(len(counts))
        while len(open_):
            free = open_[self.length[slots[open_]] < 0]
            self.at[slots[free]] = free  # of several the last one gets the place
            taken = free[self.at[slots[free]] == free]
            at = slots[taken]
            self.hash[at], self.first[at], self.last[at], self.length[at] = hashes[taken], first[taken], last[taken], length[taken]
            self.at[at], self.count[at] = places[taken], counts[taken]
            left = np.ones(len(counts), dtype=bool)
            left[taken] = False
            open_ = open_[left[open_]]
            slots[open_] = (slots[open_] + 1) & int(self.mask)
