"""Repeated byte strings between documents, found by merging the Burrows-Wheeler transforms of shards of text.

A byte is removed if a string of LENGTH bytes that covers it also starts in a document of a smaller id.

Texts are stored as shards, compressed runs of whole texts, which is all that moves later. They are cut into short strings
that together hold every window of LENGTH bytes once: consecutive windows with the same minimizer (the place of the least
hash of GRAM bytes in the window) make one string. Equal windows have equal minimizers, and equal text on that side of it
where the window has more: a string whose gram, with so much of the text before or after it, stands in one document only
cannot repeat. Shards send the hashes of these to be counted, and get back a bit for each. Grams that a sample finds very
frequent count as the largest, so that strings do not crowd around them.

The other strings meet in buckets by gram, equal ones as the one of the least document. Some of a bucket at a time are
suffix-sorted by themselves, which gives their Burrows-Wheeler transform. The transforms are merged without sorting their suffixes again: the interleave, which
tells from what shard the next row of the merged order comes, starts with one shard after the other and is refined by
putting the rows, in the order so far, into buckets of the characters before them. After h characters rows stand in the
order of their first h characters, and neighbours differ within these where a block boundary has come up (their common
prefix is the number of characters when it did). Only rows where windows end take part, blocks of one row cannot repeat and
are dropped on the way, and the blocks left after LENGTH characters are the repeated intervals.

Of equal strings those of all documents but the least are known to go, in a shard before any are sent.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import mix, stored, text_slices

LENGTH = 50
GRAM = 16
#: Windows with one minimizer, at most; the longest string.
SPREAD = LENGTH - GRAM + 1
LONGEST = LENGTH + SPREAD - 1
#: A window has so many bytes before its gram, or after it.
BESIDE = (LENGTH - GRAM) // 2
#: Bytes of text in a shard (a longer text is one by itself), and of those that are cut at once.
SHARD_BYTES = 1 << 20
#: Grams that are counted in one task, and bytes of strings in a bucket.
BUCKET_GRAMS = 2 << 20
BUCKET_BYTES = 16 << 20
#: Bytes of strings that are merged at once, and of those whose suffixes are sorted at once.
MERGE_BYTES = 2 << 20
SORT_BYTES = 1 << 19
#: Texts in the sample that only tells frequent grams (results do not depend on it); a gram of more than one of
#: HOT_SHARE strings of it counts as the largest, so there are fewer than HOT_SHARE of these.
SAMPLE_DOCS = 2_000
HOT_SHARE = 1_024

_END = 0xFF  # never in UTF-8
_LANES = -(-LONGEST // 8)
_SALT = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_NO_ID = -(1 << 63)
_NOWHERE = np.uint64((1 << 64) - 1)


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; zeros follow the data."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    out = np.empty(n, dtype=np.uint64)
    for shift in range(min(8, n)):
        own = len(range(shift, n, 8))
        out[shift::8] = padded[shift : shift + 8 * own].view(np.uint64)
    return out


def _gram_hashes(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return mix(mix(low) * _SALT + high)


def _beside(words: np.ndarray, starts: np.ndarray, inside: np.ndarray, side: int) -> np.ndarray:
    """48-bit values of the GRAM + BESIDE bytes from each start on, _NOWHERE if they are not inside a text."""
    out, size = np.full(len(starts), _NOWHERE), GRAM + BESIDE
    starts = starts[inside]
    hashes = np.full(len(starts), side, dtype=np.uint64)
    for k in [*range(0, size - 8, 8), size - 8]:
        hashes = mix(hashes * _SALT + words[starts + k])
    out[inside] = hashes >> np.uint64(16)
    return out


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _cut(data: np.ndarray, offsets: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return none, none, none, none, *[none.astype(np.uint64)] * 2
    words = _words_at(data)
    hashes = _gram_hashes(words[: n - GRAM + 1], words[GRAM - 8 : n - 7])
    packed = (hashes >> np.uint64(33)) << np.uint64(32)
    if len(hot):
        known = np.zeros(1 << 16, dtype=bool)
        known[hot >> np.uint64(48)] = True
        maybe = np.flatnonzero(known[hashes >> np.uint64(48)])
        packed[maybe[np.isin(hashes[maybe], hot)]] |= np.uint64(1 << 63)
    packed |= np.arange(len(packed), dtype=np.uint64)
    least = _window_minima(packed, SPREAD)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))[: len(least)]
    places = np.flatnonzero(np.arange(len(least)) + LENGTH <= offsets[1:][text])
    if not len(places):
        return none, none, none, none, *[none.astype(np.uint64)] * 2
    least, text = least[places], text[places]
    new = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])))
    runs = np.diff(np.append(new, len(places)))
    gram = (least[new] & _LOW).astype(np.int64)
    text = text[new].astype(np.int64)
    after = _beside(words, gram, gram + GRAM + BESIDE <= offsets[1:][text], 1)
    before = _beside(words, gram - BESIDE, gram - BESIDE >= offsets[text], 2)
    return places[new], runs + LENGTH - 1, gram, text, before, after


def cut_strings(data: np.ndarray, offsets: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, length, place of the gram, text, before, after) of the strings of concatenated texts.

    text is its number, before and after are values of the gram with the BESIDE bytes before or after it.

    Whether a window's minimizer is the same elsewhere depends on nothing but the window: the leftmost of the least
    hashes, hot grams last. A very long text is cut in overlapping pieces, which only makes more strings.
    """
    if len(offsets) > 2 or len(data) <= 2 * SHARD_BYTES:
        return _cut(data, offsets, hot)
    parts = []
    for low in range(0, len(data), SHARD_BYTES):
        piece = data[low : low + SHARD_BYTES + LENGTH - 1]
        start, length, gram, *rest = _cut(piece, np.array([0, len(piece)]), hot)
        parts.append((start + low, length, gram + low, *rest))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _compressed(data: bytes, level: int = 1) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(data)


def _restored(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _numbers(values: list) -> np.ndarray:
    return np.array(values, dtype=np.int64)


def _text_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (id, key, text) to (shard, ids, keys, data), some whole texts a row."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first, data, offsets in text_slices(batch.column(2), SHARD_BYTES):
            n = len(offsets) - 1
            whole = pa.array([0, n], pa.int32())
            ids, keys = (pa.ListArray.from_arrays(whole, batch.column(k).slice(first, n)) for k in (0, 1))
            packed = struct.pack("<Q", n) + offsets.astype(np.int64).tobytes() + _compressed(data.tobytes(), 3)
            columns = [pa.array([number], pa.int64()), ids, keys, pa.array([packed], pa.binary())]
            yield pa.record_batch(columns, names=["shard", "ids", "keys", "data"])
            number += 1


def _texts(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of a shard."""
    n = struct.unpack_from("<Q", packed)[0]
    offsets = np.frombuffer(packed, np.int64, n + 1, 8)
    return np.frombuffer(_restored(packed[16 + 8 * n :]), np.uint8), offsets


def _rows_of(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch one by one."""
    for k in range(batch.num_rows):
        yield [column[k].as_py() for column in batch.columns]


def _distinct(before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct values, strings in the order of their values, where in it each value's begin)."""
    values = np.concatenate([before, after])
    order = np.argsort(values)[: len(values) - int((values == _NOWHERE).sum())]
    starts = np.flatnonzero(np.append(True, np.diff(values[order]) > 0)) if len(order) else order
    return values[order][starts], order % max(1, len(before)), starts


def _bucket_edges(values: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of sorted values."""
    own = ((values >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    firsts = np.flatnonzero(np.append(True, np.diff(own) > 0)) if len(own) else own
    return zip(own[firsts].tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(own)])


def _gram_lists(hot: list[int], buckets: int):
    """Task function: (shard, keys, data) to (bucket, shard, grams), the distinct grams of a shard in a bucket."""
    hot = np.array(sorted(hot), dtype=np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, keys, data in _rows_of(batch):
                _, _, _, text, before, after = cut_strings(*_texts(data), hot)
                values, order, starts = _distinct(before, after)
                if not len(values):
                    continue
                doc = _numbers(keys)[text][order]
                several = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
                rows = []
                for bucket, low, high in _bucket_edges(values, buckets):
                    steps = np.diff(values[low:high], prepend=np.uint64(0))
                    planes = steps.view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()
                    bits = np.packbits(several[low:high]).tobytes()
                    rows.append((bucket, struct.pack("<I", high - low) + _compressed(planes + bits)))
                columns = [pa.array([b for b, _ in rows], pa.int32()), pa.array([shard] * len(rows), pa.int64())]
                yield pa.record_batch([*columns, pa.array([g for _, g in rows], pa.binary())], names=["bucket", "shard", "grams"])

    return run


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function over the rows of a bucket: (shard, bucket, n, bits), which grams of the list stand in several documents."""
    origin, lists, flags = [], [], []
    for batch in batches:
        for bucket, shard, grams in _rows_of(batch):
            n = struct.unpack_from("<I", grams)[0]
            data = np.frombuffer(_restored(grams[4:]), np.uint8)
            steps = np.zeros((n, 8), dtype=np.uint8)
            steps[:, :6] = data[: 6 * n].reshape(6, n).T
            lists.append(np.cumsum(steps.view(np.uint64)[:, 0], dtype=np.uint64))
            flags.append(np.unpackbits(data[6 * n :], count=n).astype(bool))
            origin.append((shard, bucket))
    if not lists:
        return
    values, several = np.concatenate(lists), np.concatenate(flags)
    order = np.argsort(values)
    starts = np.flatnonzero(np.append(True, np.diff(values[order]) > 0))
    sizes = np.diff(np.append(starts, len(order)))
    again = (sizes > 1) | np.logical_or.reduceat(several[order], starts)
    several[order] = np.repeat(again, sizes)
    edges = np.cumsum([0, *map(len, lists)])
    rows = [(*o, int(several[a:b].sum()), np.packbits(several[a:b]).tobytes()) for o, a, b in zip(origin, edges, edges[1:])]
    rows = [r for r in rows if r[2]]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    yield pa.record_batch(columns, names=["shard", "bucket", "n", "bits"])


def _matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One row a string, filled up with zeros to whole eight bytes."""
    padded = np.concatenate([data, np.zeros(8 * _LANES, dtype=np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, 8 * _LANES)[starts]
    rows[np.arange(8 * _LANES) >= lengths[:, None]] = 0
    return rows


def _equal_groups(rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts of groups in it): rows of a group are equal byte by byte."""
    lanes = rows.view(np.uint64)
    hashes = lengths.astype(np.uint64)
    for k in range(_LANES):
        hashes = mix(hashes * _SALT + lanes[:, k])
    order = np.argsort(hashes)
    same = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    a, b = order[same], order[same + 1]
    same = same[(lanes[a] == lanes[b]).all(axis=1) & (lengths[a] == lengths[b])]
    new = np.ones(len(order), dtype=bool)
    new[same + 1] = False
    return order, np.flatnonzero(new)


@dataclass
class Strings:
    """Strings with the shard, the number of the text in it and the place that each comes from, and its document's key."""

    rows: np.ndarray
    lengths: np.ndarray
    gram: np.ndarray
    key: np.ndarray
    shard: np.ndarray
    number: np.ndarray
    start: np.ndarray

    def pick(self, wanted: np.ndarray) -> Strings:
        return Strings(*(x[wanted] for x in vars(self).values()))

    def __len__(self) -> int:
        return len(self.lengths)

    @staticmethod
    def joined(several: list[Strings]) -> Strings:
        return Strings(*(np.concatenate(x) for x in zip(*(vars(s).values() for s in several))))

    def hashes(self) -> np.ndarray:
        """Hash of each string's gram."""
        at = np.arange(len(self))[:, None]
        grams = self.rows[at, self.gram[:, None] + np.arange(GRAM)].view(np.uint64)
        return _gram_hashes(grams[:, 0], grams[:, 1])

    def repeated(self) -> np.ndarray:
        """Which strings are equal to one of a smaller document."""
        out = np.zeros(len(self), dtype=bool)
        if len(self):
            order, starts = _equal_groups(self.rows, self.lengths)
            least = np.minimum.reduceat(self.key[order], starts)
            out[order] = self.key[order] > np.repeat(least, np.diff(np.append(starts, len(order))))
        return out

    def ranges(self) -> np.ndarray:
        """(shard, number, start, end) of whole strings."""
        return np.stack([self.shard, self.number, self.start, self.start + self.lengths], axis=1)

    def packed(self) -> bytes:
        """All but the shard."""
        used = np.arange(self.rows.shape[1]) < self.lengths[:, None]
        columns = (self.lengths, np.uint8), (self.gram, np.uint8), (self.key, np.int64), (self.number, np.int64), (self.start, np.int64)
        data = b"".join([*(x.astype(kind).tobytes() for x, kind in columns), self.rows[used].tobytes()])
        return struct.pack("<I", len(self)) + _compressed(data)

    @staticmethod
    def unpacked(shard: int, blob: bytes) -> Strings:
        n, at, columns = struct.unpack_from("<I", blob)[0], 0, []
        data = _restored(blob[4:])
        for kind in (np.uint8, np.uint8, np.int64, np.int64, np.int64):
            columns.append(np.frombuffer(data, kind, n, at))
            at += columns[-1].nbytes
        lengths, gram, key, number, start = columns
        lengths, gram = lengths.astype(np.int64), gram.astype(np.int64)
        rows = np.zeros((n, 8 * _LANES), dtype=np.uint8)
        rows[np.arange(8 * _LANES) < lengths[:, None]] = np.frombuffer(data, np.uint8, offset=at)
        return Strings(rows, lengths, gram, key, np.full(n, shard), number, start)


def _by_shard(ranges: np.ndarray) -> pa.RecordBatch:
    """(shard, ranges): packed (number, start, end) of (shard, number, start, end), a row for each shard."""
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    edges = np.append(np.flatnonzero(np.append(True, np.diff(ranges[:, 0]) > 0)), len(ranges)).tolist()
    data = [np.ascontiguousarray(ranges[a:b, 1:]).tobytes() for a, b in zip(edges, edges[1:])]
    shards = pa.array(np.ascontiguousarray(ranges[edges[:-1], 0]))
    return pa.record_batch([shards, pa.array(data, pa.binary())], names=["shard", "ranges"])


def _survivors(hot: list[int], gram_buckets: int, buckets: int):
    """Task function: (shard, keys, data, marks) to (bucket, shard, strings, ranges): what is sent, what goes at once."""
    hot = np.array(sorted(hot), dtype=np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, keys, packed, marks in _rows_of(batch):
                data, offsets = _texts(packed)
                start, length, gram, text, before, after = cut_strings(data, offsets, hot)
                values, order, starts = _distinct(before, after)
                bits = {m["bucket"]: m["bits"] for m in marks}
                again = np.zeros(len(values), dtype=bool)
                for bucket, low, high in _bucket_edges(values, gram_buckets):
                    if bucket in bits:
                        again[low:high] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=high - low)
                wanted = np.zeros(len(start), dtype=bool)
                wanted[order[np.repeat(again, np.diff(np.append(starts, len(order))))]] = True
                start, length, gram, text = (x[wanted] for x in (start, length, gram, text))
                rows = _matrix(data, start, length)
                own = Strings(rows, length, gram - start, _numbers(keys)[text], np.full(len(text), shard), text, start - offsets[text])
                gone = own.repeated()
                found = []
                if gone.any():
                    ranges = own.pick(gone).ranges()
                    found.append((shard % buckets, None, np.ascontiguousarray(ranges[:, 1:]).tobytes()))
                own = own.pick(~gone)
                bucket = (mix(own.hashes() + _SALT) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) > 0)), len(order)) if len(order) else order
                for low, high in zip(edges[:-1], edges[1:]):
                    found.append((int(bucket[order[low]]), own.pick(order[low:high]).packed(), None))
                columns = [pa.array([r[0] for r in found], pa.int32()), pa.array([shard] * len(found), pa.int64())]
                columns += [pa.array([r[k] for r in found], pa.binary()) for k in (1, 2)]
                yield pa.record_batch(columns, names=["bucket", "shard", "strings", "ranges"])

    return run


def shard_transform(text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix array, Burrows-Wheeler transform, last-to-first map) of strings of these lengths, _END after each.

    Equal suffixes of several strings stand in the order of the strings.
    """
    n = len(text)
    string = np.repeat(np.arange(len(lengths)), lengths + 1)
    left = np.cumsum(lengths + 1)[string] - np.arange(n)  # characters with the end
    padded = np.append(text, np.zeros(8, dtype=np.uint8)).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(left > k, padded[k : k + n], np.uint64(0))
    order = np.argsort(key)
    new = np.append(True, key[order][1:] != key[order][:-1])
    rank, size = np.empty(n, dtype=np.int64), 8
    rank[order] = np.cumsum(new) - 1
    while not new.all():
        later = np.append(rank[size:], np.zeros(min(size, n), dtype=np.int64))[:n]
        both = (rank << 32) | np.where(left <= size, string, later)
        order = np.argsort(both)
        both = both[order]
        new = np.append(True, both[1:] != both[:-1])
        rank[order] = np.cumsum(new) - 1
        size *= 2
    before = np.append(np.uint8(_END), text[:-1])[order]
    # rows with equal characters before them stand in the order of the suffixes that begin with these characters
    first = np.empty(n, dtype=np.int32)
    first[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    return order, before, first


def merge_shards(
    shards: list[tuple[np.ndarray, np.ndarray]], length: int, ends: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(row, block) of the rows, counted over all shards, whose first ``length`` characters stand at several rows.

    ``shards`` are (transform, last-to-first map). The rows come in the merged order, blocks of equal prefixes in turn.
    ``ends`` are the rows of the suffixes right after the strings of ``length`` that are asked for, all if not given.
    """
    sizes = np.cumsum([0, *(len(b) for b, _ in shards)])
    before = np.concatenate([b for b, _ in shards])
    first = np.concatenate([f + base for (_, f), base in zip(shards, sizes.tolist())]).astype(np.int32)
    # two characters a step: the pair before each row, and the row of the suffix that begins with the pair
    pair = (before[first].astype(np.uint16) << np.uint16(8)) | before
    whole = (before != _END) & (before[first] != _END)
    moves = [(before, before != _END, first)] * (length % 2) + [(pair, whole, first[first])] * (length // 2)
    rows = np.arange(len(before), dtype=np.int32) if ends is None else ends.astype(np.int32)
    block = np.zeros(len(rows), dtype=np.int32)
    for characters, inside, target in moves:
        stays = inside[rows]
        if not stays.all():
            rows, block = rows[stays], block[stays]
        c = characters[rows]
        order = np.argsort(c, kind="stable")
        c, block, rows = c[order], block[order], target[rows[order]]
        new = np.ones(len(rows) + 1, dtype=bool)
        if len(rows):
            new[1:-1] = (c[1:] != c[:-1]) | (block[1:] != block[:-1])
        several = ~(new[:-1] & new[1:])
        block = np.cumsum(new[:-1], dtype=np.int32)[several]
        rows = rows[several]
    return rows, block


def _merged(strings: Strings) -> Iterator[np.ndarray]:
    """Ranges (shard, number, start, end) of what of the strings stands in smaller documents."""
    shards, places, numbers = [], [], []
    cuts = np.cumsum(strings.lengths + 1) // SORT_BYTES
    edges = np.append(np.flatnonzero(np.append(True, np.diff(cuts) > 0)), len(strings))
    for low, high in zip(edges[:-1], edges[1:]):
        lengths = strings.lengths[low:high]
        rows = np.concatenate([strings.rows[low:high], np.zeros((high - low, 1), dtype=np.uint8)], axis=1)
        rows[np.arange(high - low), lengths] = _END
        text = rows[np.arange(rows.shape[1]) <= lengths[:, None]]
        order, before, first = shard_transform(text, lengths)
        shards.append((before, first))
        string = np.repeat(np.arange(high - low), lengths + 1)[order]
        numbers.append(string + low)
        places.append(order - (np.cumsum(lengths + 1) - lengths - 1)[string])
    string, place = np.concatenate(numbers), np.concatenate(places)
    rows, block = merge_shards(shards, LENGTH, np.flatnonzero(place >= LENGTH))
    if not len(rows):
        return
    string, place = string[rows], place[rows]
    key = strings.key[string]
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    later = key > np.repeat(np.minimum.reduceat(key, starts), np.diff(np.append(starts, len(key))))
    string, place = string[later], place[later]
    if not len(string):
        return
    # windows of one string overlap, so what they cover is one range
    order = np.argsort(string * 256 + place)
    string, place = string[order], place[order]
    starts = np.flatnonzero(np.append(True, string[1:] != string[:-1]))
    own, low, high = string[starts], place[starts], place[np.append(starts[1:], len(place)) - 1] + LENGTH
    begin = strings.start[own]
    yield np.stack([strings.shard[own], strings.number[own], begin + low, begin + high], axis=1)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function over the rows of one bucket: (shard, ranges) of what is removed."""
    held, size, ranges = [], 0, [np.zeros((0, 4), dtype=np.int64)]

    def joined() -> Strings:
        strings = Strings.joined(held)
        gone = strings.repeated()
        ranges.append(strings.pick(gone).ranges())
        return strings.pick(~gone)

    for batch in batches:
        for _, shard, strings, known in _rows_of(batch):
            if known is not None:
                yield pa.record_batch([pa.array([shard], pa.int64()), pa.array([known], pa.binary())], names=["shard", "ranges"])
                continue
            held.append(Strings.unpacked(shard, strings))
            size += held[-1].rows.nbytes
            if size > 4 * BUCKET_BYTES:  # a frequent gram: what is left of equal strings takes their place
                held = [joined()]
                size = held[0].rows.nbytes // 2
    if not held:
        return
    strings = joined()
    held.clear()
    hashes = strings.hashes()
    order = np.argsort(hashes, kind="stable")
    new = np.append(True, np.diff(hashes[order]) > 0) if len(order) else np.zeros(0, dtype=bool)
    # a string that has its gram for itself shares no window
    alone = new & np.append(new[1:], True) if len(order) else new
    order, new = order[~alone], new[~alone]
    # grams are dealt to merges whole; in a merge the strings stand as they came, shard after shard
    before = np.cumsum(strings.lengths[order]) - strings.lengths[order]
    at = np.maximum.accumulate(np.where(new, before, 0)) // MERGE_BYTES
    edges = np.append(np.flatnonzero(np.append(True, np.diff(at) > 0)), len(order)) if len(order) else order
    for low, high in zip(edges[:-1], edges[1:]):
        ranges += _merged(strings.pick(np.sort(order[low:high])))
    ranges = np.concatenate(ranges)
    if len(ranges):
        yield _by_shard(ranges)


def frequent_grams(shards: DataFrame) -> list[int]:
    """Hashes of the grams that very many strings of a sample of texts meet at; fewer than HOT_SHARE."""
    n = shards.agg(F.sum(F.size("keys"))).first()[0] or 0
    share = min(1.0, SAMPLE_DOCS / max(n, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, packed in _rows_of(batch):
                data, offsets = _texts(packed)
                own = np.random.default_rng(shard).random(len(offsets) - 1) < share
                texts = [data[a:b] for a, b, o in zip(offsets[:-1], offsets[1:], own) if o]
                if texts:
                    own = np.concatenate(texts)
                    gram = cut_strings(own, np.cumsum([0, *map(len, texts)]), np.zeros(0, dtype=np.uint64))[2]
                    words = _words_at(own)
                    grams, amounts = np.unique(_gram_hashes(words[gram], words[gram + GRAM - 8]), return_counts=True)
                    columns = [pa.array(grams.view(np.int64)), pa.array(amounts.astype(np.int64))]
                    yield pa.record_batch(columns, names=["gram", "n"])

    counts = shards.select("shard", "data").mapInArrow(run, "gram bigint, n bigint")
    counts = stored(counts.groupBy("gram").agg(F.sum("n").alias("n")), "sampled-grams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r["gram"] for r in counts.where(F.col("n") * HOT_SHARE > total).select("gram").collect()]


def text_shards(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(shard, ids, keys, n_bytes, data) of all rows, stored; an id's key is its number, the least one for NULL."""
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), key.alias("key"), F.col(text_col))
    out = f"shard bigint, ids array<{kind}>, keys array<bigint>, data binary"
    return stored(rows.mapInArrow(_text_shards, out), "text-shards")


def repeated_ranges(shards: DataFrame) -> DataFrame:
    """(shard, ranges): packed (text number, start, end) of the byte ranges that are to be removed; they may overlap."""
    n_shards = shards.count()
    hot = frequent_grams(shards)
    # two values for half of SPREAD windows or so, and at most SHARD_BYTES of text in most shards
    grams = max(1, -(-n_shards * (4 * SHARD_BYTES // SPREAD) // BUCKET_GRAMS))
    lists = shards.select("shard", "keys", "data").mapInArrow(_gram_lists(hot, grams), "bucket int, shard bigint, grams binary")
    marks = lists.repartitionById(grams, "bucket").mapInArrow(_marked, "shard bigint, bucket int, n bigint, bits binary")
    marks = stored(marks, "marks")
    strings = marks.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-strings * LONGEST // (2 * BUCKET_BYTES)))
    marks = marks.groupBy("shard").agg(F.collect_list(F.struct("bucket", "bits")).alias("marks"))
    known = shards.select("shard", "keys", "data").join(marks, "shard")
    sent = known.mapInArrow(_survivors(hot, grams, buckets), "bucket int, shard bigint, strings binary, ranges binary")
    return sent.repartitionById(buckets, "bucket").mapInArrow(_merge, "shard bigint, ranges binary")


_SPANS = "array<struct<start:bigint,end:bigint>>"


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (ids, data, ranges) to (doc_id, n_bytes, removed, kept) of each text."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for k in range(batch.num_rows):
            data, offsets = _texts(batch.column(1)[k].as_py())
            own = [np.zeros((0, 3), dtype=np.int64)]
            own += [np.frombuffer(r, np.int64).reshape(-1, 3) for r in batch.column(2)[k].as_py() or []]
            ranges = np.concatenate(own)
            # ranges in places of the shard's text, joined where they touch within a text
            edges = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(edges, offsets[ranges[:, 0]] + ranges[:, 1], 1)
            np.add.at(edges, offsets[ranges[:, 0]] + ranges[:, 2], -1)
            gone = np.cumsum(edges[:-1]) > 0
            change = gone[1:] != gone[:-1]
            change[offsets[(offsets > 0) & (offsets < len(data))] - 1] = True
            starts = np.append(0, np.flatnonzero(change) + 1) if len(data) else np.zeros(0, dtype=np.int64)
            ends = np.append(starts[1:], len(data))[: len(starts)]
            starts, ends = starts[gone[starts]], ends[gone[starts]]
            text = np.searchsorted(offsets, starts, side="right") - 1
            per_text = np.searchsorted(text, np.arange(len(offsets)))
            spans = pa.StructArray.from_arrays([pa.array(starts - offsets[text]), pa.array(ends - offsets[text])], ["start", "end"])
            left = np.append(0, np.cumsum(~gone))[offsets]
            kept = data[~gone].tobytes()
            columns = [
                batch.column(0)[k].values,
                pa.array(np.diff(offsets)),
                pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), spans).cast(span),
                pa.array([kept[a:b] for a, b in zip(left[:-1], left[1:])], pa.binary()),
            ]
            yield pa.record_batch(columns, names=["doc_id", "n_bytes", "removed", "kept"])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, removed, kept), one row per row of ``docs``.

    removed are the byte ranges (from, to), apart and in order, that strings of LENGTH bytes of documents with smaller ids
    cover; kept the other bytes. Ids are numbers, a NULL one is smaller than all others; rows that share an id are one
    document, so they remove nothing from each other. NULL and empty texts have no bytes, and a text of fewer than LENGTH
    bytes keeps all. An empty table gives no row. Other columns are not read.
    """
    shards = text_shards(docs, id_col, text_col)
    ranges = repeated_ranges(shards).groupBy("shard").agg(F.collect_list("ranges").alias("ranges"))
    both = shards.select("shard", "ids", "data").join(ranges, "shard", "left").select("ids", "data", "ranges")
    kind = docs.schema[id_col].dataType.simpleString()
    return both.mapInArrow(_without, f"doc_id {kind}, n_bytes bigint, removed {_SPANS}, kept binary")
