"""Importance resampling towards a target distribution of hashed word n-grams.

Documents and a target are counted into buckets of n-grams. A bucket's gain is the log of how much more frequent it is in
the target, a document's weight the mean gain of its n-grams, and the documents of the largest weights, each with a Gumbel
number drawn for its id, are a sample without replacement of the target's distribution.

The n-grams of a slice of texts are interned in an open-addressed table of NumPy arrays: an occurrence is looked up by
its 64-bit xxhash, steps on while another n-gram (by its bytes) has the slot, and takes the first free one. A slot keeps
the bucket and the count of its n-gram, so a bucket is found once for each distinct n-gram, and gains are gathered by the
occurrences' slot numbers.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.llm.common import ALNUM_WORDS, ASCII_LOWER, stored, text_slices

BUCKETS = 10_000
#: Bytes of texts whose n-grams share a table, and n-grams that are interned at once.
SLICE_BYTES = 2 << 20
TABLE_GRAMS = 1 << 20
#: Log odds are whole thousandths.
SCALE = 1000
#: Scores are counted in steps of 2**STEP_BITS to find about where the draw ends.
STEP_BITS = 6

# fixed values: the primes of 64-bit xxhash
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a little-endian number; zeros follow the data."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    out = np.empty(n + 8, dtype=np.uint64)
    out[n:] = 0
    for shift in range(min(8, n)):
        own = len(range(shift, n, 8))
        out[shift:n:8] = padded[shift : shift + 8 * own].view(np.uint64)
    return out


def xxhash64(data: np.ndarray, eight: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit xxhash (seed 0) of ranges of ``data``; those under 32 bytes are hashed together, length by length."""
    import xxhash

    out = np.empty(len(starts), dtype=np.uint64)
    order = np.argsort(np.minimum(lengths, 32).astype(np.uint8), kind="stable")
    edges = np.searchsorted(lengths[order], np.arange(33))
    for size in range(32):
        own = order[edges[size] : edges[size + 1]]
        if not len(own):
            continue
        at, left = starts[own], size
        h = np.full(len(own), int(_P5) + size, dtype=np.uint64)
        while left >= 8:
            h ^= _turned(eight[at] * _P2, 31) * _P1
            h = _turned(h, 27) * _P1 + _P4
            at, left = at + 8, left - 8
        if left >= 4:
            h ^= (eight[at] & np.uint64(0xFFFFFFFF)) * _P1
            h = _turned(h, 23) * _P2 + _P3
            at, left = at + 4, left - 4
        for k in range(left):
            h ^= (eight[at + k] & np.uint64(0xFF)) * _P5
            h = _turned(h, 11) * _P1
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        out[own] = h ^ (h >> np.uint64(32))
    whole = memoryview(data)
    for k in order[edges[32] :].tolist():
        out[k] = xxhash.xxh64_intdigest(whole[starts[k] : starts[k] + lengths[k]])
    return out


def _equal(data: np.ndarray, eight: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the bytes from a and from b on are the same."""
    same = np.ones(len(a), dtype=bool)
    checked = np.arange(len(a))
    for at in range(0, 64, 8):
        checked = checked[(lengths[checked] > at) & same[checked]]
        if not len(checked):
            return same
        unused = np.uint64(8) * np.maximum(at + 8 - lengths[checked], 0).astype(np.uint64)
        same[checked] = (eight[a[checked] + at] ^ eight[b[checked] + at]) << unused == 0
    for k in checked[(lengths[checked] > 64) & same[checked]].tolist():
        same[k] = np.array_equal(data[a[k] : a[k] + lengths[k]], data[b[k] : b[k] + lengths[k]])
    return same


class GramTable:
    """Interned byte ranges: ``slot`` of each, and the ``bucket`` and ``count`` of each slot that is taken."""

    def __init__(self, data: np.ndarray, eight: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> None:
        n = len(starts)
        size = 1 << max(4, (2 * n).bit_length())
        keys = xxhash64(data, eight, starts, lengths)
        owner = np.full(size, -1, dtype=np.int64)
        at = (keys & np.uint64(size - 1)).astype(np.int64)
        self.slot = np.empty(n, dtype=np.int64)
        open_ = np.arange(n)
        while len(open_):
            free = open_[owner[at[open_]] < 0]
            owner[at[free]] = free  # of several the last one gets the slot
            other = owner[at[open_]]
            found = (keys[other] == keys[open_]) & (lengths[other] == lengths[open_])
            maybe = np.flatnonzero(found & (other != open_))
            found[maybe] = _equal(data, eight, starts[other[maybe]], starts[open_[maybe]], lengths[open_[maybe]])
            self.slot[open_[found]] = at[open_[found]]
            open_ = open_[~found]
            at[open_] = (at[open_] + 1) & (size - 1)
        self.taken = np.flatnonzero(owner >= 0)
        whole, first = memoryview(data), owner[self.taken]
        ranges = zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist())
        self.bucket = np.zeros(size, dtype=np.int64)
        self.bucket[self.taken] = [zlib.crc32(whole[a:b]) % buckets for a, b in ranges]
        self.count = np.bincount(self.slot, minlength=size)


def grams(data: np.ndarray, offsets: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple], np.ndarray]:
    """(bytes, [(start, length, text) of the runs of 1, 2, … words], number of words of each text).

    The bytes are the words of the texts after lower-casing A-Z, each followed by one space.
    """
    low = ASCII_LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ALNUM_WORDS[low]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    lengths, edges = ends - starts, np.searchsorted(starts, offsets)
    ends = np.cumsum(lengths + 1)
    joined = np.full(ends[-1] if len(ends) else 0, 32, dtype=np.uint8)
    letters = np.ones(len(joined), dtype=bool)
    letters[ends - 1] = False
    joined[letters] = low[inside[1:-1]]
    starts, ends = ends - lengths - 1, ends - 1
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(edges))
    runs = []
    for k in range(longest):
        whole = np.flatnonzero(text[: len(text) - k] == text[k:]) if k < len(text) else np.zeros(0, dtype=np.int64)
        runs.append((starts[whole], ends[whole + k] - starts[whole], text[whole]))
    return joined, runs, np.diff(edges)


def _tables(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray, list[tuple[GramTable, np.ndarray]]]]:
    """(first row, number of words of each text, [(table, text of each occurrence)]) of slices of texts."""
    for first, data, offsets in text_slices(texts, SLICE_BYTES):
        joined, runs, words = grams(data, offsets, longest)
        eight = _eight_bytes(joined)

        def parts(runs=runs, joined=joined, eight=eight):
            for starts, lengths, text in runs:
                for low in range(0, len(starts), TABLE_GRAMS):
                    own = slice(low, low + TABLE_GRAMS)
                    yield GramTable(joined, eight, starts[own], lengths[own], buckets), text[own]

        yield first, words, parts()


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many n-grams of all texts fall into each bucket; buckets without any are left out.

    Repeats count. NULL and empty texts have no words; repeated rows count each. At most ``buckets`` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, tables in _tables(batch.column(0), longest, buckets):
                for table, _ in tables:
                    np.add.at(counts, table.bucket[table.taken], table.count[table.taken])
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    found = docs.select(F.col(text_col)).mapInArrow(run, "bucket bigint, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log odds, in whole thousandths, of each bucket in the target against the source, both with one more n-gram each."""
    amounts = []
    for counts in (source, target):
        amounts.append(np.zeros(buckets))
        for r in counts.select("bucket", "n").collect():  # at most ``buckets`` rows
            amounts[-1][r["bucket"]] = r["n"]
    (s, t), (total_s, total_t) = amounts, (float(x.sum()) for x in amounts)
    odds = (t + 1) * (total_s + buckets) / ((s + 1) * (total_t + buckets))
    return np.array([math.floor(SCALE * math.log(x)) for x in odds.tolist()], dtype=np.int64)


def weights(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = 1
) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the mean gain of each row's n-grams, floored; 0 without any.

    NULL and empty texts have no words; NULL and repeated ids are passed on as they are; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, tables in _tables(batch.column(1), longest, len(gain)):
                sums, features = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
                for table, text in tables:
                    np.add.at(sums, text, gain[table.bucket][table.slot])
                    features += np.bincount(text, minlength=len(words))
                mean = np.where(features > 0, sums // np.maximum(features, 1), 0)
                columns = [batch.column(0).slice(first, len(words)), *(pa.array(x.astype(np.int64)) for x in (words, features, mean))]
                yield pa.record_batch(columns, names=["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)


def draw(weighed: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per row of ``weighed``.

    score is the weight and a Gumbel number drawn by the seed and the id. Of the rows with ``least_words`` words or more
    the ``percent`` of the highest scores are drawn; rank numbers them from 1 and is NULL for all others. Ties go to the
    smaller id, a NULL id last, then one of repeated rows is as good as the other. An empty table gives no row.
    """
    id_text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(id_text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = weighed.withColumn("score", F.col("weight") + gumbel.cast("bigint"))
    scored = stored(scored.withColumn("tag", F.monotonically_increasing_id()), "scored")
    fits = scored.where(F.col("n_words") >= least_words)
    # a rough count of the scores, some hundred rows, tells about where the draw ends
    step = F.shiftright("score", STEP_BITS)
    steps = sorted(fits.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True)
    wanted, held, last = percent * sum(r["n"] for r in steps) // 100, 0, None
    for r in steps:
        if held >= wanted:
            break
        held, last = held + r["n"], r["step"]
    maybe = F.lit(False) if last is None else (F.col("n_words") >= least_words) & (step >= last)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tag")]
    top = scored.where(maybe).repartitionByRange(*order).sortWithinPartitions(*order)
    top = stored(top.withColumn("place", F.monotonically_increasing_id()), "drawn")  # partition, then row in it
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = top.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + row + 1
    ranked = top.withColumn("part", part).join(sizes, "part").withColumn("rank", F.when(rank <= wanted, rank))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = scored.where(~maybe).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(columns).unionByName(rest.select(columns))
