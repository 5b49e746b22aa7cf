"""Benchmark passages in documents, found by winnowing.

Words are runs of digits, a-z and all that is not ASCII, after lower-casing A-Z. A window is WINDOW consecutive words
of a benchmark item; an item of fewer words (but not none) is one window. In every window of WINDOW words the least
hash of its GRAM-word grams is its fingerprint, so a document and an item that share a window share its fingerprint:
no shared span of WINDOW words is missed. A fingerprint that both sides have is extended to the windows around it, and
these are compared as wholes (by 128 bits).

The fingerprints of the items are sent to the tasks in blocks of bounded size; documents are read in place and not
shuffled, however many of them hold the same passage.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import ALNUM_WORDS, WordHasher, gram_hashes, mix, stored, text_slices

WINDOW = 10
GRAM = 6
#: Characters of benchmark text whose windows are sent to the tasks at once (about 20 bytes of index each, at most);
#: a larger benchmark is searched in several passes.
BLOCK_CHARS = 4_000_000
_OTHER = np.uint64(0x5851F42D4C957F2D)
_BITMAP_BITS = 20


def _fingerprints(words: np.ndarray, size: int) -> np.ndarray:
    """The least hash of the grams in each window of ``size`` words."""
    gram = min(GRAM, size)
    hashes = gram_hashes(words, gram)
    n = len(words) - size + 1
    out = hashes[:n].copy()
    for j in range(1, size - gram + 1):
        np.minimum(out, hashes[j : j + n], out=out)
    return out


class WindowIndex:
    """The windows of some items, by window size: fingerprints, whole windows and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str]]) -> None:
        hasher, found = WordHasher(ALNUM_WORDS), defaultdict(list)
        self.items = sorted({i for i, _ in items if i is not None})
        number = {item: k for k, item in enumerate(self.items)}
        for item, text in items:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            words, _, _, _ = hasher(data, np.array([0, len(data)]))
            size = min(WINDOW, len(words))
            if size:
                found[size].append((words, number.get(item, -1)))
        self.sizes = {}
        for size, texts in found.items():
            prints = np.unique(np.concatenate([_fingerprints(w, size) for w, _ in texts]))
            first = np.concatenate([gram_hashes(w, size) for w, _ in texts])
            second = np.concatenate([gram_hashes(mix(w ^ _OTHER), size) for w, _ in texts])
            owner = np.concatenate([np.full(len(w) - size + 1, k, dtype=np.int64) for w, k in texts])
            order = np.lexsort((owner, second, first))
            first, second, owner = first[order], second[order], owner[order]
            new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
            starts = np.flatnonzero(new)
            owners = np.append(starts, len(owner))
            bitmap = np.zeros(1 << _BITMAP_BITS, dtype=bool)
            bitmap[prints >> np.uint64(64 - _BITMAP_BITS)] = True
            self.sizes[size] = (prints, bitmap, first[starts], second[starts], owners, owner)

    def search(self, words: np.ndarray, text_offsets: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Which words of the texts are hit, and the numbers of the items found in each text (by its number)."""
        edges = np.zeros(len(words) + 1, dtype=np.int64)
        found: dict[int, set[int]] = defaultdict(set)
        for size, (prints, bitmap, first, second, owners, owner) in self.sizes.items():
            if len(words) < size:
                continue
            marks = _fingerprints(words, size)
            maybe = np.flatnonzero(bitmap[marks >> np.uint64(64 - _BITMAP_BITS)])
            maybe = maybe[np.isin(marks[maybe], prints)]
            text = np.searchsorted(text_offsets, maybe, side="right") - 1
            inside = maybe + size <= text_offsets[text + 1]
            maybe, text = maybe[inside], text[inside]
            if not len(maybe):
                continue
            # the windows around a shared fingerprint, compared as wholes
            around = words[maybe[:, None] + np.arange(size)]
            a, b = np.full(len(maybe), size, dtype=np.uint64), np.full(len(maybe), size, dtype=np.uint64)
            for j in range(size):
                a = a * np.uint64(0xD6E8FEB86659FD93) + around[:, j]
                b = b * np.uint64(0xD6E8FEB86659FD93) + mix(around[:, j] ^ _OTHER)
            a, b = mix(a), mix(b)
            at = np.minimum(np.searchsorted(first, a), len(first) - 1)
            while True:  # windows whose first 64 bits are equal stand side by side
                further = (first[at] == a) & (second[at] < b) & (at + 1 < len(first))
                further[further] &= first[at[further] + 1] == a[further]
                if not further.any():
                    break
                at[further] += 1
            same = (first[at] == a) & (second[at] == b)
            maybe, text, at = maybe[same], text[same], at[same]
            np.add.at(edges, maybe, 1)
            np.add.at(edges, maybe + size, -1)
            for t, w in np.unique(np.stack([text, at]), axis=1).T.tolist():
                found[t].update(owner[owners[w] : owners[w + 1]].tolist())
        return np.cumsum(edges[:-1]) > 0, found


def _search(docs: DataFrame, index: WindowIndex) -> DataFrame:
    """Adds what ``index`` finds to (doc_id, text, n_words, hits, items, ...)."""
    names = docs.columns
    ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALNUM_WORDS)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                words, text_offsets, _, _ = hasher(data, offsets)
                rows = batch.slice(first, len(offsets) - 1)
                hit, found = index.search(words, text_offsets)
                hits, items = rows.column(3).to_pylist(), rows.column(4).to_pylist()
                for t, numbers in found.items():
                    own = hit[text_offsets[t] : text_offsets[t + 1]]
                    for r in hits[t]:
                        own[r["start"] : r["end"]] = True
                    change = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
                    hits[t] = [{"start": a, "end": b} for a, b in change.reshape(-1, 2).tolist()]
                    items[t] = sorted({*items[t], *(index.items[k] for k in numbers if k >= 0)})
                columns = [rows.column(0), rows.column(1), pa.array(np.diff(text_offsets), pa.int64())]
                columns += [pa.array(hits, ranges), pa.array(items, pa.list_(pa.string())), *rows.columns[5:]]
                yield pa.record_batch(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, text, n_words, hits, items), one row per row of ``docs``, and then the columns that ``keep`` names.

    hits are the ranges of words (from, to) inside occurrences of windows, items the ids (as sorted strings) of the
    benchmark rows with such windows. NULL and empty texts have no words. An item without text has no window; the
    windows of one without id count as hits, but it is not listed; rows that share an item id are one item. Rows that
    repeat a doc_id are searched each by itself. An empty benchmark hits nothing. Other columns are not read.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("body"))
    items = items.where("body IS NOT NULL")
    chars = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    kept = [f"kept_{k}" for k in range(len(keep))]
    state = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit([]).cast("array<struct<start:bigint,end:bigint>>").alias("hits"),
        F.lit([]).cast("array<string>").alias("items"),
        *(F.col(f"`{c}`").alias(name) for c, name in zip(keep, kept)),
    )
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k) if blocks > 1 else items
        state = _search(state, WindowIndex([tuple(r) for r in block.collect()]))
        if k + 1 < blocks:
            state = stored(state, "searched")
    own = ["doc_id", "text", "n_words", "hits", "items"]
    return state.select(*own, *(F.col(name).alias(c) for c, name in zip(keep, kept)))


def contamination(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of ``find_benchmark``'s rows."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
