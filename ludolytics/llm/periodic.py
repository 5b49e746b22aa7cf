"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words that repeats with a smallest period q (words q apart are the same), has at least
MIN_REPEATS periods and MIN_LENGTH words, and is not a part of a longer one of that period.

Periods up to SHORT are found by comparing each word with the one so far behind it. For longer ones there is a scale for
each power of two g, for the periods over g / 2 up to g. In every window of g / 2 places the least hash of the g words
from a place on is the window's minimizer. Inside a run, windows a period apart are equal, so their minimizers stand a
period apart too, and as g words tell a place inside the period no other one between them is equal. So the pairs of
neighbouring equal minimizers of each scale, at a distance that is one of the scale's, seed all runs; each is extended
both ways as far as words a period apart agree. Four periods are long enough to hold two such windows at any scale.

Words are compared by 64-bit hashes, and once more by themselves in texts with a run; equal hashes of different groups of
words could hide a run with a chance of the squared number of words in 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import SPACED_WORDS, WORD_MULTIPLIER, WordHasher, mix, text_slices

MIN_REPEATS = 4
MIN_LENGTH = 6
#: Periods found by direct comparison; the scales begin with the next power of two.
SHORT = 8
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
    return edges[::2], edges[1::2]


def _agreeing(x: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """(first, end) of the places around ``at`` whose words equal those ``lag`` later, within the text [low, high)."""
    end, step = at, 64
    while end + lag < high:
        stop = min(end + step, high - lag)
        differ = x[end:stop] != x[end + lag : stop + lag]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, 2 * step
    first, step = at, 64
    while first > low:
        stop = max(first - step, low)
        differ = x[stop:first][::-1] != x[stop + lag : first + lag][::-1]
        if differ.any():
            first -= int(differ.argmax())
            break
        first, step = stop, 2 * step
    return first, end


def _seeds(x: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, distance) of the neighbouring equal minimizers of each scale."""
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    place, hashes = np.arange(len(x)), x
    size = 1  # words under a hash
    while True:
        scale = 2 * size
        if scale > SHORT:
            wanted = lengths[text] >= MIN_REPEATS * (scale // 2 + 1)
            if not wanted.all():  # texts too short for this scale's periods go
                text, place, hashes = text[wanted], place[wanted], hashes[wanted]
        if not len(text):
            return
        later = np.append(hashes[size:], np.zeros(min(size, len(hashes)), dtype=np.uint64))
        hashes = mix(hashes * np.uint64(WORD_MULTIPLIER) + later)
        size = scale
        if scale <= SHORT:
            continue
        window, n = scale // 2, len(hashes)
        least, at, span = hashes, np.arange(n), 1
        while span < window:
            right = least[span:] < least[:-span]
            at = np.where(right, at[span:], at[:-span])
            least = np.where(right, least[span:], least[:-span])
            span *= 2
        starts = np.arange(len(least))
        inside = place[: len(least)] + window + scale - 1 <= offsets[text[: len(least)] + 1]
        chosen = at[starts[inside]]
        chosen = chosen[np.append(True, np.diff(chosen) > 0)] if len(chosen) else chosen
        order = np.lexsort((hashes[chosen], text[chosen]))
        chosen = chosen[order]
        a, b = chosen[:-1], chosen[1:]
        distance = b - a
        equal = (hashes[a] == hashes[b]) & (text[a] == text[b]) & (distance > scale // 2) & (distance <= scale)
        yield place[a[equal]], distance[equal]


def _primes_of(n: int) -> list[int]:
    out, k = [], 2
    while k * k <= n:
        if n % k == 0:
            out.append(k)
            while n % k == 0:
                n //= k
        k += 1
    return [*out, n] if n > 1 else out


def find_runs(x: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs of the texts whose words' hashes stand in ``x``, in that order."""
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    found: set[tuple[int, int, int]] = set()  # (start, end, period)
    for lag in range(1, SHORT + 1):
        if len(x) > lag:
            first, end = _stretches((x[:-lag] == x[lag:]) & (text[:-lag] == text[lag:]))
            long = end - first + lag >= max(MIN_LENGTH, MIN_REPEATS * lag)
            found.update(zip(first[long].tolist(), (end[long] + lag).tolist(), [lag] * int(long.sum())))
    for places, distances in _seeds(x, offsets):
        reached: dict[tuple[int, int], int] = {}
        order = np.argsort(places, kind="stable")
        for at, lag in zip(places[order].tolist(), distances[order].tolist()):
            own = int(text[at])
            if reached.get((own, lag), -1) > at:
                continue  # within what was extended already
            first, end = _agreeing(x, at, lag, int(offsets[own]), int(offsets[own + 1]))
            reached[own, lag] = end
            if end - first + lag >= max(MIN_LENGTH, MIN_REPEATS * lag):
                found.add((first, end + lag, lag))
    out = []
    for start, end, period in found:
        shorter = (period // k for k in _primes_of(period))
        if not any(np.array_equal(x[start : start + period], x[start + d : start + d + period]) for d in shorter):
            own = int(text[start])
            out.append((own, start - int(offsets[own]), end - start, period))
    return sorted(out)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    Words are separated by ASCII white space. runs are (start, length, period) in words, by start, then period. collapsed
    are the words, joined by one space, without those that any run contains after its first period. Runs do not cross
    rows: repeated rows and ids get the same result each, and are passed on like NULL ids. NULL, empty and blank texts
    have no words, no runs and an empty collapsed text. Other columns are not read.
    """
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACED_WORDS, lower=False)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                hashes, edges, _, _ = hasher(data, offsets)
                n, whole = len(offsets) - 1, data.tobytes()
                runs: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
                words = [whole[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
                for text in sorted({own for own, *_ in find_runs(hashes, edges)}):
                    # the words themselves, numbered
                    numbers = {w: k for k, w in enumerate(dict.fromkeys(words[text]))}
                    x = mix(np.array([numbers[w] for w in words[text]], dtype=np.uint64))
                    runs[text] = [r for _, *r in find_runs(x, np.array([0, len(x)]))]
                shown = [b" ".join(collapse(w, r) if r else w).decode() for w, r in zip(words, runs)]
                rows = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
                columns = [batch.column(0).slice(first, n), pa.array(np.diff(edges).astype(np.int64)), pa.array(rows, kind)]
                yield pa.record_batch([*columns, pa.array(shown, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    out = f"doc_id {id_kind}, n_words bigint, runs {_RUNS}, collapsed string"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)
