"""Toxic texts by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. Toxic texts are ordinary text but for a
few words, so both dictionaries share a base trained on ordinary windows; after it each holds the segments that texts of
its own class hold more often than other texts of the same kind, by a significance test over grams of several lengths.
Kinds are clusters of the texts by their letter triples, which mostly are languages; nothing but the text decides them. A window that compresses to fewer bytes with the toxic dictionary than with the ordinary one speaks for
toxicity. Every window of a text is compared; a calibrated threshold on what the windows give (a logistic function fitted
to texts that the dictionaries have not seen) makes the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import MULTIPLIER, mix

#: Expected number of labelled texts of each class that the model is fitted on, drawn by a hash of their ids, and the
#: length over which a text is not drawn. Together they bound what comes to the driver.
SAMPLE_DOCS = 2_500
SAMPLE_CHARS = 60_000
#: Bytes of the shared base and of each class's own segments.
BASE_BYTES = 32_768
OWN_BYTES = 8_192
#: Kinds of texts, the buckets of their letter triples, the bytes of a text that count, and the ordinary texts and
#: rounds of clustering.
KINDS = 12
KIND_BUCKETS = 1_024
KIND_TEXTS = 1_000
KIND_BYTES = 20_000
KIND_ROUNDS = 15
#: Lengths in bytes of the grams that segments are made of.
GRAMS = (4, 5, 6, 8, 10, 12)
#: A gram of a class is this many times as frequent there as in the other at least.
LEAST_RATIO = 8.0
#: Chance that any gram at all gets into a dictionary by accident.
ACCIDENT = 0.05
#: One text of so many fits the score; the dictionaries are trained on the others.
HELD_OUT = 3
#: Bytes of text whose grams are counted at once, and hashed at once.
COUNT_BYTES = 1 << 22
HASH_BYTES = 1 << 18
#: Bytes of a window, and by how many two windows overlap.
WINDOW = 64
OVERLAP = 16
LEVEL = 3


#: Bytes that a window saves, counted one by one.
STEPS = np.arange(1, 7)
N_FEATURES = 3 + 2 * len(STEPS)


def _plain(text: str | None) -> bytes:
    """Lower case, words with one space around."""
    words = (text or "").lower().split()
    return (" " + " ".join(words) + " ").encode() if words else b""


def _gram_hashes(data: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash of 40 bits) of the grams of whole characters inside one word, with its spaces, of one text."""
    n = max(0, len(data) - size + 1)
    hashes = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        hashes = hashes * np.uint64(MULTIPLIER) + data[j : j + n]
    spaces = np.cumsum(data == 32)
    inside = (doc[:n] == doc[size - 1 :]) & (spaces[size - 2 : size - 2 + n] == spaces[:n])
    first, following = data[:n], np.append(data[size:], 32)[:n]
    inside &= (first & 0xC0 != 0x80) & (following & 0xC0 != 0x80)
    places = np.flatnonzero(inside)
    return places, mix(hashes[places]) >> np.uint64(24)


def _slices(texts: list[bytes], limit: int = HASH_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, text number of each byte) of runs of texts."""
    first = 0
    while first < len(texts):
        last, size = first + 1, len(texts[first])
        while last < len(texts) and size + len(texts[last]) <= limit:
            size, last = size + len(texts[last]), last + 1
        data = np.frombuffer(b"".join(texts[first:last]), dtype=np.uint8)
        yield data, np.repeat(np.arange(first, last), [len(t) for t in texts[first:last]])
        first = last


def _kinds(texts: list[bytes], ordinary: int) -> np.ndarray:
    """A cluster for each text: spherical means of the square roots of its triples' shares.

    The means are those of some of the first ``ordinary`` texts, so that no cluster forms around toxic words. The first centre is
    the first text, each further one the text least like those before, so equal input gives equal clusters.
    """
    shares = np.zeros((len(texts), KIND_BUCKETS), dtype=np.float32)
    for row, text in zip(shares, texts):
        data = np.frombuffer(text[:KIND_BYTES], dtype=np.uint8).astype(np.int64)
        if len(data) > 2:
            row += np.bincount((data[:-2] * 961 + data[1:-1] * 31 + data[2:]) % KIND_BUCKETS, minlength=KIND_BUCKETS)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    np.sqrt(shares, out=shares)
    shares /= np.maximum(np.sqrt(np.einsum("ij,ij->i", shares, shares)), 1e-9)[:, None]
    known = shares[: ordinary : max(1, -(-ordinary // KIND_TEXTS))]
    centres = known[:1]
    while 0 < len(centres) < min(KINDS, len(known)):
        centres = np.vstack([centres, known[[(known @ centres.T).max(axis=1).argmin()]]])
    if not len(centres):
        return np.zeros(len(texts), dtype=np.int64)
    for _ in range(KIND_ROUNDS):
        nearest = (known @ centres.T).argmax(axis=1)
        sums = [known[nearest == k].sum(axis=0) if (nearest == k).any() else c for k, c in enumerate(centres)]
        centres = unit(np.array(sums))
    return (shares @ centres.T).argmax(axis=1)


def _typical(counts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihood ratio, log ratio of rates) of grams for class 1, negative ones for class 0.

    ``counts`` (gram, kind, class) tells how many texts hold a gram, ``sizes`` (kind, class) how many there are. The
    texts of class 1 that would hold it by accident are counted kind by kind.
    """
    both = counts.sum(2)
    expected = (both * (sizes[:, 1] / np.maximum(sizes.sum(1), 1))).sum(1)
    rest = both.sum(1) - expected
    seen, other = counts[:, :, 1].sum(1), counts[:, :, 0].sum(1)
    expected, rest = np.maximum(expected, 1e-9), np.maximum(rest, 1e-9)
    gain = 2 * (seen * np.log(np.maximum(seen, 1e-9) / expected) + other * np.log(np.maximum(other, 1e-9) / rest))
    ratio = np.log((seen + 0.5) / (expected + 0.5)) - np.log((other + 0.5) / (rest + 0.5))
    return np.sign(ratio) * gain, ratio


def _segments(texts: list[bytes], kinds: np.ndarray, labels: np.ndarray) -> tuple[bytes, bytes]:
    """Segments of (ordinary, toxic) text, the most typical last."""
    numbers = np.unique(kinds, return_inverse=True)[1]
    n_cells = 2 * int(numbers.max()) + 2
    cell = 2 * numbers + labels
    sizes = np.bincount(cell, minlength=n_cells).reshape(-1, 2)
    parts = sum(map(len, texts)) // COUNT_BYTES + 1
    found: list[tuple[float, bytes]] = []
    tested = 0
    for size in GRAMS:
        for part in range(parts):
            held = [np.zeros(0, dtype=np.uint64)]
            for data, doc in _slices(texts):
                places, hashes = _gram_hashes(data, doc, size)
                mine = hashes % np.uint64(parts) == part
                held.append(np.unique((hashes[mine] << np.uint64(24)) | doc[places[mine]].astype(np.uint64)))
            keys = np.concatenate(held)  # a text is in one slice only, so none repeats
            keys.sort()
            grams, amounts = np.unique(keys >> np.uint64(24), return_counts=True)
            tested += len(grams)
            often = amounts > 2  # fewer texts are no evidence at any rate
            number = np.repeat(np.arange(often.sum()), amounts[often])
            docs = (keys[np.repeat(often, amounts)] & np.uint64(0xFFFFFF)).astype(np.int64)
            counts = np.bincount(number * n_cells + cell[docs], minlength=often.sum() * n_cells)
            gain, ratio = _typical(counts.reshape(-1, *sizes.shape), sizes)
            good = (np.abs(gain) > 2 * math.log(max(tested, 1) / ACCIDENT)) & (np.abs(ratio) > math.log(LEAST_RATIO))
            left = dict(zip(grams[often][good].tolist(), gain[good].tolist()))
            for data, doc in _slices(texts):
                if not left:
                    break
                places, hashes = _gram_hashes(data, doc, size)
                for k in np.flatnonzero(np.isin(hashes, np.array(list(left), dtype=np.uint64))):
                    if (weight := left.pop(int(hashes[k]), None)) is not None:
                        found.append((weight, data[places[k] : places[k] + size].tobytes()))
    least = 2 * math.log(max(tested, 1) / ACCIDENT)

    def joined(sign: int) -> bytes:
        out = b""
        for _, _, gram in sorted((-sign * weight, -len(gram), gram) for weight, gram in found if sign * weight > least):
            if gram not in out and len(out) + len(gram) <= OWN_BYTES:
                out = gram + out
        return out

    return joined(-1), joined(1)


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def compressors(self):
        """Functions that give the compressed size of a window with each dictionary."""
        import zstandard

        sizes = []
        for content in (self.ordinary, self.toxic):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            sizes.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, **plain).compress)
        return sizes


def features(text: str | None, ordinary, toxic) -> list[float]:
    """What the windows of a text say: constant, most bytes saved, how many and which share save 1, 2, … bytes, their number."""
    data = _plain(text)
    windows = [data[i : i + WINDOW] for i in range(0, max(1, len(data) - OVERLAP), WINDOW - OVERLAP)]
    saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows])
    over = (saved[:, None] >= STEPS).sum(0)
    return [1.0, float(min(max(saved.max(), 0), 8)), math.log(len(windows)), *np.log1p(over), *np.sqrt(over / len(windows))]


def _logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic function by Newton steps."""
    weights = np.zeros(rows.shape[1])
    penalty = np.full(rows.shape[1], ridge)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - labels) + penalty * weights
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _base(texts: list[bytes]) -> bytes:
    import zstandard

    windows = [t[i : i + 512] for t in texts for i in range(0, len(t), 512)]
    try:
        return zstandard.train_dictionary(BASE_BYTES, windows, k=48, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return b"".join(texts)[:BASE_BYTES]


def train(toxic: list[str], ordinary: list[str], rate: float) -> Model:
    """Fit dictionaries to two thirds of the texts and the score to the rest; ``rate`` is the share of toxic texts."""
    rows = [sorted(map(_plain, part)) for part in (ordinary, toxic)]
    learnt = [[row for k, row in enumerate(part) if k % HELD_OUT != 1] for part in rows]
    seen = [part[1::HELD_OUT] or part for part in rows]
    texts = [text for part in learnt for text in part]
    other, own = _segments(texts, _kinds(texts, len(learnt[0])), np.repeat([0, 1], [len(part) for part in learnt]))
    base, size = _base(learnt[0]), max(len(own), len(other))
    # the base stands at the same distance from the window in both; what comes last hides nothing that matches as well
    model = Model(base + other.rjust(size), base + own.rjust(size), [])
    pair = model.compressors()
    labels = np.repeat([0.0, 1.0], [len(part) for part in seen])
    weights = _logistic(np.array([features(text.decode(), *pair) for part in seen for text in part]), labels)
    # the sample has both classes alike; the table has ``rate`` toxic texts
    drawn = (len(seen[1]) + 0.5) / (len(labels) + 1)
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    weights[0] += math.log(rate / (1 - rate)) - math.log(drawn / (1 - drawn))
    model.weights = weights.tolist()
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learn from the rows of ``docs`` that ``labels`` (same id, 0 or 1) marks.

    About SAMPLE_DOCS labelled ids of each class are drawn by a hash; only these ids are sent to the scan of the
    documents. Rows with a NULL id, label or text are left out; an id with both labels is toxic, and of rows that share an id
    each counts. Without any labelled text every score is 0.5, with one class alone all are of it.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    counts = dict(known.groupBy("label").count().collect())  # two rows
    if not counts:
        return Model(b"", b"", [0.0] * N_FEATURES)
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    share = F.lit(0).cast("bigint")
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1 << 40, (SAMPLE_DOCS << 40) // n))).otherwise(share)
    drawn = F.broadcast(known.where(place < share))  # about 2 * SAMPLE_DOCS rows, see above
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.where(F.length("text") <= SAMPLE_CHARS).join(drawn, "id").select("label", "text").collect()
    texts = {k: [r["text"] for r in rows if r["label"] == k] for k in (0, 1)}
    if not texts[0] or not texts[1]:
        return Model(b"", b"", [4.0 if texts[1] else -4.0] + [0.0] * (N_FEATURES - 1))
    return train(texts[1], texts[0], counts.get(1, 0) / sum(counts.values()))


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, score, predicted), one row per row: 1 if the score of the whole text is 0.5 or more.

    NULL and empty texts are one empty window and get the score of a text without any sign of toxicity. NULL and
    repeated ids are passed on. ``keep`` names columns that follow as they are; others are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, weights = model.compressors(), np.array(model.weights)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows = np.array([features(text, *pair) for text in part.column(1).to_pylist()])
                scores = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
                columns = [part.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
                columns += part.columns[2:]
                yield pa.record_batch(columns, names=["doc_id", "score", "predicted", *names])

    names = [f"kept_{k}" for k in range(len(keep))]
    kinds = [docs.schema[c].dataType.simpleString() for c in keep]
    out = f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double, predicted int"
    out = ", ".join([out, *(f"{name} {kind}" for name, kind in zip(names, kinds))])
    rows = docs.select(F.col(id_col), F.col(text_col), *(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)))
    found = rows.mapInArrow(run, out)
    return found.select("doc_id", "score", "predicted", *(F.col(n).alias(c) for c, n in zip(keep, names)))
