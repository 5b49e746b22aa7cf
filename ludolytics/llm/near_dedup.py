"""Near-duplicate documents: one-permutation hashing, banded buckets and star-shaped candidate edges.

A text is lower-cased (A-Z), cut into words at ASCII white space and becomes the set of its distinct shingles of
five words (with fewer words: the whole sequence). The shingles' hashes fall into BINS bins by their leading bits and
each bin keeps its least hash; an empty bin borrows from a full bin that a fixed random sequence names (optimal
densification). ROWS bins make one of BANDS bucket keys. Two sets of similarity 0.75 miss all 32 buckets of four bins
with a chance of 5e-6, of 0.8 with 5e-8.

Documents of equal sets are one class. In each bucket the classes are compared with a centre only (a star; the centre
is the class that shares most buckets with others), on the full sets, and the links are contracted to components. What
a star leaves open is whether two of its members of different components are linked. Each member is described by the
shingles of its centre that it holds (a bitmap) and the number of its other shingles that a member of the star shares;
these bound the similarity of any two members closely. Only pairs that the bound does not rule out become rows, and are
decided on the full sets. So no link between two documents of a bucket is lost, and no group is expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import SPACED_WORDS, WordHasher, gram_hashes, mix, stored, text_slices

SHINGLE = 5
BINS = 128
ROWS = 4
BANDS = BINS // ROWS
#: Least similarity in hundredths.
THRESHOLD = 75

_PROBES = np.random.default_rng(7).integers(0, BINS, (BINS, 2048))
_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)


def shingle_sets(words: np.ndarray, word_offsets: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    grams = gram_hashes(words, size)
    for low, high in zip(word_offsets[:-1], word_offsets[1:]):
        if high - low >= size:
            yield np.unique(grams[low : high - size + 1])
        else:
            yield gram_hashes(words[low:high], high - low) if high > low else np.zeros(0, dtype=np.uint64)


def bucket_keys(shingles: np.ndarray) -> np.ndarray:
    """One key per band for a sorted, non-empty set of hashes."""
    edges = np.searchsorted(shingles, np.arange(BINS, dtype=np.uint64) << _BIN_SHIFT)
    full = np.append(edges[1:], len(shingles)) > edges
    source = np.arange(BINS)
    for tries in (16, _PROBES.shape[1]):
        empty = np.flatnonzero(~full[source])
        if len(empty):
            hit = full[_PROBES[empty, :tries]]
            source[empty] = np.where(hit.any(axis=1), _PROBES[empty, hit.argmax(axis=1)], empty)
    source = np.where(full[source], source, np.flatnonzero(full)[0])
    least = shingles[edges[source]].reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, j])
    return keys


_SKETCH = "doc_id {id}, n_shingles bigint, set_a bigint, set_b bigint, buckets array<bigint>"


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, 128-bit hash of the set, bucket keys); a text without words has no bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACED_WORDS)
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in text_slices(batch.column(1)):
                words, word_offsets, _, _ = hasher(data, offsets)
                n, a, b, keys = [], [], [], []
                for s in shingle_sets(words, word_offsets):
                    n.append(len(s))
                    a.append(mix(s).sum(dtype=np.uint64))
                    b.append(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                    keys.append(bucket_keys(s) if len(s) else s)
                sizes = np.cumsum([0, *map(len, keys)])
                flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
                yield pa.record_batch(
                    [
                        ids.slice(first, len(n)),
                        pa.array(n, pa.int64()),
                        pa.array(np.array(a, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(b, dtype=np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat.view(np.int64))),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "buckets"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, _SKETCH.format(id=kind))


def full_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rep, shingles): the whole shingle set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACED_WORDS)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                words, word_offsets, _, _ = hasher(data, offsets)
                sets = list(shingle_sets(words, word_offsets))
                sizes = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate(sets).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))
                yield pa.record_batch([batch.column(0).slice(first, len(sets)), lists], names=["rep", "shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"rep {kind}, shingles array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (u, v) rows: root is the least node that can be reached.

    Alternates the two star contractions (each node's neighbours are linked to the least of them) until nothing
    changes; every round is an aggregate and a join, written to the shared folder.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    pairs, before = stored(pairs, "links"), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        small = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) pairs with the full sets of both."""
    other = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("b_set"))
    centre = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("a_set"))
    return pairs.join(other, "b").join(centre, "a")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of each pair, decided on the full sets."""
    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - common
    return _with_sets(pairs, sets).select("a", "b", (100 * common >= THRESHOLD * union).alias("linked"))


def _against_centre(rows: DataFrame) -> DataFrame:
    """Adds to (a, b, comp, stray, b_set, a_set): size, bits (which of a's shingles b holds) and outside (its others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bits, outside = [], [], []
            for k in range(batch.num_rows):
                ours = batch.column("a_set")[k].values.to_numpy()
                theirs = batch.column("b_set")[k].values.to_numpy()
                packed = np.packbits(np.isin(ours, theirs))
                sizes.append(len(theirs))
                bits.append(np.pad(packed, (0, -len(packed) % 8)).view(np.int64))
                outside.append(np.setdiff1d(theirs, ours))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (bits, outside)]
            columns = [batch.column(k) for k in range(4)] + [pa.array(sizes, pa.int64()), *lists]
            yield pa.record_batch(columns, names=["a", "b", "comp", "stray", "size", "bits", "outside"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = f"a {kinds['a']}, b {kinds['b']}, comp {kinds['comp']}, stray boolean, size bigint"
    rows = rows.select("a", "b", "comp", "stray", "a_set", "b_set")
    return rows.mapInArrow(run, f"{out}, bits array<bigint>, outside array<bigint>")


def _open_pairs(stars: DataFrame, root: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): pairs of members of one star, in different components, that may be linked.

    Of two members at least one is a stray: outside the star's largest component.
    """
    names = root.select(F.col("node").alias("b"), "root")
    rows = stars.select("a", "b").join(names, "b", "left").select("a", "b", F.coalesce("root", "b").alias("comp"))
    parts = rows.groupBy("a", "comp").agg(F.count("*").alias("n"))
    largest = parts.groupBy("a").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count("*").alias("parts"))
    mixed = rows.join(largest.where("parts > 1"), "a")
    mixed = mixed.select("a", "b", "comp", (F.col("comp") != F.col("main")).alias("stray"))
    described = stored(_against_centre(_with_sets(mixed, sets)), "described")
    loose = described.select("a", "b", F.explode("outside").alias("shingle"))
    again = loose.groupBy("a", "shingle").agg(F.count("*").alias("n")).where("n > 1").select("a", "shingle")
    shared = loose.join(again, ["a", "shingle"]).groupBy("a", "b").agg(F.count("*").alias("extra"))
    rows = described.drop("outside").join(shared, ["a", "b"], "left").fillna(0, ["extra"])
    names = ["b", "comp", "stray", "size", "bits", "extra"]
    x = rows.where("stray").select("a", *(F.col(c).alias(f"x_{c}") for c in names))
    y = rows.select("a", *(F.col(c).alias(f"y_{c}") for c in names))
    common = """(aggregate(zip_with(x_bits, y_bits, (p, q) -> bit_count(p & q)), 0, (n, c) -> n + c)
                 + least(x_extra, y_extra))"""
    fits = f"""x_comp <> y_comp AND (NOT y_stray OR x_b < y_b)
        AND 100 * least(x_size, y_size) >= {THRESHOLD} * greatest(x_size, y_size)
        AND {100 + THRESHOLD} * {common} >= {THRESHOLD} * (x_size + y_size)"""
    return x.join(y, "a").where(fits).select(F.least("x_b", "y_b").alias("a"), F.greatest("x_b", "y_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    component_id is the least doc_id that links of similarity 0.75 or more reach; kept tells that it is the document's
    own. NULL, empty and wordless texts have no shingles and are linked with nothing. A row without a doc_id has no
    component and is kept. Rows that repeat a doc_id are one document: what any of its texts is linked with, it is
    linked with. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stored(sketches(source), "sketches")
    usable = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("n_shingles", "set_a", "set_b").agg(
        F.min("doc_id").alias("rep"), F.first("buckets").alias("buckets")
    )
    rows = classes.select("rep", F.explode("buckets").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(rows.join(shared, "key"), "members")
    weights = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    weighed = members.join(weights, "rep")
    heads = weighed.groupBy("key").agg(F.max(F.struct("weight", "rep"))["rep"].alias("a"))
    pairs = members.join(heads, "key").where("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    wanted = weights.select(F.col("rep").alias("doc_id"))
    sets = stored(full_sets(source.join(wanted, "doc_id", "left_semi")).dropDuplicates(["rep", "shingles"]), "sets")
    stars = stored(_compared(pairs, sets), "stars")
    links = stars.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
    further = _compared(_open_pairs(stars, components(links), sets), sets).where("linked")
    links = links.union(stored(further, "further").select("a", "b"))
    same = classes.select("n_shingles", "set_a", "set_b", "rep")
    copies = usable.join(same, ["n_shingles", "set_a", "set_b"]).where("doc_id <> rep")
    root = components(links.union(copies.select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))))
    out = sketch.join(root.select(F.col("node").alias("doc_id"), F.col("root").alias("component")), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
