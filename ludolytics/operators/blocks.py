"""Vector work on blocks of rows: matrix products instead of row pairs.

``pack`` turns vectors into matrix blocks inside the tasks that read them, without
a shuffle; ``meet`` brings every left block of a group together with every right
block of the group; the kernels multiply two blocks and keep only what the caller
asks for. A hot group is many blocks, spread over shards, never one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 256


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row becomes NaN (no direction)."""
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(norms > 0, matrix / norms, np.nan)


def pack(
    df: DataFrame,
    ids: Sequence[str],
    vector: str,
    group: Sequence[str] = (),
    rows: int = BLOCK_ROWS,
    unit: bool = True,
) -> DataFrame:
    """Blocks of at most ``rows`` vectors: group columns, ``ids``, ``matrix``.

    The vectors are scaled to length one, or stored as they are without ``unit``.
    ``ids`` holds one struct per row, ``matrix`` the vectors row by row as float64
    bytes. Rows whose vector is NULL are left out.
    """
    ids, group = list(ids), list(group)
    kinds = {f.name: f.dataType for f in df.schema}
    schema = T.StructType(
        [T.StructField(g, kinds[g]) for g in group]
        + [
            T.StructField("ids", T.ArrayType(T.StructType([T.StructField(c, kinds[c]) for c in ids]))),
            T.StructField("matrix", T.BinaryType()),
        ]
    )

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = frame.groupby(group, dropna=False, sort=False) if group else [((), frame)]
            out = []
            for key, part in parts:
                for start in range(0, len(part), rows):
                    piece = part.iloc[start : start + rows]
                    matrix = np.stack(piece["_vec"].to_numpy()).astype(np.float64)
                    matrix = _unit_rows(matrix) if unit else matrix
                    out.append([*key, piece["_id"].tolist(), matrix.tobytes()])
            yield pd.DataFrame(out, columns=schema.names)

    narrow = df.where(F.col(vector).isNotNull()).select(
        *group, F.struct(*ids).alias("_id"), F.col(vector).alias("_vec")
    )
    return narrow.mapInPandas(blocks, schema)


def unpack(blocks: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows of blocks again: group columns, id columns and the vector (array<double>)."""
    group = [f for f in blocks.schema if f.name not in ("ids", "matrix")]
    ids = blocks.schema["ids"].dataType.elementType.fields
    schema = T.StructType([*group, *ids, T.StructField(vector, T.ArrayType(T.DoubleType()))])

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                matrix = np.frombuffer(row.matrix).reshape(len(row.ids), -1)
                own = [getattr(row, f.name) for f in group]
                lines = [[*own, *(i[f.name] for f in ids), v.tolist()] for i, v in zip(row.ids, matrix)]
                yield pd.DataFrame(lines, columns=schema.names)

    return blocks.mapInPandas(rows, schema)


def meet(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = (),
    shards: int = 16,
    broadcast_bytes: int = 32 * 1024 * 1024,
) -> DataFrame:
    """Every left block with every right block of the same ``on`` group.

    The left side is measured first. Up to ``broadcast_bytes`` it is broadcast and
    the right blocks stay where they were packed. Beyond that the right blocks are
    dealt out over ``shards`` and the left blocks copied to each of them, so that
    the group of a hot key is worked on by ``shards`` tasks.
    """
    on = list(on)
    measured = left.agg(F.sum(F.octet_length("matrix"))).first()[0] or 0
    small = measured <= broadcast_bytes
    shards = 1 if small else shards
    dealt = right.select(
        *on,
        F.pmod(F.xxhash64("ids", "matrix"), F.lit(shards)).cast("int").alias("_shard"),
        F.col("ids").alias("right_ids"),
        F.col("matrix").alias("right_matrix"),
    )
    copied = left.select(
        *on,
        *[c for c in left.columns if c not in (*on, "ids", "matrix")],
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"),
        F.col("ids").alias("left_ids"),
        F.col("matrix").alias("left_matrix"),
    )
    return dealt.join(F.broadcast(copied) if small else copied, [*on, "_shard"])


def _matrices(row) -> tuple[np.ndarray, np.ndarray]:
    left = np.frombuffer(row.left_matrix).reshape(len(row.left_ids), -1)
    right = np.frombuffer(row.right_matrix).reshape(len(row.right_ids), -1)
    return left, right


def _id_fields(df: DataFrame, side: str) -> list[T.StructField]:
    return df.schema[f"{side}_ids"].dataType.elementType.fields


def similarity_rows(met: DataFrame) -> DataFrame:
    """Dense similarity matrix in row strips: each left row with one block of
    right ids and the cosine similarities to them, aligned by position."""
    left_fields, right_field = _id_fields(met, "left"), _id_fields(met, "right")[0]
    schema = T.StructType(
        [
            *left_fields,
            T.StructField("other_ids", T.ArrayType(right_field.dataType)),
            T.StructField("similarities", T.ArrayType(T.DoubleType())),
        ]
    )

    def kernel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, right = _matrices(row)
                sims = left @ right.T
                others = [i[right_field.name] for i in row.right_ids]
                yield pd.DataFrame(
                    [
                        [*[i[f.name] for f in left_fields], others, line.tolist()]
                        for i, line in zip(row.left_ids, sims)
                    ],
                    columns=schema.names,
                )

    return met.mapInPandas(kernel, schema)


def best_matches(met: DataFrame, k: int, keep: Sequence[str] = ()) -> DataFrame:
    """For each left row the ``k`` most similar right rows among the block pairs of a task.

    ``keep`` names left columns to pass on. A task holds the best rows found so far and emits them once, so at most
    ``k`` rows per left row leave it, however many right blocks it meets. Take the top ``k`` over all rows of a left row
    to finish; ties go by the first right id. A vector without direction yields a NULL similarity.
    """
    keep = list(keep)
    kept_fields = [met.schema[c] for c in keep]
    left_fields, right_fields = _id_fields(met, "left"), _id_fields(met, "right")
    schema = T.StructType(
        [*kept_fields, *left_fields, *right_fields, T.StructField("similarity", T.DoubleType())]
    )
    names = [f.name for f in right_fields]
    numbers = len(names) == 1 and isinstance(right_fields[0].dataType, (T.LongType, T.IntegerType))

    def kernel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # per left block: what to emit with each row, then the costs (-similarity) and right ids of its best, as matrices:
        # a task may hold the best of very many left rows
        found: dict = {}
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, right = _matrices(row)
                sims = left @ right.T
                cost = np.where(np.isnan(sims), np.inf, -sims)
                kept = [getattr(row, c) for c in keep]
                owners = [(*kept, *(i[f.name] for f in left_fields)) for i in row.left_ids]
                block = (repr(owners[0]), repr(owners[-1]), hashlib.blake2b(row.left_matrix).digest())
                ids = [i[names[0]] if numbers else tuple(i[c] for c in names) for i in row.right_ids]
                if block not in found:
                    kind = np.int64 if numbers else object
                    shape = (len(owners), k)
                    found[block] = [owners, np.full(shape, np.inf), np.zeros(shape, dtype=kind), np.zeros(len(owners), dtype=np.int32)]
                _, costs, best, held = found[block]
                if numbers and None in ids and best.dtype != object:
                    best = found[block][2] = best.astype(object)
                # an equal one may still win by its id
                last = min(k, cost.shape[1]) - 1
                limit = np.minimum(np.where(held == k, costs[:, -1], np.inf), np.partition(cost, last, axis=1)[:, last])
                for n in np.flatnonzero((cost <= limit[:, None]).any(axis=1)):
                    entries = [*zip(costs[n, : held[n]], best[n, : held[n]]), *((cost[n, j], ids[j]) for j in np.flatnonzero(cost[n] <= limit[n]))]
                    entries = sorted(entries, key=lambda t: (t[0], t[1] if numbers else t[1][0]))[:k]
                    held[n] = len(entries)
                    for place, (c, i) in enumerate(entries):
                        costs[n, place], best[n, place] = c, i
        for owners, costs, best, held in found.values():
            rows = [
                [*owner, *([best[n, j]] if numbers else best[n, j]), None if np.isinf(costs[n, j]) else float(-costs[n, j])]
                for n, owner in enumerate(owners)
                for j in range(held[n])
            ]
            if rows:
                yield pd.DataFrame(rows, columns=schema.names)

    return met.mapInPandas(kernel, schema)


def best_similarity(met: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The largest similarity of each left row within one block pair."""
    keep = list(keep)
    left_fields = _id_fields(met, "left")
    schema = T.StructType(
        [*[met.schema[c] for c in keep], *left_fields, T.StructField("similarity", T.DoubleType())]
    )

    def kernel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, right = _matrices(row)
                sims = left @ right.T
                best = np.where(np.isnan(sims), -np.inf, sims).max(axis=1)
                yield pd.DataFrame(
                    [
                        [
                            *[getattr(row, c) for c in keep],
                            *[i[f.name] for f in left_fields],
                            None if np.isinf(value) else float(value),
                        ]
                        for i, value in zip(row.left_ids, best)
                    ],
                    columns=schema.names,
                )

    return met.mapInPandas(kernel, schema)
