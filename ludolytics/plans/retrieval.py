"""Vector and metadata search, profile and chunk embeddings, session preferences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolytics.functions.arrays import any_contains_text, any_of
from ludolytics.functions.text import Encoder, chunk_fixed, embed, explode_chunks
from ludolytics.functions.vectors import cosine_similarity, vector_literal
from ludolytics.operators.blocks import best_matches, best_similarity, meet, pack, similarity_rows
from ludolytics.operators.keyed import top_rows
from ludolytics.sources.writers import staged

# ---------------------------------------------------------------- embeddings


def profile_embeddings(games: DataFrame, size: int = 64, encoder: Encoder | None = None) -> DataFrame:
    """(game_id, embedding) from name, genres and categories."""
    text = F.concat_ws(" ", "game_name", "game_genres", "game_categories")
    return embed(games.select("game_id", text.alias("_text")), "_text", size=size, encoder=encoder).select(
        "game_id", "embedding"
    )


def chunk_embeddings(
    games: DataFrame,
    text: str = "game_detailed_description",
    key: str = "game_id",
    size: int = 256,
    overlap: int = 25,
    vector_size: int = 64,
    encoder: Encoder | None = None,
) -> DataFrame:
    """(game_id, chunk_id, chunk_text, embedding) of the overlapping text windows."""
    chunks = explode_chunks(games, key, chunk_fixed(text, size, overlap))
    return embed(chunks, "chunk_text", size=vector_size, encoder=encoder)


# ---------------------------------------------------------------- similarity


def similarity_matrix(left: DataFrame, right: DataFrame, id_col: str, vector: str, shards: int = 16) -> DataFrame:
    """Cosine similarity of every left to every right vector, as row strips:
    (id, other_ids, similarities), the two lists aligned. Computed block by block."""
    met = meet(pack(left, [id_col], vector), pack(right, [id_col], vector), shards=shards)
    return similarity_rows(met)


def chunk_set_similarity(
    chunks: DataFrame, pairs: DataFrame, game: str, chunk: str, vector: str, shards: int = 16
) -> DataFrame:
    """For each (left, right) game pair: mean over the left chunks of the highest
    similarity to any right chunk. Not symmetric.

    The highest similarity is taken per block pair first, so what is exchanged is
    one number per left chunk and right block.
    """
    left = pack(chunks, [chunk], vector, [game]).withColumnRenamed(game, "left_game")
    right = pack(chunks, [chunk], vector, [game]).withColumnRenamed(game, "right_game")
    wanted = pairs.select("left_game", "right_game").distinct()
    met = meet(left.join(wanted, "left_game"), right, ["right_game"], shards)
    per_chunk = (
        best_similarity(met, ["left_game", "right_game"])
        .groupBy("left_game", "right_game", chunk)
        .agg(F.max("similarity").alias("similarity"))
    )
    return per_chunk.groupBy("left_game", "right_game").agg(F.avg("similarity").alias("mean_max_similarity"))


def vectors_by_group(df: DataFrame, group: str, ids: Sequence[str], vector: str) -> DataFrame:
    """The vectors of each group as they are, packed into matrix blocks (several rows per group)."""
    return pack(df, ids, vector, [group], unit=False)


# ---------------------------------------------------------------- vector search


def semantic_search(
    profiles: DataFrame, query: Sequence[float], limit: int = 10, games: DataFrame | None = None
) -> DataFrame:
    """The ``limit`` profiles nearest to one vector: (game_id, similarity).

    With ``games`` the names are joined afterwards, and hits without a game row are
    dropped without being replaced.
    """
    sim = cosine_similarity(F.col("embedding"), vector_literal(query))
    hits = (
        profiles.select("game_id", sim.alias("similarity"))
        .orderBy(F.col("similarity").desc_nulls_last(), "game_id")
        .limit(limit)
    )
    return hits if games is None else _named(hits, games)


def _named(hits: DataFrame, games: DataFrame) -> DataFrame:
    return hits.join(games.select("game_id", "game_name"), "game_id")


def _nearest(found: DataFrame, query_id: str, limit: int) -> DataFrame:
    order = [F.col("similarity").desc_nulls_last(), F.col("game_id")]
    return top_rows(found, [query_id], order, limit, rank="rank")


def semantic_search_batch(
    profiles: DataFrame,
    queries: DataFrame,
    query_id: str = "query_id",
    vector: str = "embedding",
    limit: int = 10,
    games: DataFrame | None = None,
    shards: int = 16,
) -> DataFrame:
    """Exact nearest profiles of many queries: (query_id, game_id, similarity, rank)."""
    asked = pack(queries, [query_id], vector)
    met = meet(asked, pack(profiles, ["game_id"], "embedding"), shards=shards)
    hits = _nearest(best_matches(met, limit), query_id, limit)
    return hits if games is None else _named(hits, games)


class ListIndex:
    """Inverted-list approximate search: vectors are filed under their nearest
    centre, a query looks into the ``nprobe`` lists nearest to it and ranks what it
    finds exactly. Probing all lists gives the exact result."""

    def __init__(self, lists: int = 100, seed: int = 42):
        self.lists, self.seed = lists, seed
        self.model: KMeansModel | None = None

    @staticmethod
    def _unit(df: DataFrame, vector: str) -> DataFrame:
        as_vector = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
        return Normalizer(inputCol="_v", outputCol="_unit").transform(as_vector).drop("_v")

    def fit(self, profiles: DataFrame) -> ListIndex:
        means = KMeans(k=self.lists, seed=self.seed, featuresCol="_unit", predictionCol="list_id")
        self.model = means.fit(self._unit(profiles, "embedding"))
        return self

    def assign(self, profiles: DataFrame) -> DataFrame:
        """(game_id, embedding, list_id); the index table to store."""
        return self.model.transform(self._unit(profiles, "embedding")).drop("_unit")

    def _probes(self, queries: DataFrame, query_id: str, vector: str, nprobe: int) -> DataFrame:
        # as many centres as lists: a fixed, small number
        spark = queries.sparkSession
        centres = spark.createDataFrame(
            [(n, [float(x) for x in centre]) for n, centre in enumerate(self.model.clusterCenters())],
            T.StructType([T.StructField("list_id", T.IntegerType()), T.StructField("c", T.ArrayType(T.DoubleType()))]),
        )
        met = meet(pack(queries, [query_id], vector), pack(centres, ["list_id"], "c"), shards=1)
        near = best_matches(met, nprobe)
        order = [F.col("similarity").desc_nulls_last(), F.col("list_id")]
        return top_rows(near, [query_id], order, nprobe).select(query_id, "list_id")

    def search(
        self,
        index: DataFrame,
        queries: DataFrame,
        nprobe: int,
        limit: int = 10,
        query_id: str = "query_id",
        vector: str = "embedding",
        shards: int = 4,
    ) -> DataFrame:
        probes = self._probes(queries, query_id, vector, nprobe).join(queries, query_id)
        met = meet(
            pack(probes, [query_id], vector, ["list_id"]),
            pack(index, ["game_id"], "embedding", ["list_id"]),
            ["list_id"],
            shards,
        )
        return _nearest(best_matches(met, limit), query_id, limit)


    def store(self, profiles: DataFrame, path: str) -> StoredListIndex:
        """Write the index: vectors packed into blocks, a folder for each list, and the centres beside them.

        A large list is many blocks, written by many tasks; the blocks of a list are full but for the last of each task.
        """
        spark = profiles.sparkSession
        filed = self.assign(profiles).select("list_id", "game_id", "embedding").hint("rebalance", "list_id")
        blocks = pack(filed.sortWithinPartitions("list_id"), ["game_id"], "embedding", ["list_id"])
        blocks.write.mode("overwrite").partitionBy("list_id").parquet(f"{path}/blocks")
        centres = [(n, [float(x) for x in centre]) for n, centre in enumerate(self.model.clusterCenters())]
        spark.createDataFrame(centres, _CENTRES).coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
        return StoredListIndex(spark, path)


_CENTRES = T.StructType([T.StructField("list_id", T.IntegerType()), T.StructField("c", T.ArrayType(T.DoubleType()))])
#: Bytes of blocks that one task meets beyond the broadcast.
SHARD_BYTES = 64 << 20


class StoredListIndex:
    """A written list index. A search reads the folders of the probed lists only, and nothing is packed again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def probes(self, queries: DataFrame, nprobe: int, query_id: str = "query_id", vector: str = "embedding") -> DataFrame:
        """(query_id, list_id) of the ``nprobe`` lists whose centres are nearest to each query."""
        centres = self.spark.read.schema(_CENTRES).parquet(f"{self.path}/centres")
        near = best_matches(meet(pack(queries, [query_id], vector), pack(centres, ["list_id"], "c"), shards=1), nprobe)
        order = [F.col("similarity").desc_nulls_last(), F.col("list_id")]
        return top_rows(near, [query_id], order, nprobe).select(query_id, "list_id")

    def blocks(self, lists: Sequence[int] | None = None) -> DataFrame:
        """The packed vectors of some lists, or of all."""
        stored = self.spark.read.parquet(f"{self.path}/blocks")
        return stored if lists is None else stored.where(F.col("list_id").isin(list(lists)))

    def search(
        self, queries: DataFrame, nprobe: int, limit: int = 10, query_id: str = "query_id", vector: str = "embedding"
    ) -> DataFrame:
        """(query_id, game_id, similarity, rank): the nearest of what the probed lists hold, ranked exactly."""
        probed = staged(self.probes(queries, nprobe, query_id, vector))
        lists = sorted(r[0] for r in probed.select("list_id").distinct().collect())  # as many as there are centres
        blocks = self.blocks(lists)
        size = blocks.agg(F.sum(F.octet_length("matrix"))).first()[0] or 0
        asked = pack(probed.join(queries.select(query_id, vector), query_id).repartition("list_id"), [query_id], vector, ["list_id"])
        met = meet(asked, blocks, ["list_id"], max(1, -(-size // SHARD_BYTES)))
        return _nearest(best_matches(met, limit), query_id, limit)


# ---------------------------------------------------------------- metadata search


def metadata_search(
    games: DataFrame,
    genres: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    developers: Sequence[str] | None = None,
    publishers: Sequence[str] | None = None,
    release_date_after: str | date | datetime | None = None,
    release_date_before: str | date | datetime | None = None,
    review_score_min: int | None = None,
    review_score_description: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """(game_id, game_name, game_review_score) of the best scored matching games.

    Empty criteria are ignored; a minimum score of 0 counts as empty. Ties of the
    score go by id.
    """
    found = games.where(
        F.col("game_review_score").isNotNull() & F.col("game_review_score_description").isNotNull()
    )
    for column, wanted in (("game_genres", genres), ("game_categories", categories)):
        if wanted:
            found = found.where(any_of(column, wanted))
    for column, parts in (("game_developers", developers), ("game_publishers", publishers)):
        if parts:
            found = found.where(any_contains_text(column, parts))
    day = F.col("game_prerelease_date")
    if release_date_after:
        found = found.where(day >= F.lit(release_date_after).cast("timestamp"))
    if release_date_before:
        found = found.where(day <= F.lit(release_date_before).cast("timestamp"))
    if review_score_min:
        found = found.where(F.col("game_review_score") >= review_score_min)
    if review_score_description:
        found = found.where(F.col("game_review_score_description") == review_score_description)
    return (
        found.select("game_id", "game_name", "game_review_score")
        .orderBy(F.col("game_review_score").desc(), "game_id")
        .limit(limit)
    )


# ---------------------------------------------------------------- session preferences

# fixed values: what a session can ask for
PREFERENCE_KEYS = [
    "genres",
    "categories",
    "developers",
    "publishers",
    "release_date_after",
    "release_date_before",
    "review_score_min",
    "review_score_description",
    "status",
]


def fold_preferences(turns: DataFrame) -> DataFrame:
    """(session_id, preferences, status): the latest value per key of each session.

    Takes (session_id, turn, key, value); of two values of one turn the larger counts, and NULL least. A key sent with
    NULL clears the value; other keys are ignored. A session that never sent a status, or nothing but other keys, is
    GATHERING.
    """
    known = turns.withColumn("key", F.when(F.col("key").isin(PREFERENCE_KEYS), F.col("key")))
    order = F.struct("turn", F.col("value").isNotNull(), "value")
    latest = known.groupBy("session_id", "key").agg(F.max_by("value", order).alias("value"))
    entry = F.when(F.col("key").isNotNull(), F.struct("key", "value"))
    folded = latest.groupBy("session_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("preferences")
    )
    status = F.try_element_at("preferences", F.lit("status"))
    return folded.withColumn("status", F.coalesce(status, F.lit("GATHERING")))


def ready_sessions(folded: DataFrame) -> DataFrame:
    return folded.where(F.col("status") == "READY")
