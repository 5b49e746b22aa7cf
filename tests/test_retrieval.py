from datetime import datetime

import numpy as np
import pytest
from helpers import plan, rows
from ludolytics.session import scratch_path
from pyspark.sql import functions as F

from ludolytics.functions.vectors import cosine_similarity
from ludolytics.operators import blocks
from ludolytics.plans import retrieval as r

RNG = np.random.default_rng(11)
VECTORS = RNG.normal(size=(700, 8))
VECTORS[5] = 0
VECTORS[100:300] = VECTORS[100]  # many copies of one vector


@pytest.fixture(scope="module")
def profiles(spark):
    data = [(i, [float(x) for x in v]) for i, v in enumerate(VECTORS)]
    return spark.createDataFrame(data, "game_id long, embedding array<float>").repartition(5)


@pytest.fixture(scope="module")
def queries(spark):
    data = [(i, [float(x) for x in v]) for i, v in enumerate(RNG.normal(size=(6, 8)))]
    return spark.createDataFrame(data, "query_id int, embedding array<float>")


def unit(m):
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.where(n > 0, m / np.where(n > 0, n, 1), np.nan)


def brute(queries, limit):
    out = []
    for q in queries.collect():
        sims = unit(VECTORS.astype(np.float32).astype(float)) @ unit(np.array([q.embedding]))[0]
        ranked = sorted(range(len(sims)), key=lambda i: (np.inf if np.isnan(sims[i]) else -round(sims[i], 12), i))
        out += [(q.query_id, i) for i in ranked[:limit]]
    return sorted(out)


@pytest.mark.parametrize("limit", [1, 10, 250])
def test_batch_search_equals_brute_force(spark, profiles, queries, limit):
    hits = r.semantic_search_batch(profiles, queries, limit=limit)
    found = hits.withColumn("s", F.round("similarity", 9))
    assert sorted((h.query_id, h.game_id) for h in found.collect()) == brute(queries, limit)
    assert {h["rank"] for h in found.collect()} == set(range(1, limit + 1))


def test_large_query_sets_are_sharded_instead_of_broadcast(spark, profiles, queries):
    asked = blocks.pack(queries, ["query_id"], "embedding")
    packed = blocks.pack(profiles, ["game_id"], "embedding")
    small, large = blocks.meet(asked, packed), blocks.meet(asked, packed, shards=5, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan(small)
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    for met in (small, large):
        best = blocks.best_matches(met, 3)
        top = r._nearest(best, "query_id", 3)
        assert sorted((h.query_id, h.game_id) for h in top.collect()) == brute(queries, 3)


def test_single_search_and_name_join(spark, profiles, queries):
    q = queries.where("query_id = 2").collect()[0].embedding
    one = r.semantic_search(profiles, q, 10)
    assert sorted((2, h.game_id) for h in one.collect()) == [x for x in brute(queries, 10) if x[0] == 2]
    games = spark.createDataFrame([(one.collect()[0].game_id, "best")], "game_id long, game_name string")
    assert rows(r.semantic_search(profiles, q, 10, games), "game_name") == [("best",)]


def test_zero_vectors_have_no_similarity(spark, profiles):
    hits = r.semantic_search(profiles, [1.0] * 8, 700)
    last = hits.where("similarity IS NULL").collect()
    assert [h.game_id for h in last] == [5]
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [x[0] for x in df.select(cosine_similarity(F.col("a"), F.col("b"))).collect()] == [1.0, None]


def test_all_probes_equal_exact_search(spark, profiles, queries):
    index = r.ListIndex(lists=7, seed=1).fit(profiles)
    table = index.assign(profiles)
    full = index.search(table, queries, nprobe=7)
    assert rows(full, "query_id", "game_id", "rank") == rows(
        r.semantic_search_batch(profiles, queries), "query_id", "game_id", "rank"
    )
    part = index.search(table, queries, nprobe=2, limit=5)
    lists = {x.game_id: x.list_id for x in table.collect()}
    for q in range(6):
        assert len({lists[h.game_id] for h in part.where(F.col("query_id") == q).collect()}) <= 2


def test_a_stored_index_reads_the_probed_lists_only(spark, profiles, queries):
    index = r.ListIndex(lists=7, seed=1).fit(profiles)
    stored = index.store(profiles, scratch_path(spark, "index"))
    exact = rows(r.semantic_search_batch(profiles, queries), "query_id", "game_id", "rank")
    assert rows(stored.search(queries, nprobe=7), "query_id", "game_id", "rank") == exact
    one = queries.where("query_id = 0")
    lists = [x.list_id for x in stored.probes(one, 2).collect()]
    read = stored.blocks(lists)
    files = [f[0] for f in read.select(F.input_file_name()).distinct().collect()]
    assert len(lists) == 2 and {f.split("list_id=")[1].split("/")[0] for f in files} == {str(n) for n in lists}
    assert "PartitionFilters: [list_id" in plan(read)
    filed = {x.game_id: x.list_id for x in index.assign(profiles).collect()}
    hits = stored.search(one, nprobe=2, limit=5).collect()
    assert len(hits) == 5 and {filed[h.game_id] for h in hits} <= set(lists)
    assert rows(stored.search(queries, nprobe=3), "query_id", "game_id") == rows(
        index.search(index.assign(profiles), queries, nprobe=3), "query_id", "game_id"
    )
    assert stored.search(queries.where("false"), nprobe=2).collect() == []


def test_similarity_matrix_has_every_cell(spark, profiles):
    ids = profiles.withColumnRenamed("game_id", "id")
    strips = r.similarity_matrix(ids, ids, "id", "embedding", shards=3)
    cells = {}
    for row in strips.collect():
        for other, s in zip(row.other_ids, row.similarities):
            assert (row.id, other) not in cells
            cells[row.id, other] = s
    assert len(cells) == 700 * 700
    u = unit(VECTORS.astype(np.float32).astype(float))
    want = u @ u.T
    assert np.allclose([cells[i, j] for i in (0, 150, 699) for j in range(0, 700, 50)],
                       [want[i, j] for i in (0, 150, 699) for j in range(0, 700, 50)])


def test_chunk_sets(spark):
    data = [("a", i, [float(x) for x in v]) for i, v in enumerate(RNG.normal(size=(600, 4)))]
    data += [("b", i, [float(x) for x in v]) for i, v in enumerate(RNG.normal(size=(300, 4)))]
    data += [("c", 0, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "game string, chunk int, v array<double>")
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("c", "zz")], "left_game string, right_game string")
    got = {(x.left_game, x.right_game): x.mean_max_similarity for x in
           r.chunk_set_similarity(df, pairs, "game", "chunk", "v", shards=3).collect()}
    sets = {g: unit(np.array([v for n, _, v in data if n == g])) for g in "abc"}
    assert set(got) == {("a", "b"), ("b", "a"), ("c", "c")}
    for (x, y), value in got.items():
        assert value == pytest.approx((sets[x] @ sets[y].T).max(axis=1).mean())


def test_blocks_stay_small_for_a_hot_group(spark, profiles):
    packed = blocks.pack(profiles.withColumn("g", F.lit("hot")), ["game_id"], "embedding", ["g"], rows=64)
    sizes = [len(x.ids) for x in packed.collect()]
    assert max(sizes) <= 64 and sum(sizes) == 700


GAMES = (
    "game_id long, game_name string, game_genres array<string>, game_categories array<string>, "
    "game_developers array<string>, game_publishers array<string>, game_prerelease_date timestamp, "
    "game_review_score long, game_review_score_description string"
)


@pytest.fixture(scope="module")
def games(spark):
    at = lambda y: datetime(y, 1, 1)
    return spark.createDataFrame(
        [
            (1, "a", ["RPG"], ["Co-op"], ["Big Studio"], ["P"], at(2010), 9, "Very Positive"),
            (2, "b", ["RPG", "Indie"], [], ["small"], ["Q"], at(2015), 7, "Mixed"),
            (3, "c", ["Action"], ["Co-op"], [], ["BIG pub"], at(2020), 9, "Very Positive"),
            (4, "d", ["RPG"], ["Co-op"], ["x"], ["P"], at(2012), None, "Mixed"),
            (5, "e", ["RPG"], ["Co-op"], ["x"], ["P"], at(2012), 8, None),
            (6, "f", None, None, None, None, None, 0, "Mixed"),
        ],
        GAMES,
    )


@pytest.mark.parametrize(
    "criteria,want",
    [
        ({}, [1, 3, 2, 6]),
        ({"genres": ["Indie", "Action"]}, [3, 2]),
        ({"categories": ["Co-op"]}, [1, 3]),
        ({"developers": ["STUDIO", "mall"]}, [1, 2]),
        ({"publishers": ["big"]}, [3]),
        ({"release_date_after": "2015-01-01"}, [3, 2]),
        ({"release_date_before": "2015-01-01"}, [1, 2]),
        ({"review_score_min": 8}, [1, 3]),
        ({"review_score_min": 0}, [1, 3, 2, 6]),
        ({"review_score_description": "Mixed"}, [2, 6]),
        ({"genres": [], "limit": 2}, [1, 3]),
        ({"genres": ["RPG"], "review_score_min": 8}, [1]),
    ],
)
def test_metadata_search(games, criteria, want):
    assert [x.game_id for x in r.metadata_search(games, **criteria).collect()] == want


def test_metadata_filters_reach_the_scan(spark, games, tmp_path):
    games.write.parquet(str(tmp_path / "g"))
    found = r.metadata_search(spark.read.parquet(str(tmp_path / "g")), review_score_min=8)
    assert "GreaterThanOrEqual(game_review_score,8)" in plan(found) and "TakeOrderedAndProject" in plan(found)


def test_preferences_fold_to_the_latest_value(spark):
    turns = spark.createDataFrame(
        [
            ("s", 1, "genres", "RPG"), ("s", 2, "genres", "Indie"), ("s", 3, "developers", "x"),
            ("s", 4, "developers", None), ("s", 5, "status", "READY"), ("s", 5, "mood", "good"),
            ("t", 1, "status", "READY"), ("t", 2, "status", "GATHERING"), ("u", 1, "genres", "RPG"),
            ("v", 1, "mood", "good"), ("w", 1, "genres", "a"), ("w", 1, "genres", "b"), ("w", 1, "genres", None),
        ],
        "session_id string, turn int, key string, value string",
    )
    folded = r.fold_preferences(turns)
    assert {x.session_id: (x.preferences, x.status) for x in folded.collect()} == {
        "s": ({"genres": "Indie", "developers": None, "status": "READY"}, "READY"),
        "t": ({"status": "GATHERING"}, "GATHERING"),
        "u": ({"genres": "RPG"}, "GATHERING"),
        "v": ({}, "GATHERING"),
        "w": ({"genres": "b"}, "GATHERING"),
    }
    assert rows(r.ready_sessions(folded), "session_id") == [("s",)]


def test_embedding_tables(spark):
    dim = spark.createDataFrame(
        [(1, "Name", ["RPG"], ["Co-op"], "x" * 300), (2, "Other", [], [], "")],
        "game_id long, game_name string, game_genres array<string>, game_categories array<string>, "
        "game_detailed_description string",
    )
    assert sorted(len(x.embedding) for x in r.profile_embeddings(dim, size=16).collect()) == [16, 16]
    chunks = r.chunk_embeddings(dim, vector_size=16)
    assert rows(chunks, "game_id", "chunk_id") == [(1, 0), (1, 1)]


def test_blocks_keep_vectors_as_they_are(spark):
    df = spark.createDataFrame([(1, 7, [3.0, 4.0]), (1, 8, [0.0, 0.0]), (2, 9, [1.0, 2.0])], "g int, i int, v array<double>")
    back = blocks.unpack(r.vectors_by_group(df, "g", ["i"], "v"), "v")
    assert rows(back) == [(1, 7, [3.0, 4.0]), (1, 8, [0.0, 0.0]), (2, 9, [1.0, 2.0])]


def test_kernel_emits_k_rows_per_left_row_and_task(spark):
    right = spark.range(2000).selectExpr("id", "array(cos(id), sin(id), CAST(id % 3 AS double)) AS v").coalesce(1)
    left = spark.range(5).selectExpr("id AS q", "array(cos(id), sin(id), 1D) AS v")
    met = blocks.meet(blocks.pack(left, ["q"], "v"), blocks.pack(right, ["id"], "v", rows=50))
    found = blocks.best_matches(met, 3)
    assert found.count() <= 5 * 3 * met.rdd.getNumPartitions()


def test_best_matches_of_many_queries_take_little_memory():
    import tracemalloc

    import pandas as pd
    from pyspark.sql import types as T

    from ludolytics.operators import blocks

    ids = lambda name: T.ArrayType(T.StructType([T.StructField(name, T.LongType())]))
    columns = {"right_ids": ids("game"), "right_matrix": T.BinaryType(), "left_ids": ids("query"), "left_matrix": T.BinaryType()}
    schema = T.StructType([T.StructField(c, kind) for c, kind in columns.items()])

    class Met:
        def __init__(self):
            self.schema = schema

        def mapInPandas(self, kernel, _):
            return kernel

    kernel = blocks.best_matches(Met(), 10)
    rng = np.random.default_rng(3)
    games = rng.normal(size=(256, 4))
    games[7] = games[5]  # a tie, which the smaller id wins
    queries = [rng.normal(size=(256, 4)) for _ in range(40)]

    def frames():
        right = [{"game": 10_000 + i} for i in range(256)]
        for n, block in enumerate(queries):
            left = [{"query": 100_000 + 256 * n + i} for i in range(256)]
            yield pd.DataFrame([[right, games.tobytes(), left, block.tobytes()]], columns=schema.names)

    tracemalloc.start()
    found = kernel(frames())
    first = next(found)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 5e6  # of 10,240 queries
    out = pd.concat([first, *found])
    sims = np.vstack(queries) @ games.T
    order = np.lexsort((np.broadcast_to(np.arange(256), sims.shape), -sims), axis=1)[:, :10]
    assert (out["game"].to_numpy().reshape(-1, 10) == 10_000 + order).all()
    assert (out["query"].to_numpy() == np.repeat(100_000 + np.arange(10_240), 10)).all()
