from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from ludolytics import schemas
from ludolytics.plans.warehouse import int_deduplicated_reviews
from ludolytics.sources import readers, writers
from ludolytics.streaming.ingest import ingest_batch, read_ingested, run_ingest, stream_reviews

D = [date(2024, 1, k) for k in range(1, 29)]


def batch(spark, *records, columns="review_id long, v string, scrape_date date"):
    return spark.createDataFrame(list(records), columns)


def stored(spark, path):
    return rows(spark.read.option("mergeSchema", True).parquet(path).select("review_id", "v", "scrape_date"))


def test_incremental_load_takes_only_later_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.incremental_append(batch(spark, (1, "a", D[0]), (2, "b", D[1])), path)
    writers.incremental_append(batch(spark, (3, "late", D[1]), (4, "old", D[0]), (5, "new", D[2])), path)
    assert stored(spark, path) == [(1, "a", D[0]), (2, "b", D[1]), (5, "new", D[2])]


def test_incremental_load_replaces_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.incremental_append(batch(spark, (1, "a", D[0]), (2, "b", D[0]), (3, "c", D[1])), path)
    writers.incremental_append(batch(spark, (1, "a2", D[2]), (3, "c2", D[2])), path)
    # the partition of day 1 lost its only row
    assert stored(spark, path) == [(1, "a2", D[2]), (2, "b", D[0]), (3, "c2", D[2])]
    writers.incremental_append(batch(spark, (1, "a2", D[2]), (3, "c2", D[2])), path)  # again: nothing newer
    assert stored(spark, path) == [(1, "a2", D[2]), (2, "b", D[0]), (3, "c2", D[2])]


def test_incremental_load_replaces_rows_with_null_or_escaped_marks(spark, tmp_path):
    path, columns = str(tmp_path / "t a"), "review_id long, v string, scrape_date string"
    old = batch(spark, (1, "a", None), (2, "b", "2024-01-01 00:00:00"), (3, "c", "x=1%/y"), (4, "d", None), columns=columns)
    writers.incremental_append(old, path)
    writers.incremental_append(batch(spark, *((k, "new", "z:1") for k in (1, 2, 3)), columns=columns), path)
    assert stored(spark, path) == [(1, "new", "z:1"), (2, "new", "z:1"), (3, "new", "z:1"), (4, "d", None)]


def test_many_keys_of_a_batch_are_not_broadcast(spark, tmp_path, monkeypatch):
    plans, staged = [], writers.staged

    def seen(df):
        plans.append(plan(df))
        return staged(df)

    monkeypatch.setattr(writers, "staged", seen)
    path = str(tmp_path / "t")
    old = spark.range(150_000).selectExpr("id AS review_id", "'a' AS v", "DATE'2024-01-01' AS scrape_date")
    writers.incremental_append(old, path)
    newer = old.where("review_id < 120000").withColumn("v", F.lit("b")).withColumn("scrape_date", F.lit(D[1]))
    writers.incremental_append(newer, path)
    # the keys are small in their files and large in memory; folder names are few
    assert len(plans) == 3 and all("SortMergeJoin" in p for p in plans[1:])
    assert stored(spark, path)[0] == (0, "b", D[1]) and spark.read.parquet(path).count() == 150_000


def test_landed_rows_are_not_sorted_into_their_folder(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    # Spark sorts the rows of a task before it deals them to partition folders
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda *_: pytest.fail("rows are dealt to folders"))
    landed = spark.range(5).withColumn("scrape_date", F.lit(D[3]))
    writers.write_batches(landed, str(tmp_path / "t"), 10, D[0])
    writers.write_batches(landed, str(tmp_path / "t"), 10, D[1])
    kept = spark.read.parquet(str(tmp_path / "t")).groupBy("scrape_date").count()
    assert rows(kept) == [(D[0], 5), (D[1], 5)]


def test_shared_folder_is_asked_for_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from ludolytics.session import shared_root

    def session(master, folder=None):
        context = SimpleNamespace(master=master, applicationId=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)

    for master in ("yarn", "spark://host:1", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_root(session(master))
        assert shared_root(session(master, "s3a://shared")) == "s3a://shared"
    assert shared_root(session("local[4]"))


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = tmp_path / "t"
    writers.incremental_append(batch(spark, (1, "a", D[0]), (2, "b", D[1])), str(path))
    before = sorted(p.name for p in (path / f"scrape_date={D[0]}").iterdir())
    writers.incremental_append(batch(spark, (2, "b2", D[2])), str(path))
    assert sorted(p.name for p in (path / f"scrape_date={D[0]}").iterdir()) == before


def test_incremental_load_of_an_empty_table_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.incremental_append(batch(spark), path)
    writers.incremental_append(batch(spark, (1, "a", D[0])), path)
    assert readers.read_if_present(spark, path, batch(spark).schema).isEmpty()
    writers.incremental_append(batch(spark, (1, "a", D[0])), path, full_refresh=True)
    assert stored(spark, path) == [(1, "a", D[0])]


def test_schema_changes(spark, tmp_path):
    wide = "review_id long, v string, scrape_date date, extra int"
    for mode, columns in (("append", {"extra"}), ("ignore", set())):
        path = str(tmp_path / mode)
        writers.incremental_append(batch(spark, (1, "a", D[0])), path)
        newer = batch(spark, (2, "b", D[1], 7), columns=wide)
        writers.incremental_append(newer, path, on_schema_change=mode)
        merged = spark.read.option("mergeSchema", True).parquet(path)
        assert set(merged.columns) - {"review_id", "v", "scrape_date"} == columns
    merged = spark.read.option("mergeSchema", True).parquet(str(tmp_path / "append"))
    assert rows(merged, "review_id", "extra") == [(1, None), (2, 7)]
    # a later batch without the column keeps it, also in a rewritten partition
    path = str(tmp_path / "append")
    writers.incremental_append(batch(spark, (9, "x", D[2])), path, on_schema_change="append")
    with pytest.raises(ValueError):
        writers.incremental_append(newer, path, on_schema_change="other")


def review_rows(spark, *records):
    base = (1, "t", datetime(2024, 1, 1), False, True, 0.5, 0, 0)
    data = [(r, g, d, *base) for r, g, d in records]
    return spark.createDataFrame(
        data,
        "review_id long, game_id long, scrape_date date, user_id long, review string, timestamp_created timestamp, "
        "written_during_early_access boolean, voted_up boolean, weighted_vote_score double, votes_up long, "
        "comment_count long",
    )


def test_many_batches_equal_one(spark, tmp_path):
    everything = [(i, i % 7, D[i % 5]) for i in range(60)] + [(i, i % 5, D[i % 5]) for i in range(60)]
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    writers.incremental_append(review_rows(spark, *everything), one, resolve=int_deduplicated_reviews)
    for day in D[:5]:
        part = [r for r in everything if r[2] <= day]
        writers.incremental_append(review_rows(spark, *part), many, resolve=int_deduplicated_reviews)
    columns = ["review_id", "game_id", "scrape_date"]
    assert rows(spark.read.parquet(one), *columns) == rows(spark.read.parquet(many), *columns)


def test_months_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "m")
    month = lambda *r: spark.createDataFrame(list(r), "id long, m timestamp")
    writers.write_month(month((1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1))), path, "m")
    writers.write_month(month((3, datetime(2024, 2, 1))), path, "m")
    back = spark.read.parquet(path)
    assert rows(back, "id", "m") == [(1, D[0]), (3, date(2024, 2, 1))]


def test_batches_have_bounded_files(spark, tmp_path):
    path = tmp_path / "raw"
    writers.write_batches(spark.range(95).coalesce(1), str(path), 10, D[0])
    writers.write_batches(spark.range(5).coalesce(1), str(path), 10, D[0])
    files = list((path / f"scrape_date={D[0]}").glob("*.parquet"))
    assert len(files) == 11
    assert max(spark.read.parquet(str(f)).count() for f in files) == 10
    assert spark.read.parquet(str(path)).count() == 100


def test_last_watermark_wins(spark, tmp_path):
    path = str(tmp_path / "s")
    assert readers.load_watermarks(spark, path).isEmpty()
    at = lambda n: datetime(2024, 1, n)
    put = lambda n, *r: writers.upsert_watermarks(spark.createDataFrame(list(r), schemas.WATERMARKS), path, n)
    put(0, (1, at(5)), (2, at(5)), (3, at(5)))
    put(1, (1, at(3)), (3, None))
    put(2)  # nothing to record
    assert rows(readers.load_watermarks(spark, path)) == [(1, at(3)), (2, at(5))]
    assert rows(readers.load_watermarks(spark, path, before=1)) == [(1, at(5)), (2, at(5)), (3, at(5))]
    put(1, (1, at(4)))  # update 1 again, differently
    assert rows(readers.load_watermarks(spark, path)) == [(1, at(4)), (2, at(5)), (3, at(5))]
    writers.compact_watermarks(spark, path, str(tmp_path / "c"))
    assert rows(readers.load_watermarks(spark, str(tmp_path / "c"))) == [(1, at(4)), (2, at(5)), (3, at(5))]


def test_views_and_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], schemas.APP_IDS)
    table = writers.materialize(df, "table", "t_ids", str(tmp_path / "ids"))
    assert rows(table) == [(1, "a")] and readers.table_exists(spark, "t_ids")
    assert not readers.register_view_if_absent(spark, "t_ids", str(tmp_path / "ids"))
    assert readers.register_view_if_absent(spark, "t_ids2", str(tmp_path / "ids"))
    assert rows(spark.table("t_ids2")) == [(1, "a")]
    assert not readers.table_exists(spark, "no_such_table")
    assert rows(writers.materialize(df, "view", "t_view")) == [(1, "a")]
    for bad in (("other", "x", None), ("table", "x", None)):
        with pytest.raises(ValueError):
            writers.materialize(df, *bad)


def test_serving_export_refuses_repeated_keys(spark, tmp_path):
    kinds = {f.name: f.dataType.simpleString() for f in schemas.GAMES}
    dim = spark.range(3).select(
        *[F.col("id").alias(c) if c == "game_id" else F.lit(None).cast("string").alias(c) for c in schemas.SERVING_GAME_COLUMNS]
    )
    writers.export_serving_games(dim, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).columns == schemas.SERVING_GAME_COLUMNS
    with pytest.raises(ValueError):
        writers.export_serving_games(dim.union(dim))
    assert kinds["appid"] == "bigint"


REVIEW = "rec_id long, appid long, timestamp_created long, text string"


def land(spark, path, *records):
    spark.createDataFrame(list(records), REVIEW).coalesce(1).write.mode("append").parquet(path)


def test_streamed_ingest_drops_seen_rows_per_game(spark, tmp_path):
    raw, target, state, check = (str(tmp_path / n) for n in ("raw", "out", "state", "check"))
    schema = spark.createDataFrame([], REVIEW).schema
    assert read_ingested(spark, target, schema).isEmpty()
    land(spark, raw, (1, 1, 100, "a"), (1, 1, 100, "a"), (2, 2, 500, "b"))
    run_ingest(stream_reviews(spark, raw, schema), target, state, check)
    # game 1 moves on from 100, game 2 from 500: a global watermark would drop 3
    land(spark, raw, (3, 1, 101, "c"), (4, 2, 400, "late"), (5, 2, 501, "d"), (6, 3, 1, "first"))
    run_ingest(stream_reviews(spark, raw, schema), target, state, check)
    run_ingest(stream_reviews(spark, raw, schema), target, state, check)  # nothing new
    assert rows(read_ingested(spark, target, schema), "rec_id") == [(1,), (2,), (3,), (5,), (6,)]
    marks = {r.game_id: int(r.last_processed_timestamp.timestamp()) for r in readers.load_watermarks(spark, state).collect()}
    assert marks == {1: 101, 2: 501, 3: 1}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    schema = spark.createDataFrame([], REVIEW).schema
    first = spark.createDataFrame([(1, 1, 100, "a"), (2, 1, 200, "b")], REVIEW)
    second = spark.createDataFrame([(1, 1, 300, "edited"), (3, 1, 150, "late")], REVIEW)
    for n, df in ((0, first), (1, second), (1, second)):
        ingest_batch(df, n, target, state)
    want = [(1, 1, 300, "edited"), (2, 1, 200, "b")]
    assert rows(read_ingested(spark, target, schema)) == want
