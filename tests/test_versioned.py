import random

import pytest

from helpers import rows
from ludolytics.session import scratch_path
from ludolytics.sources import versioned
from ludolytics.sources.versioned import VersionedTable
from ludolytics.streaming.ingest import merge_batch


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, "versioned"), "id", buckets=16)


def make(spark, data, extra=""):
    return spark.createDataFrame(data, f"id bigint, v string, day int{extra}")


def test_rows_replace_by_key(spark, table):
    rng, want, no_key = random.Random(3), {}, []
    for load in range(6):
        batch = {rng.randrange(60): f"{load}-{k}" for k in range(20)}
        own = [(i, v, load) for i, v in batch.items()] + [(None, f"none {load}", load)]
        assert table.merge(make(spark, own)) == load + 1
        want.update({i: (i, v, load) for i, v in batch.items()})
        no_key.append((None, f"none {load}", load))
        assert rows(table.read()) == sorted([*want.values(), *no_key], key=repr)


def test_a_small_load_and_a_lookup_read_only_their_buckets(spark, table, monkeypatch):
    table.merge(make(spark, [(k, "old", 1) for k in range(400)]))
    asked = []
    own = VersionedTable._rows

    def watched(self, manifest, buckets=None):
        found = own(self, manifest, buckets)
        asked.append(found.inputFiles())
        return found

    monkeypatch.setattr(VersionedTable, "_rows", watched)
    table.merge(make(spark, [(7, "new", 2), (1000, "new", 2)]))
    every = own(table, table.manifest()).inputFiles()
    assert len(every) >= 16 and all(len(files) <= 2 for files in asked) and asked
    asked.clear()
    assert rows(table.lookup(make(spark, [(7, "", 0), (5000, "", 0), (None, "", 0)]))) == [(7, "new", 2)]
    assert all(len(files) <= 3 for files in asked)
    assert table.read().count() == 401


def test_a_bucket_without_a_clash_is_not_rewritten(spark, table):
    table.merge(make(spark, [(k, "old", 1) for k in range(100)]))
    table.merge(make(spark, [(k, "new", 2) for k in range(100, 130)]))
    folders = table.manifest().folders
    assert any(versions == [1, 2] for versions in folders.values()) and not any(versions == [2] for versions in folders.values())
    table.merge(make(spark, [(5, "newer", 3)]))
    assert sum(versions == [3] for versions in table.manifest().folders.values()) == 1
    assert table.read().count() == 130 and rows(table.read().where("id = 5")) == [(5, "newer", 3)]


def test_many_folders_become_one(spark, table, monkeypatch):
    monkeypatch.setattr(versioned, "MOST_FOLDERS", 2)
    table = VersionedTable(spark, scratch_path(spark, "versioned"), "id", buckets=1)
    for k in range(5):
        table.merge(make(spark, [(k, "x", k)]))
        assert len(table.manifest().folders[0]) <= 2
    assert table.read().count() == 5
    gone = table.vacuum()
    assert gone and table.read().count() == 5 and table.vacuum() == []


def test_a_load_that_dies_is_not_seen(spark, table, monkeypatch):
    table.merge(make(spark, [(k, "old", 1) for k in range(50)]))
    before, own = rows(table.read()), VersionedTable._commit

    def dies(self, manifest):
        assert rows(table.read()) == before  # all data is written, nothing is seen
        raise OSError("lost")

    monkeypatch.setattr(VersionedTable, "_commit", dies)
    with pytest.raises(OSError):
        table.merge(make(spark, [(k, "new", 2) for k in range(25)]))
    assert rows(table.read()) == before
    monkeypatch.setattr(VersionedTable, "_commit", own)
    table.merge(make(spark, [(3, "newer", 2)]))
    assert rows(table.read().where("v <> 'old'")) == [(3, "newer", 2)] and table.read().count() == 50


def test_of_two_loads_at_once_one_fails(spark, table):
    table.merge(make(spark, [(1, "a", 1)]))
    manifest = table.manifest()
    table.merge(make(spark, [(2, "b", 1)]))
    with pytest.raises(RuntimeError):
        table._commit(versioned.Manifest(manifest.version + 1, 16, manifest.schema))
    assert table.read().count() == 2


def test_marks_and_schema(spark, table):
    assert table.read() is None
    table.merge(make(spark, [(1, "a", 5), (2, "b", None)]), mark="day")
    table.merge(make(spark, [(1, "late", 5), (3, "c", 6), (4, "d", None)]), mark="day")  # strictly above 5
    assert rows(table.read()) == [(1, "a", 5), (2, "b", None), (3, "c", 6)]
    wide = make(spark, [(3, "cc", 7, 1.5)], ", w double")
    table.merge(wide, mark="day")
    assert table.read().columns == ["id", "v", "day"] and rows(table.read())[-1] == (3, "cc", 7)
    table.merge(make(spark, [(9, "e", 8, 2.5)], ", w double"), mark="day", on_schema_change="append")
    table.merge(spark.createDataFrame([(10, 9)], "id bigint, day int"), mark="day")
    assert rows(table.read())[-2:] == [(3, "cc", 7, None), (9, "e", 8, 2.5)] and (10, None, 9, None) in rows(table.read())
    with pytest.raises(ValueError):
        table.merge(wide, on_schema_change="other")


def test_an_empty_first_load(spark, table):
    table.merge(make(spark, []), mark="day")
    assert table.read().count() == 0
    table.merge(make(spark, [(1, "a", 1)]), mark="day")  # there, but without a mark: nothing is above it
    assert table.read().count() == 0


def test_repeated_batches_change_nothing(spark):
    root = scratch_path(spark, "merge")
    schema = "rec_id bigint, appid bigint, timestamp_created bigint, text string"
    first = spark.createDataFrame([(1, 10, 100, "a"), (1, 10, 100, "b"), (2, 20, 50, "c"), (3, None, 9, "d")], schema)
    second = spark.createDataFrame([(4, 10, 100, "old"), (5, 10, 101, "new"), (2, 20, 60, "again")], schema)
    load = lambda batch, no: merge_batch(batch, no, f"{root}/rows", f"{root}/times")
    load(first, 0)
    load(second, 1)
    want = rows(VersionedTable(spark, f"{root}/rows", "rec_id").read())
    assert {(r[0], r[3]) for r in want} >= {(5, "new"), (2, "again")} and not any(r[3] == "old" for r in want)
    for batch, no in ((second, 1), (first, 0)):
        load(batch, no)
        assert rows(VersionedTable(spark, f"{root}/rows", "rec_id").read()) == want
    # rows committed, times not: the repeated batch moves the times alone
    times = VersionedTable(spark, f"{root}/times", "game_id")
    third = spark.createDataFrame([(6, 10, 150, "x")], schema)
    VersionedTable(spark, f"{root}/rows", "rec_id").merge(third, batch_no=2)
    load(third, 2)
    assert rows(times.read().where("game_id = 10"), "game_id")[0] == (10,) and times.manifest().batch_no == 2
    assert VersionedTable(spark, f"{root}/rows", "rec_id").read().where("rec_id = 6").count() == 1
