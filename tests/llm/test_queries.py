import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_queries import TABLES, rows
from ludolytics.llm import queries
from llm_helpers import CLASHING, sentence, text

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"CREATE VIEW {t} AS FROM '{SMALL}/{t}.parquet'")
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert len(got) > 0 and rows(got) == rows(duck.sql(queries.ORACLE_SQL[name]).df())


def test_registry():
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in entry.queries()) == 1
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("number", range(5))
def test_stages_take_clashing_columns_and_empty_tables(spark, documents, odd, tmp_path, number):
    names = "predicted score removed_lines hits items n_words n_hit row kept_0 component_id tag removed kept"
    name, stage = corpus_pipeline.STAGES[number]
    spark.createDataFrame([(1, sentence(9000, 20))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(5, 0), (9, 1)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents([r for r in odd if len(r[1] or "") < 5000], extra=False)
    docs = docs.selectExpr("*", *(f"7 AS {c}" for c in sorted({*names.split(), *CLASHING})))
    for rows in (docs, docs.where("false")):
        out = stage(spark, rows, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == rows.columns
        got = out.collect()
        assert len(got) <= rows.count() and (number not in (1, 4) or len(got) == rows.count())


def test_pipeline_stages(spark, documents, odd, tmp_path):
    passage = text(77, 8)
    planted = [(k + 100, text(k + 20, 12)) for k in range(20)]
    planted += [(200, planted[0][1]), (201, planted[1][1].replace("river", "rivers", 1)), (202, text(400, 3) + "\n" + passage), (203, passage + "\n" + text(401, 3))]
    planted += [(300, text(500, 6) + " " + sentence(9000, 20)), (301, "few plain words")]
    docs = documents(odd + planted, extra=False).coalesce(3)
    folder = str(tmp_path)
    spark.createDataFrame([(1, sentence(9000, 20))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(100, 0)], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = docs.collect()
    count = lambda name: len(seen[name])
    assert count("toxicity") == count("line dedup") == len(odd) + len(planted)
    cut = {r["doc_id"]: r["text"] for r in seen["line dedup"] if (r["doc_id"] or 0) >= 100}
    assert cut[200] == "" and passage in cut[202] and passage not in cut[203] and cut[110] == dict(planted)[110]
    assert 300 in [r["doc_id"] for r in seen["near copies"]] and 300 not in [r["doc_id"] for r in seen["benchmark decontamination"]]
    assert count("benchmark decontamination") == count("piece encoding and decoding")
    decoded = {r["doc_id"]: r["decoded"] for r in seen["piece encoding and decoding"]}
    assert decoded[110] == dict(planted)[110] and decoded[301] == "few plain words"
