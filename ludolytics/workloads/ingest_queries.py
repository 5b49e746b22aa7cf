"""Landed bodies, cutoffs, state, incremental loads, streaming, sinks and checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ludolytics.plans import features, ingest, quality, warehouse
from ludolytics.session import scratch_path
from ludolytics.sources import readers, writers
from ludolytics.sources.versioned import VersionedTable
from ludolytics.streaming.ingest import ingest_batch, merge_batch, read_ingested, run_ingest, stream_reviews
from ludolytics.vocabulary import CATEGORIES, GENRES, REVIEW_SCORE_DESCRIPTIONS
from ludolytics.workloads import bindings as b
from ludolytics.workloads.oracle import FACT_SELECT, GAME_SELECT, NULLABLE, day, items, layered, ts
from ludolytics.workloads.registry import workload

SCRAPED = date(2024, 1, 1)

# ---- landed bodies, written by Spark from the parts, orders and line items


@workload(
    "parse_app_list",
    "I01 F13",
    "SELECT p_size AS appid, trim(p_name) AS name FROM (SELECT DISTINCT p_size, p_name FROM part)",
)
def _(spark, d):
    # each part lands a body that lists its app twice, once with stray white space
    bodies = b.table(spark, d, "part").selectExpr(
        """to_json(named_struct('applist', named_struct('apps', array(
             named_struct('appid', p_size, 'name', concat(' ', p_name, '\\t')),
             named_struct('appid', p_size, 'name', concat(' ', p_name, '\\t')))))) AS body"""
    )
    return ingest.parse_app_list(bodies)


def _landed_games(spark, d):
    data = """to_json(named_struct(
        'name', p_name, 'type', lower(p_type), 'required_age', concat(p_size, '+'), 'is_free', p_retailprice < 920,
        'controller_support', CASE WHEN p_size < 25 THEN 'full' ELSE 'partial' END,
        'detailed_description', concat('<h1>', p_name, '</h1><a href="x">gone</a>R&amp;D<br>', p_brand),
        'about_the_game', concat('<p>', p_brand, '<video>gone</video> ', p_type, '</p>'),
        'short_description', CASE WHEN p_size = 2 THEN '' ELSE p_name END,
        'supported_languages', CASE WHEN p_size <> 3
            THEN concat(p_brand, '<strong>*</strong>, ', p_type, '<br><strong>*</strong>audio') END,
        'header_image', concat('img/', p_partkey), 'developers', CASE WHEN p_size <> 4 THEN array(p_brand) END,
        'publishers', array(p_type),
        'price_overview', CASE WHEN p_retailprice >= 920 THEN named_struct('initial', p_size * 100 + 99) END,
        'recommendations', CASE WHEN p_size <> 6 THEN named_struct('total', p_size * 10) END,
        'categories', transform(split(p_name, ' '), x -> named_struct('description', x)),
        'genres', CASE WHEN p_size = 5 THEN cast(array() AS array<struct<description:string>>)
                  ELSE array(named_struct('description', p_type)) END,
        'platforms', named_struct('windows', true, 'mac', p_size > 10, 'linux', p_size > 20),
        'release_date', named_struct('date', 'Jan 5, 2020', 'coming_soon', p_size > 48),
        'dlc', CASE WHEN p_size > 40 THEN array(p_partkey + 1) END))"""
    needs = """CASE WHEN p_size = 8 THEN '[]' ELSE to_json(named_struct(
        'minimum', concat('<b>', p_brand, '</b> cpu'), 'recommended', CASE WHEN p_size > 9 THEN 'any' END)) END"""
    return b.table(spark, d, "part").select(
        F.col("p_partkey").alias("appid"),
        F.expr(
            f"""concat('{{"success":', p_type <> 'PROMO', ',"data":', regexp_replace({data}, '}}$', ''),
                ',"pc_requirements":', {needs}, '}}}}')"""
        ).alias("details"),
        F.expr(
            """CASE WHEN p_size = 9 THEN '{"query_summary":{}}' ELSE to_json(named_struct('reviews', array('{}'),
               'query_summary', named_struct('review_score', p_size, 'review_score_desc', p_type))) END"""
        ).alias("reviews"),
    )


@workload(
    "flatten_game_payload",
    "I02 I03 I04 I05 I06 I07 I08 I09 I10 I11 I16 F15 F16 F25",
    f"""
SELECT p_partkey AS appid, p_name AS name, lower(p_type) AS type, CAST(p_size AS BIGINT) AS required_age,
       p_retailprice < 920 AS is_free, p_brand || ' cpu' AS minimum_pc_requirements,
       CASE WHEN p_size > 9 THEN 'any' END AS recommended_pc_requirements,
       CASE WHEN p_size < 25 THEN 'full' ELSE 'partial' END AS controller_support,
       p_name || ' R&D ' || p_brand AS detailed_description, p_brand || ' ' || p_type AS about_the_game,
       p_name AS short_description, p_brand || ',' || p_type AS supported_languages,
       'img/' || p_partkey AS header_image, CASE WHEN p_size = 4 THEN '' ELSE p_brand END AS developers,
       p_type AS publishers, CASE WHEN p_retailprice >= 920 THEN (p_size * 100 + 99) / 100.0 END AS price,
       replace(p_name, ' ', ',') AS categories, p_type AS genres, true AS windows_support,
       p_size > 10 AS mac_support, p_size > 20 AS linux_support, 'Jan 5, 2020' AS release_date,
       p_size > 48 AS coming_soon, CASE WHEN p_size <> 6 THEN CAST(p_size * 10 AS VARCHAR) END AS recommendations,
       CASE WHEN p_size > 40 THEN CAST(p_partkey + 1 AS VARCHAR) ELSE '' END AS dlc,
       CAST(p_size AS BIGINT) AS review_score, p_type AS review_score_desc, '{SCRAPED}' AS scrape_date
FROM part WHERE p_type <> 'PROMO' AND p_size NOT IN (2, 3, 5, 8, 9)""",
    ("recommendations",),
)
def _(spark, d):
    return ingest.flatten_game_payload(_landed_games(spark, d), scrape_date=SCRAPED)


@workload(
    "flatten_review_payload",
    "I12 I16",
    f"""
SELECT l_orderkey * 10 + l_linenumber AS rec_id, o_custkey AS author_id, l_partkey AS appid,
       CAST(nullif(l_linenumber - 1, 0) AS VARCHAR) AS playtime_forever,
       CAST(CAST(nullif(l_quantity - 1, 0) AS BIGINT) AS VARCHAR) AS playtime_at_review, o_orderpriority AS review,
       CAST(epoch(l_shipdate) AS BIGINT) AS timestamp_created, l_returnflag <> 'R' AS voted_up,
       CAST(l_quantity AS BIGINT) AS votes_up, l_discount AS weighted_vote_score,
       o_orderstatus = 'P' AS written_during_early_access, '{SCRAPED}' AS scrape_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ("playtime_forever", "playtime_at_review"),
)
def _(spark, d):
    lines, orders = b.table(spark, d, "lineitem"), b.table(spark, d, "orders")
    body = """to_json(named_struct(
        'recommendationid', cast(l_orderkey * 10 + l_linenumber AS string),
        'author', named_struct('steamid', cast(o_custkey AS string), 'playtime_forever', l_linenumber - 1,
                               'playtime_at_review', cast(l_quantity AS bigint) - 1),
        'language', 'english', 'review', o_orderpriority,
        'timestamp_created', unix_seconds(cast(l_shipdate AS timestamp)), 'voted_up', l_returnflag <> 'R',
        'votes_up', cast(l_quantity AS bigint), 'weighted_vote_score', cast(l_discount AS string),
        'written_during_early_access', o_orderstatus = 'P'))"""
    landed = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("appid"), F.expr(body).alias("body")
    )
    return ingest.flatten_review_payload(landed, scrape_date=SCRAPED).select(
        "rec_id",
        "author_id",
        "appid",
        "playtime_forever",
        "playtime_at_review",
        "review",
        "timestamp_created",
        "voted_up",
        "votes_up",
        "weighted_vote_score",
        "written_during_early_access",
        "scrape_date",
    )


# ---- per-game cutoffs and state; users of the event stream play the games


def _event_reviews(spark, d):
    return b.table(spark, d, "events").select(
        F.col("event_id").alias("rec_id"),
        F.col("user_id").alias("appid"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp_created"),
        "event_type",
    )


_EVENTS = """
reviews AS (SELECT event_id AS rec_id, user_id AS appid, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_created,
                   event_type FROM events),
state AS (SELECT appid AS game_id, max(timestamp_created) AS cutoff FROM reviews
          WHERE event_type = 'signup' GROUP BY appid)"""


def _state(reviews):
    return ingest.newest_per_game(reviews.where("event_type = 'signup'"))


@workload(
    "drop_seen",
    "I13 Z02",
    f"""
WITH {_EVENTS.strip()}
SELECT r.* FROM reviews r LEFT JOIN state s ON r.appid = s.game_id WHERE r.timestamp_created > coalesce(cutoff, 0)""",
)
def _(spark, d):
    reviews = _event_reviews(spark, d)
    return ingest.drop_seen(reviews, _state(reviews))


@workload(
    "games_with_new_reviews",
    "I14",
    f"""
WITH {_EVENTS.strip()},
newest AS (SELECT appid AS game_id, max(timestamp_created) AS s FROM reviews WHERE event_type <> 'signup' GROUP BY appid)
SELECT n.game_id, {ts('make_timestamp(s * 1000000)')} AS last_processed_timestamp
FROM newest n LEFT JOIN state c ON n.game_id = c.game_id WHERE cutoff IS NULL OR s > cutoff""",
)
def _(spark, d):
    reviews = _event_reviews(spark, d)
    return ingest.games_with_new_reviews(reviews.where("event_type <> 'signup'"), _state(reviews))


@workload(
    "backfill_watermarks",
    "S17 I15",
    layered(f"""
SELECT game_id, {ts('max(timestamp_created)')} AS last_processed_timestamp FROM stg_reviews GROUP BY game_id"""),
)
def _(spark, d):
    return ingest.backfill_watermarks(warehouse.stg_reviews(b.raw_reviews(spark, d)))


@workload(
    "upsert_watermarks",
    "S15 S16",
    f"""
WITH {_EVENTS.strip()},
before AS (SELECT appid AS game_id, max(timestamp_created) AS t FROM reviews GROUP BY appid),
after AS (SELECT appid AS game_id, CASE WHEN count(*) > 15 THEN min(timestamp_created) END AS t FROM reviews
          WHERE event_type = 'signup' GROUP BY appid)
SELECT b.game_id, {ts('make_timestamp((CASE WHEN a.game_id IS NULL THEN b.t ELSE a.t END) * 1000000)')}
         AS last_processed_timestamp
FROM before b LEFT JOIN after a ON a.game_id = b.game_id WHERE a.game_id IS NULL OR a.t IS NOT NULL""",
)
def _(spark, d):
    reviews = _event_reviews(spark, d)
    path = scratch_path(spark, "state")
    writers.upsert_watermarks(ingest.newest_per_game(reviews), path, 0)
    signups = reviews.where("event_type = 'signup'").groupBy(F.col("appid").alias("game_id"))
    earliest = F.when(F.count(F.lit(1)) > 15, F.timestamp_seconds(F.min("timestamp_created")))
    writers.upsert_watermarks(signups.agg(earliest.alias("last_processed_timestamp")), path, 1)
    return readers.load_watermarks(spark, path)


# ---- incremental loads

_YEARS = """
dated AS (SELECT * REPLACE (CAST(date_trunc('year', timestamp_created) AS DATE) AS scrape_date)
          FROM int_reviews_with_canonical_id),
old AS (SELECT * FROM dated WHERE scrape_date <= DATE '1998-01-01'),
later AS (SELECT * FROM dated WHERE scrape_date > DATE '1998-01-01')"""


def _one_per_review(source: str) -> str:
    return f"""
SELECT * FROM {source} QUALIFY row_number() OVER (
  PARTITION BY review_id
  ORDER BY game_id DESC NULLS LAST, user_id DESC NULLS LAST, timestamp_created DESC,
           scrape_date DESC, written_during_early_access DESC, voted_up DESC, weighted_vote_score DESC,
           votes_up DESC, comment_count DESC) = 1"""


@workload(
    "incremental_append",
    "S11 S12",
    layered(
        f"""
SELECT {FACT_SELECT}, 'first' AS loaded FROM first_load ANTI JOIN second_load USING (review_id)
UNION ALL
SELECT {FACT_SELECT}, 'second' AS loaded FROM second_load""",
        f"{_YEARS}, first_load AS ({_one_per_review('old')}), second_load AS ({_one_per_review('later')})",
    ),
    NULLABLE,
)
def _(spark, d):
    m = b.models(spark, d)
    dated = m["int_reviews_with_canonical_id"].withColumn("scrape_date", F.trunc("timestamp_created", "YEAR"))
    path = scratch_path(spark, "reviews")
    one = warehouse.int_deduplicated_reviews
    writers.incremental_append(dated.where(F.col("scrape_date") <= F.lit(date(1998, 1, 1))), path, resolve=one)
    # the second load sees everything, takes what is newer, and brings a new column
    newer = dated.withColumn("loaded", F.lit("second"))
    writers.incremental_append(newer, path, resolve=one, on_schema_change="append")
    stored = spark.read.schema(newer.schema).parquet(path)
    return stored.withColumn("loaded", F.coalesce("loaded", F.lit("first")))


@workload(
    "incremental_append_null_mark",
    "S11 S12",
    """
SELECT o_orderkey AS review_id, CASE WHEN o_orderkey % 3 = 0 THEN 'second' ELSE 'first' END AS v,
       CASE WHEN o_orderkey % 3 = 0 THEN '2 o''clock: late=1' WHEN o_orderkey % 5 > 0 THEN '1 o''clock: ' || o_orderkey % 5
            END AS mark
FROM orders""",
)
def _(spark, d):
    # stored rows have marks that are NULL or hold signs that folder names escape
    orders = b.table(spark, d, "orders").select(F.col("o_orderkey").alias("review_id"))
    part = F.col("review_id") % 5
    mark = F.when(part > 0, F.concat(F.lit("1 o'clock: "), part.cast("string")))
    path = scratch_path(spark, "marks")
    writers.incremental_append(orders.withColumns({"v": F.lit("first"), "mark": mark}), path, mark="mark")
    again = orders.where("review_id % 3 = 0")
    newer = again.withColumns({"v": F.lit("second"), "mark": F.lit("2 o'clock: late=1")})
    writers.incremental_append(newer, path, mark="mark")
    return spark.read.schema(newer.schema).parquet(path)


@workload(
    "versioned_merge",
    "S11 S12 U02",
    """
WITH reviews AS (SELECT event_id AS review_id, user_id, event_type, ts::DATE AS scrape_date FROM events),
first_load AS (SELECT *, NULL AS size FROM reviews WHERE scrape_date <= DATE '2024-01-10'),
second_load AS (
  SELECT review_id, max(user_id) AS user_id, max(event_type) AS event_type, max(scrape_date) AS scrape_date,
         max(len(event_type)) AS size
  FROM (SELECT * FROM reviews WHERE scrape_date > DATE '2024-01-10'
        UNION ALL SELECT review_id - review_id % 7, user_id, event_type, scrape_date FROM reviews
        WHERE scrape_date > DATE '2024-01-10') GROUP BY review_id)
SELECT review_id, user_id, event_type, strftime(scrape_date, '%Y-%m-%d') AS scrape_date, size::VARCHAR AS size
FROM (FROM first_load ANTI JOIN second_load USING (review_id) UNION ALL BY NAME FROM second_load)""",
    ["size"],
)
def _(spark, d):
    # the second load sees all rows and takes the later ones, some with ids of the first load, and a new column
    reviews = b.table(spark, d, "events").select(
        F.col("event_id").alias("review_id"), "user_id", "event_type", F.to_date("ts").alias("scrape_date")
    )
    table = VersionedTable(spark, scratch_path(spark, "versioned"), "review_id")
    table.merge(reviews.where(F.col("scrape_date") <= F.lit(date(2024, 1, 10))), "scrape_date")
    again = reviews.withColumn("review_id", F.expr("review_id - review_id % 7"))
    newer = reviews.unionByName(again).withColumn("size", F.length("event_type"))
    greatest = [F.max(c).alias(c) for c in newer.columns if c != "review_id"]
    table.merge(newer, "scrape_date", lambda df: df.groupBy("review_id").agg(*greatest), on_schema_change="append")
    return table.read()


_STREAMED = """
WITH reviews AS (SELECT event_id AS rec_id, user_id AS appid, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_created,
                        event_type, ts FROM events),
first_load AS (SELECT * FROM reviews WHERE ts < TIMESTAMP '2024-01-16'),
cutoffs AS (SELECT appid, max(timestamp_created) AS cutoff FROM first_load GROUP BY appid)
SELECT rec_id, appid, timestamp_created, event_type FROM first_load
UNION ALL
SELECT r.rec_id, r.appid, r.timestamp_created, r.event_type FROM reviews r LEFT JOIN cutoffs c ON r.appid = c.appid
WHERE r.ts >= TIMESTAMP '2024-01-10' AND r.timestamp_created > coalesce(cutoff, 0)"""


def _streamed(spark, d, load):
    reviews = _event_reviews(spark, d)
    root = scratch_path(spark, "stream")
    landing, target, state = f"{root}/landing", f"{root}/reviews", f"{root}/state"

    def land_and_run(part):
        part.write.mode("append").parquet(landing)
        stream = stream_reviews(spark, landing, reviews.schema)
        run_ingest(stream, target, state, f"{root}/checkpoint", load=load)

    # 16 and 10 January 2024; the second landing overlaps the first
    land_and_run(reviews.where("timestamp_created < unix_seconds(timestamp'2024-01-16')"))
    land_and_run(reviews.where("timestamp_created >= unix_seconds(timestamp'2024-01-10')"))
    if load is merge_batch:
        return VersionedTable(spark, target, "rec_id").read()
    return read_ingested(spark, target, reviews.schema)


@workload(
    "streaming_merge",
    "Z01 Z02 I13 I15 S15 S16",
    _STREAMED,
)
def _(spark, d):
    return _streamed(spark, d, merge_batch)


@workload(
    "streaming_ingest",
    "Z01 Z02 I13 I15 S16",
    _STREAMED,
)
def _(spark, d):
    return _streamed(spark, d, ingest_batch)


# ---- sinks and scans


@workload(
    "write_and_scan_reviews",
    "S01 S07 S08 U02",
    layered(f"SELECT rec_id, appid, {day("DATE '2024-02-01'")} AS scrape_date FROM raw_reviews"),
)
def _(spark, d):
    path = scratch_path(spark, "raw")
    raw = b.raw_reviews(spark, d)
    liked, disliked = raw.where("voted_up"), raw.where("NOT voted_up")
    writers.write_batches(liked.unionByName(disliked), path, writers.REVIEWS_PER_FILE, date(2024, 2, 1))
    return readers.scan_reviews(spark, path).select("rec_id", "appid", "scrape_date")


@workload(
    "write_and_scan_games",
    "S02 S06 S08",
    layered(f"""
SELECT appid, name, {items('genres')} AS genres, {day("DATE '2024-02-01'")} AS scrape_date FROM raw_games"""),
)
def _(spark, d):
    path = scratch_path(spark, "raw")
    writers.write_batches(b.raw_games(spark, d), path, writers.GAMES_PER_FILE, date(2024, 2, 1))
    return readers.scan_games(spark, path).select("appid", "name", "genres", "scrape_date")


@workload("views_and_tables", "S03 S04 S05 S10", layered("SELECT appid, name FROM app_ids"))
def _(spark, d):
    path = scratch_path(spark, "ids")
    name = "app_ids_" + path[-12:]
    writers.materialize(b.app_ids(spark, d), "table", name, path)
    if readers.register_view_if_absent(spark, name, path) or not readers.table_exists(spark, name):
        raise RuntimeError("the view should already be there")
    return readers.scan_app_ids(spark, path)


@workload("export_serving_games", "S19", layered(f"SELECT {GAME_SELECT} FROM dim_games"), NULLABLE)
def _(spark, d):
    path = scratch_path(spark, "serving")
    writers.export_serving_games(b.stored_models(spark, d)["dim_games"], path)
    return spark.read.parquet(path)


@workload(
    "month_partitions",
    "S09 S13",
    layered(f"""
SELECT game_id, {day('game_review_month')} AS game_review_month, game_num_reviews FROM monthly_game_metrics
WHERE game_review_month <= DATE '1998-05-31'"""),
)
def _(spark, d):
    metrics = features.monthly_game_metrics(b.stored_models(spark, d)["fact_reviews"])
    path = scratch_path(spark, "months")
    writers.write_month(metrics, path, "game_review_month")
    # writing one month again leaves the others alone
    again = metrics.where(F.col("game_review_month") == F.lit(date(1998, 5, 1)))
    writers.write_month(again, path, "game_review_month")
    return readers.load_data(spark, {"game": path}, "1998-05-31", "game").select(
        "game_id", "game_review_month", "game_num_reviews"
    )


# ---- checks


def _null_checks(model: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, 'not_null:{c}' AS check_name, count(*) FILTER (WHERE {c} IS NULL) AS failures"
        f" FROM {model}"
        for c in columns
    )


def _unique_check(model: str, column: str) -> str:
    return f"""
SELECT '{model}' AS model, 'unique:{column}' AS check_name, count(*) AS failures
FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""


def _parent_check(model: str, column: str, parent: str, field: str) -> str:
    return f"""
SELECT '{model}' AS model, 'relationships:{column}' AS check_name, count(*) AS failures FROM {model}
WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {field} FROM {parent} WHERE {field} IS NOT NULL)"""


def _checks_sql() -> str:
    parts = []
    for model, checks in quality.CHECKS.items():
        if checks.get("not_null"):
            parts.append(_null_checks(model, checks["not_null"]))
        parts += [_unique_check(model, c) for c in checks.get("unique", [])]
        parts += [_parent_check(model, *rule) for rule in checks.get("relationships", [])]
    return "\nUNION ALL\n".join(parts)


@workload("run_checks", "D01 D02 D03", layered(_checks_sql()))
def _(spark, d):
    return quality.run_checks(b.stored_models(spark, d))


@workload(
    "not_null_failures",
    "D01",
    layered("""
SELECT 'name' AS column_name, count(*) FILTER (WHERE name IS NULL) AS failures FROM raw_games
UNION ALL SELECT 'review_score', count(*) FILTER (WHERE review_score IS NULL) FROM raw_games"""),
)
def _(spark, d):
    return quality.not_null(b.raw_games(spark, d), ["appid", "name", "type", "review_score"])


@workload(
    "duplicate_review_ids",
    "D02",
    layered("SELECT review_id, count(*) AS copies FROM stg_reviews GROUP BY review_id HAVING count(*) > 1"),
)
def _(spark, d):
    return quality.unique(warehouse.stg_reviews(b.raw_reviews(spark, d)), "review_id")


@workload(
    "orphan_reviews",
    "D03",
    layered("""
SELECT game_id, count(*) AS failures FROM stg_reviews
WHERE game_id NOT IN (SELECT game_id FROM stg_games) GROUP BY game_id"""),
)
def _(spark, d):
    reviews = warehouse.stg_reviews(b.raw_reviews(spark, d))
    return quality.relationships(reviews, "game_id", warehouse.stg_games(b.raw_games(spark, d)), "game_id")


def _quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


@workload(
    "unaccepted_score_descriptions",
    "V05",
    layered(f"""
SELECT review_score_desc AS value, count(*) AS failures FROM raw_games
WHERE review_score_desc NOT IN ({_quoted(REVIEW_SCORE_DESCRIPTIONS)}) GROUP BY 1"""),
)
def _(spark, d):
    return quality.accepted_values(b.raw_games(spark, d), "review_score_desc", REVIEW_SCORE_DESCRIPTIONS)


@workload(
    "unaccepted_genres",
    "V05",
    layered(f"""
SELECT value, count(*) AS failures FROM (SELECT unnest(genres) AS value FROM raw_games)
WHERE value NOT IN ({_quoted(GENRES)}) GROUP BY 1"""),
)
def _(spark, d):
    vocabulary = spark.createDataFrame([(g,) for g in GENRES], "genre string")
    return quality.accepted_values(b.raw_games(spark, d), "genres", vocabulary)


@workload(
    "unaccepted_categories",
    "V05",
    layered(f"""
SELECT value, count(*) AS failures FROM (SELECT unnest(categories) AS value FROM raw_games)
WHERE value NOT IN ({_quoted(CATEGORIES)}) GROUP BY 1"""),
)
def _(spark, d):
    vocabulary = spark.createDataFrame([(c,) for c in CATEGORIES], "category string")
    return quality.accepted_values(b.raw_games(spark, d), "categories", vocabulary)
