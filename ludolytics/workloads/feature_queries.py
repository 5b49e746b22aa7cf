"""Monthly metrics, feature tables, training rows and as-of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ludolytics.operators.asof import asof_at, asof_by_interval, asof_join
from ludolytics.plans import features
from ludolytics.session import scratch_path
from ludolytics.sources.readers import load_data
from ludolytics.workloads import bindings as b
from ludolytics.workloads.oracle import FACT_SELECT, GAME_SELECT, METRIC_SELECT, NULLABLE, day, items, layered, ts
from ludolytics.workloads.registry import workload

FIRST, SECOND, THIRD = "1998-05-01", "1998-06-01", "1998-07-01"


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@workload(
    "monthly_game_metrics",
    "X02 G06 W02 W03 W04 F04 F08 F09 F24",
    layered(f"SELECT game_id, {day('game_review_month')} AS game_review_month, {METRIC_SELECT} FROM monthly_game_metrics"),
)
def _(spark, d):
    facts = b.stored_models(spark, d)["fact_reviews"]
    return _rounded(features.monthly_game_metrics(facts), "game_weighted_score")


@workload(
    "game_features",
    "X03 J08",
    layered(f"""
SELECT {GAME_SELECT}, {day('game_review_month')} AS game_review_month, {METRIC_SELECT}
FROM game_features WHERE game_review_month = DATE '{SECOND}'"""),
    NULLABLE,
)
def _(spark, d):
    m = b.stored_models(spark, d)
    metrics = features.monthly_game_metrics(m["fact_reviews"])
    return _rounded(features.game_features(metrics, m["dim_games"], SECOND), "game_weighted_score")


def _active(month: str, name: str) -> str:
    return f"""
liked AS (SELECT user_id, game_id, CAST(date_trunc('month', timestamp_created) AS DATE) AS m
          FROM fact_reviews WHERE voted_up),
everything AS (SELECT user_id, list(game_id ORDER BY game_id) AS all_ids FROM liked GROUP BY user_id),
{name} AS (SELECT l.user_id, list(l.game_id ORDER BY l.game_id) AS monthly_ids, any_value(e.all_ids) AS all_ids
           FROM liked l JOIN everything e ON l.user_id = e.user_id WHERE l.m = DATE '{month}' GROUP BY l.user_id)"""


_USER_LISTS = f"""
user_id, {items('monthly_game_ids')} AS monthly_game_ids, {items('past_game_ids')} AS past_game_ids,
{items('all_game_ids')} AS all_game_ids, {items('future_game_ids')} AS future_game_ids,
{day('current_month')} AS current_month
"""


@workload(
    "user_features_first_month",
    "X04 W05 G07 P12 F18 F20",
    layered(
        f"""
SELECT {_USER_LISTS} FROM (
  SELECT user_id, monthly_ids AS monthly_game_ids, CAST([] AS BIGINT[]) AS past_game_ids,
         all_ids AS all_game_ids, all_ids AS future_game_ids, DATE '{FIRST}' AS current_month FROM active)""",
        _active(FIRST, "active"),
    ),
)
def _(spark, d):
    return features.user_features(b.stored_models(spark, d)["fact_reviews"], FIRST)


_BEFORE = f"""
before AS (SELECT user_id, list(game_id ORDER BY game_id) AS monthly_ids FROM liked
           WHERE m = DATE '{FIRST}' GROUP BY user_id)"""


@workload(
    "user_features_next_month",
    "X04 J12 F19",
    layered(
        f"""
SELECT {_USER_LISTS} FROM (
  SELECT *, list_filter(all_game_ids, lambda x: NOT list_contains(past_game_ids, x)) AS future_game_ids
  FROM (SELECT a.user_id, a.monthly_ids AS monthly_game_ids,
               coalesce(p.monthly_ids, CAST([] AS BIGINT[])) AS past_game_ids,
               a.all_ids AS all_game_ids, DATE '{SECOND}' AS current_month
        FROM active a LEFT JOIN before p ON a.user_id = p.user_id))""",
        _active(SECOND, "active") + "," + _BEFORE,
    ),
)
def _(spark, d):
    facts = b.stored_models(spark, d)["fact_reviews"]
    return features.user_features(facts, SECOND, features.user_features(facts, FIRST))


@workload(
    "user_features_accumulated",
    "X04",
    layered(
        f"""
SELECT {_USER_LISTS} FROM (
  SELECT *, list_filter(all_game_ids, lambda x: NOT list_contains(past_game_ids, x)) AS future_game_ids
  FROM (SELECT e.user_id, coalesce(a.monthly_ids, CAST([] AS BIGINT[])) AS monthly_game_ids,
               coalesce(p.past_ids, CAST([] AS BIGINT[])) AS past_game_ids, e.all_ids AS all_game_ids,
               DATE '{SECOND}' AS current_month
        FROM everything e LEFT JOIN active a ON e.user_id = a.user_id
        LEFT JOIN (SELECT user_id, list(game_id ORDER BY game_id) AS past_ids
                   FROM (SELECT DISTINCT user_id, game_id FROM liked WHERE m = DATE '{FIRST}')
                   GROUP BY user_id) p ON e.user_id = p.user_id
        WHERE a.user_id IS NOT NULL OR p.user_id IS NOT NULL))""",
        _active(SECOND, "active"),
    ),
)
def _(spark, d):
    facts = b.stored_models(spark, d)["fact_reviews"]
    return features.user_features(facts, SECOND, features.user_features(facts, FIRST), "accumulate")


@workload(
    "future_rows",
    "X04",
    layered(
        f"""
SELECT l.user_id, l.game_id, count(*) AS copies FROM liked l
WHERE l.user_id IN (SELECT user_id FROM active)
  AND NOT EXISTS (SELECT 1 FROM liked o WHERE o.user_id = l.user_id AND o.game_id = l.game_id AND o.m = DATE '{FIRST}')
GROUP BY l.user_id, l.game_id""",
        _active(SECOND, "active"),
    ),
)
def _(spark, d):
    return features.future_rows(features.user_interactions(b.stored_models(spark, d)["fact_reviews"]), SECOND)


_packed = ", ".join(
    f"{c} := {c}"
    for c in (
        "game_num_reviews", "game_num_positive_reviews", "game_num_negative_reviews", "game_cum_num_reviews",
        "game_cum_num_positive_reviews", "game_cum_num_negative_reviews", "game_weighted_score",
    )
)


def _training_sql(month: str, past: str) -> str:
    return f"""
SELECT {FACT_SELECT}, {day('current_month')} AS current_month, {day('prev_month')} AS prev_month,
       {', '.join(c.strip() for c in GAME_SELECT.split('game_id, ', 1)[1:])},
       coalesce(game_num_reviews, 0) AS game_num_reviews,
       coalesce(game_num_positive_reviews, 0) AS game_num_positive_reviews,
       coalesce(game_num_negative_reviews, 0) AS game_num_negative_reviews,
       coalesce(game_cum_num_reviews, 0) AS game_cum_num_reviews,
       coalesce(game_cum_num_positive_reviews, 0) AS game_cum_num_positive_reviews,
       coalesce(game_cum_num_negative_reviews, 0) AS game_cum_num_negative_reviews,
       round(game_weighted_score, 9) AS game_weighted_score, {items('past_game_ids')} AS past_game_ids
FROM (SELECT *, DATE '{month}' AS current_month, CAST(DATE '{month}' - INTERVAL 1 MONTH AS DATE) AS prev_month
      FROM fact_reviews WHERE date_trunc('month', timestamp_created) = DATE '{month}')
LEFT JOIN dim_games USING (game_id)
LEFT JOIN (SELECT game_id, unnest(arg_max(newest, game_review_month)) FROM (
             SELECT game_id, game_review_month, struct_pack({_packed}) AS newest FROM monthly_game_metrics
             WHERE game_review_month < DATE '{month}') GROUP BY game_id) USING (game_id)
LEFT JOIN (SELECT user_id, arg_min(past_game_ids, current_month) AS past_game_ids FROM ({past})
           WHERE current_month >= DATE '{month}' - INTERVAL 1 MONTH GROUP BY user_id) USING (user_id)"""


_TWO_MONTHS = f"""
SELECT user_id, DATE '{FIRST}' AS current_month, CAST([] AS BIGINT[]) AS past_game_ids
FROM liked WHERE m = DATE '{FIRST}' GROUP BY user_id
UNION ALL
SELECT a.user_id, DATE '{SECOND}', coalesce(p.monthly_ids, CAST([] AS BIGINT[]))
FROM active a LEFT JOIN before p ON a.user_id = p.user_id"""


@workload(
    "training_features",
    "X05 J09 J10 J11 P09 P10 P11 F05",
    layered(_training_sql(SECOND, _TWO_MONTHS), _active(SECOND, "active") + "," + _BEFORE),
    NULLABLE,
)
def _(spark, d):
    m = b.stored_models(spark, d)
    facts = m["fact_reviews"]
    first = features.user_features(facts, FIRST)
    users = first.unionByName(features.user_features(facts, SECOND, first))
    out = features.training_features(facts, features.monthly_game_metrics(facts), m["dim_games"], users, SECOND)
    return _rounded(out, "game_weighted_score")


@workload(
    "monthly_backfill",
    "X06 S09 S13",
    layered(
        f"""
{_training_sql(FIRST, f"SELECT user_id, DATE '{FIRST}' AS current_month, CAST([] AS BIGINT[]) AS past_game_ids FROM liked WHERE m = DATE '{FIRST}' GROUP BY user_id")}
UNION ALL
{_training_sql(SECOND, _TWO_MONTHS)}""",
        _active(SECOND, "active") + "," + _BEFORE,
    ),
    NULLABLE,
)
def _(spark, d):
    m = b.stored_models(spark, d)
    root = scratch_path(spark, "features")
    paths = {name: f"{root}/{name}" for name in ("metrics", "game", "user", "reviews")}
    features.backfill(spark, m["fact_reviews"], m["dim_games"], FIRST, THIRD, paths)
    return _rounded(load_data(spark, paths, SECOND, "reviews"), "game_weighted_score")


# ---- as-of joins over the event stream: nearest purchase of the same user

_EVENT_PARTS = """
asked AS (SELECT event_id, user_id, ts FROM events),
bought AS (SELECT user_id, ts AS bought_at, any_value(value) AS amount FROM events
           WHERE event_type = 'purchase' GROUP BY user_id, ts)"""


def _events(spark, d):
    events = b.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    asked = events.select("event_id", "user_id", "ts")
    bought = events.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("bought_at")).agg(
        F.any_value("value").alias("amount")
    )
    return asked, bought


def _asof_sql(condition: str) -> str:
    return f"""
WITH {_EVENT_PARTS.strip()}
SELECT event_id, l.user_id, {ts('l.ts')} AS ts, {ts('r.bought_at')} AS bought_at, amount
FROM asked l ASOF LEFT JOIN bought r ON l.user_id = r.user_id AND {condition}"""


@workload("asof_backward", "J09", _asof_sql("r.bought_at <= l.ts"))
def _(spark, d):
    return asof_join(*_events(spark, d), ["user_id"], "ts", "bought_at")


@workload("asof_forward", "J10", _asof_sql("l.ts <= r.bought_at"))
def _(spark, d):
    return asof_join(*_events(spark, d), ["user_id"], "ts", "bought_at", "forward")


@workload("asof_backward_sliced", "J09", _asof_sql("r.bought_at <= l.ts"))
def _(spark, d):
    return asof_join(*_events(spark, d), ["user_id"], "ts", "bought_at", slice_seconds=86_400)


@workload("asof_forward_sliced", "J10", _asof_sql("l.ts <= r.bought_at"))
def _(spark, d):
    return asof_join(*_events(spark, d), ["user_id"], "ts", "bought_at", "forward", slice_seconds=86_400)


@workload("asof_by_interval", "J09", _asof_sql("r.bought_at <= l.ts"))
def _(spark, d):
    return asof_by_interval(*_events(spark, d), ["user_id"], "ts", "bought_at")


@workload(
    "asof_at_fixed_time",
    "J09 J10",
    f"""
WITH {_EVENT_PARTS.strip()}
SELECT user_id, {ts("arg_max(bought_at, bought_at)")} AS bought_at, arg_max(amount, bought_at) AS amount
FROM bought WHERE bought_at <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY user_id""",
)
def _(spark, d):
    return asof_at(_events(spark, d)[1], ["user_id"], "bought_at", F.lit("2024-01-15").cast("timestamp"))
