"""Splits, popularity and random recommendations, ground truth and metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ludolytics.functions.dates import month_of
from ludolytics.operators.ordering import exact_sample, number_rows
from ludolytics.plans import evaluate, features, recommend
from ludolytics.session import scratch_path
from ludolytics.workloads import bindings as b
from ludolytics.workloads.feature_queries import FIRST, SECOND, THIRD
from ludolytics.workloads.oracle import FACT_SELECT, GAME_SELECT, METRIC_SELECT, NULLABLE, day, items, layered, ts
from ludolytics.workloads.registry import workload

TRAIN_UNTIL, VALIDATE_UNTIL = date(1999, 12, 31), date(2000, 12, 31)
_WINDOW = "BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"


@workload(
    "train_reviews",
    "M01 P13",
    layered(f"SELECT {FACT_SELECT} FROM fact_reviews WHERE CAST(timestamp_created AS DATE) <= DATE '1999-12-31'"),
    NULLABLE,
)
def _(spark, d):
    return recommend.train_validation(b.stored_models(spark, d)["fact_reviews"], TRAIN_UNTIL, VALIDATE_UNTIL)[0]


@workload(
    "new_users",
    "M02 P13",
    layered(f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, {ts('first_review_timestamp')} AS first_review_timestamp
FROM dim_users WHERE CAST(first_review_timestamp AS DATE) > DATE '1995-01-31'
  AND CAST(first_review_timestamp AS DATE) <= DATE '1996-12-31'"""),
    NULLABLE,
)
def _(spark, d):
    users = b.stored_models(spark, d)["dim_users"]
    return recommend.new_entities(users, "first_review_timestamp", date(1995, 1, 31), date(1996, 12, 31))


@workload(
    "new_games",
    "M02 P13 K01",
    layered(f"SELECT {GAME_SELECT} FROM dim_games WHERE CAST(game_prerelease_date AS DATE) > DATE '1995-01-31'"
            " AND CAST(game_prerelease_date AS DATE) <= DATE '1996-12-31'"),
    NULLABLE,
)
def _(spark, d):
    games = b.stored_models(spark, d)["dim_games"]
    return recommend.new_entities(games, "game_prerelease_date", date(1995, 1, 31), date(1996, 12, 31)).orderBy(
        "game_id"
    )


@workload(
    "validation_without_cold_start",
    "M01 M02 M03 J14",
    layered(f"""
SELECT {FACT_SELECT} FROM fact_reviews
WHERE CAST(timestamp_created AS DATE) {_WINDOW}
  AND game_id NOT IN (SELECT game_id FROM dim_games WHERE CAST(game_prerelease_date AS DATE) {_WINDOW})
  AND user_id NOT IN (SELECT user_id FROM dim_users
                      WHERE user_id IS NOT NULL AND CAST(first_review_timestamp AS DATE) {_WINDOW})"""),
    NULLABLE,
)
def _(spark, d):
    m = b.stored_models(spark, d)
    validation = recommend.train_validation(m["fact_reviews"], TRAIN_UNTIL, VALIDATE_UNTIL)[1]
    new_games = recommend.new_entities(m["dim_games"], "game_prerelease_date", TRAIN_UNTIL, VALIDATE_UNTIL)
    new_users = recommend.new_entities(m["dim_users"], "first_review_timestamp", TRAIN_UNTIL, VALIDATE_UNTIL)
    return recommend.exclude_cold_start(validation, new_games, new_users)


@workload(
    "interactions",
    "M06 P12",
    layered("SELECT user_id, game_id, 1.0::DOUBLE AS label FROM fact_reviews WHERE voted_up"),
)
def _(spark, d):
    return recommend.interactions(b.stored_models(spark, d)["fact_reviews"])


@workload(
    "min_activity",
    "M07 J15 G11",
    layered(f"""
SELECT {FACT_SELECT} FROM fact_reviews
WHERE CAST(timestamp_created AS DATE) {_WINDOW}
  AND game_id IN (SELECT game_id FROM fact_reviews WHERE CAST(timestamp_created AS DATE) <= DATE '1999-12-31'
                  GROUP BY game_id HAVING count(*) > 30)
  AND user_id IN (SELECT user_id FROM fact_reviews WHERE CAST(timestamp_created AS DATE) <= DATE '1999-12-31'
                  GROUP BY user_id HAVING count(*) > 10)"""),
    NULLABLE,
)
def _(spark, d):
    facts = b.stored_models(spark, d)["fact_reviews"]
    train, validation = recommend.train_validation(facts, TRAIN_UNTIL, VALIDATE_UNTIL)
    return recommend.min_activity(validation, *recommend.active_keys(train, 30, 10))


@workload(
    "busiest_games",
    "G11 K01",
    layered("SELECT game_id, count(*) AS reviews FROM fact_reviews GROUP BY game_id HAVING count(*) > 30"),
)
def _(spark, d):
    games, _ = recommend.active_keys(b.stored_models(spark, d)["fact_reviews"], 30, 10)
    return games.orderBy(F.col("reviews").desc(), "game_id")


def _game_features(m):
    return features.monthly_game_metrics(m["fact_reviews"])


@workload(
    "fit_popularity",
    "M09 W06",
    layered(f"""
SELECT game_id, {day('game_review_month')} AS game_review_month, {METRIC_SELECT},
       row_number() OVER (PARTITION BY game_review_month
                          ORDER BY game_num_positive_reviews DESC, game_id) AS rank
FROM monthly_game_metrics"""),
)
def _(spark, d):
    m = b.stored_models(spark, d)
    ranked = recommend.fit_popularity(_game_features(m))
    return ranked.withColumn("game_weighted_score", F.round("game_weighted_score", 9))


_TOP = """
best AS (SELECT *, row_number() OVER (PARTITION BY game_review_month
                                      ORDER BY game_num_positive_reviews DESC, game_id) AS rank
         FROM monthly_game_metrics),
top AS (SELECT game_review_month, list(game_id ORDER BY rank) AS ids FROM best WHERE rank <= {k} GROUP BY 1)"""


@workload(
    "topk_by_month",
    "M10 K02 K03",
    layered(
        f"SELECT {day('game_review_month')} AS game_review_month, {items('ids')} AS top_game_ids FROM top",
        _TOP.format(k=10),
    ),
)
def _(spark, d):
    return recommend.topk_by_month(_game_features(b.stored_models(spark, d)))


@workload(
    "top_of_month",
    "K04",
    layered(
        "SELECT game_id, game_num_positive_reviews, rank FROM best"
        f" WHERE game_review_month = DATE '{FIRST}' AND rank <= 10",
        _TOP.format(k=10),
    ),
)
def _(spark, d):
    ranking = recommend.fit_popularity(_game_features(b.stored_models(spark, d)))
    return recommend.top_of_month(ranking, date.fromisoformat(FIRST), 10).select(
        "game_id", "game_num_positive_reviews", "rank"
    )


_ROWS = """
liked AS (SELECT DISTINCT user_id, CAST(date_trunc('month', timestamp_created) AS DATE) AS current_month
          FROM fact_reviews WHERE voted_up)"""


def _liked_months(facts):
    return facts.where("voted_up").select("user_id", month_of("timestamp_created").alias("current_month")).distinct()


@workload(
    "predict_popular",
    "M11 S18 Y01 Y02 F12",
    layered(
        f"""
SELECT user_id, {day('current_month')} AS current_month, coalesce({items('ids')}, '') AS predictions
FROM liked LEFT JOIN top ON game_review_month = CAST(current_month - INTERVAL 1 MONTH AS DATE)""",
        _TOP.format(k=10) + "," + _ROWS,
    ),
)
def _(spark, d):
    m = b.stored_models(spark, d)
    path = scratch_path(spark, "popularity")
    recommend.PopularityModel(10).fit(_game_features(m)).save(path)
    return recommend.PopularityModel(10).load(spark, path).transform(_liked_months(m["fact_reviews"]))


@workload(
    "popularity_score",
    "M08 F12",
    layered("""
SELECT f.review_id, f.game_id, coalesce(CAST(m.game_num_positive_reviews AS VARCHAR), 'none') AS score
FROM fact_reviews f LEFT JOIN monthly_game_metrics m
  ON f.game_id = m.game_id
 AND m.game_review_month = CAST(date_trunc('month', f.timestamp_created) - INTERVAL 1 MONTH AS DATE)"""),
)
def _(spark, d):
    m = b.stored_models(spark, d)
    rows = m["fact_reviews"].select("review_id", "game_id", "timestamp_created")
    scored = recommend.popularity_score(rows, _game_features(m), "timestamp_created")
    return scored.select("review_id", "game_id", F.coalesce(F.col("score").cast("string"), F.lit("none")).alias("score"))


# ---- random recommendations: the draw is a hash, so SQL can repeat it


def _random_sql(k: int, seed: int) -> str:
    steps = f"""
numbered AS (SELECT game_id, row_number() OVER (ORDER BY md5('{seed}|' || game_id)) - 1 AS position
             FROM (SELECT DISTINCT game_id FROM monthly_game_metrics)),
size AS (SELECT count(*) AS n FROM numbered),
draw0 AS (SELECT user_id, current_month, md5('{seed}|' || user_id || '|' || current_month) AS key,
                 CAST([] AS BIGINT[]) AS taken FROM liked)"""
    for i in range(k):
        steps += f""",
draw{i + 1} AS (
  SELECT user_id, current_month, key,
         list_append(taken, CASE WHEN list_contains(taken, drawn) THEN j ELSE drawn END) AS taken
  FROM (SELECT *, CAST('0x' || substr(md5(key || '|' || j), 1, 12) AS BIGINT) % (j + 1) AS drawn
        FROM (SELECT d.*, n - {k} + {i} AS j FROM draw{i} d, size)))"""
    return layered(
        f"""
SELECT user_id, {day('current_month')} AS current_month, array_to_string(list(game_id ORDER BY o), ',') AS predictions
FROM (SELECT user_id, current_month, unnest(taken) AS position, generate_subscripts(taken, 1) AS o FROM draw{k}) t
JOIN numbered USING (position) GROUP BY user_id, current_month""",
        _ROWS + "," + steps,
    )


@workload("recommend_random", "M12 K08 K09", _random_sql(5, 7))
def _(spark, d):
    m = b.stored_models(spark, d)
    games = recommend.distinct_games(_game_features(m))
    return recommend.recommend_random(
        _liked_months(m["fact_reviews"]), games, ["user_id", "current_month"], k=5, seed=7
    )


@workload(
    "number_rows",
    "M12",
    "SELECT o_orderkey, row_number() OVER (ORDER BY md5('11|' || o_orderkey)) - 1 AS position FROM orders",
)
def _(spark, d):
    return number_rows(b.table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 11)


@workload(
    "exact_sample",
    "K07 K08",
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5('42|' || o_orderkey) LIMIT 1000""",
)
def _(spark, d):
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return exact_sample(orders, 1000, ["o_orderkey"], 42)


# ---- ground truth

_TRUTH = """
tf AS (SELECT user_id, game_id, CAST(date_trunc('month', timestamp_created) AS DATE) AS current_month
       FROM fact_reviews WHERE voted_up),
anchors AS (SELECT DISTINCT user_id, current_month FROM tf WHERE year(current_month) = 1998),
pairs AS (SELECT a.user_id, a.current_month, t.game_id, min(t.current_month) AS first_month
          FROM anchors a JOIN tf t ON t.user_id = a.user_id AND t.current_month >= a.current_month
          GROUP BY 1, 2, 3),
truth AS (SELECT user_id, current_month, list(game_id ORDER BY first_month, game_id) AS future_game_ids
          FROM pairs GROUP BY 1, 2)"""


def _truth(facts):
    rows = facts.withColumn("current_month", month_of("timestamp_created"))
    return recommend.future_ground_truth_of_year(rows, 1998)


@workload(
    "future_ground_truth",
    "M13 M15 G08 G09 F10 P14 K06",
    layered(
        f"SELECT user_id, {day('current_month')} AS current_month, {items('future_game_ids')} AS future_game_ids"
        " FROM truth",
        _TRUTH,
    ),
)
def _(spark, d):
    return _truth(b.stored_models(spark, d)["fact_reviews"]).orderBy("user_id", "current_month")


@workload(
    "all_time_ground_truth",
    "M14 G10",
    layered(
        f"""
SELECT user_id, {items('ids')} AS future_game_ids
FROM (SELECT user_id, flatten(list(future_game_ids ORDER BY current_month)) AS ids FROM truth GROUP BY user_id)""",
        _TRUTH,
    ),
)
def _(spark, d):
    return recommend.all_time_ground_truth(_truth(b.stored_models(spark, d)["fact_reviews"])).orderBy("user_id")


# ---- metrics

KS = (5, 10)


def _metric_parts(rows: str, keys: str) -> str:
    """Per-row metrics over ``rows`` (keys, truth, recs), recs without repeats."""
    per_k = ",\n".join(
        f"""
  CASE WHEN count(*) FILTER (WHERE good AND pos <= {k}) > 0 THEN 1 ELSE 0 END AS hit_at_{k},
  count(*) FILTER (WHERE good AND pos <= {k}) / {k}.0 AS precision_at_{k},
  count(*) FILTER (WHERE good AND pos <= {k}) / any_value(n_distinct) AS recall_at_{k},
  coalesce(sum(CAST(so_far AS DOUBLE) / pos) FILTER (WHERE good AND pos <= {k}), 0) / least({k}, any_value(n_all))
    AS ap_at_{k},
  coalesce(sum(1 / log2(pos + 1)) FILTER (WHERE good AND pos <= {k}), 0)
    / list_sum([1 / log2(i + 1) for i in range(1, least({k}, CAST(any_value(n_distinct) AS BIGINT)) + 1)])
    AS ndcg_at_{k}"""
        for k in KS
    )
    return f"""
shown AS (SELECT {keys}, truth, unnest(recs) AS item, generate_subscripts(recs, 1) AS pos FROM {rows}),
marked AS (SELECT {keys}, pos, list_contains(truth, item) AS good FROM shown),
counted AS (SELECT *, count(*) FILTER (WHERE good) OVER (PARTITION BY {keys} ORDER BY pos) AS so_far FROM marked),
lengths AS (SELECT {keys}, CAST(len(list_distinct(truth)) AS DOUBLE) AS n_distinct, len(truth) AS n_all FROM {rows}),
scored AS (SELECT {keys}, {per_k}
           FROM lengths LEFT JOIN counted USING ({keys}) GROUP BY {keys})"""


_OUT = {"hit": "hitrate", "precision": "precision", "recall": "recall", "ap": "map", "ndcg": "ndcg"}
_SUMMARY = ", ".join(f"round(avg({m}_at_{k}), 9) AS {o}_at_{k}" for k in KS for m, o in _OUT.items())
_ROUNDED_ROWS = ", ".join(f"round({m}_at_{k}, 9) AS {m}_at_{k}" for k in KS for m in _OUT)


def _round_all(df):
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, 9) for c in doubles})


_PREDICTED = """
judged AS (SELECT t.user_id, t.current_month, t.future_game_ids AS truth,
                  coalesce(p.ids, CAST([] AS BIGINT[])) AS recs
           FROM truth t LEFT JOIN top p
             ON p.game_review_month = CAST(t.current_month - INTERVAL 1 MONTH AS DATE))"""


def _judged(spark, d):
    m = b.stored_models(spark, d)
    top = recommend.topk_by_month(_game_features(m), 10)
    return recommend.predict_popular(_truth(m["fact_reviews"]), top)


@workload(
    "row_metrics",
    "M16 M17 M19 M20 M21 U03",
    layered(
        f"SELECT user_id, {day('current_month')} AS current_month, {_ROUNDED_ROWS} FROM scored",
        ",".join([_TRUTH, _TOP.format(k=10), _PREDICTED, _metric_parts("judged", "user_id, current_month")]),
    ),
)
def _(spark, d):
    scored = evaluate.row_metrics(_judged(spark, d), "future_game_ids", "predictions", KS)
    return _round_all(scored.drop("future_game_ids", "predictions"))


_EVALUATED = layered(
    f"SELECT count(*) AS evaluated, {_SUMMARY} FROM scored",
    ",".join([_TRUTH, _TOP.format(k=10), _PREDICTED, _metric_parts("judged", "user_id, current_month")]),
)


@workload("evaluate_lists", "M16 M18 M19 M20 M21", _EVALUATED)
def _(spark, d):
    return _round_all(evaluate.evaluate_lists(_judged(spark, d), "future_game_ids", "predictions", KS))


@workload("evaluate_rows", "M16 M18 M19 M20 M21 M22", _EVALUATED)
def _(spark, d):
    keys = ["user_id", "current_month"]
    judged = _judged(spark, d)
    truth = evaluate.explode_truth(judged, keys, "future_game_ids")
    return _round_all(evaluate.evaluate_rows(truth, evaluate.explode_recs(judged, keys, "predictions"), keys, ks=KS))


@workload(
    "run_experiment",
    "M04 M22",
    layered(
        f"""
SELECT split, count(*) AS evaluated, {_SUMMARY} FROM scored GROUP BY split""",
        ",".join(
            [
                _TOP.format(k=10),
                f"""
liked AS (SELECT user_id, game_id, CAST(date_trunc('month', timestamp_created) AS DATE) AS m
          FROM fact_reviews WHERE voted_up),
uf AS (
  SELECT l.user_id, l.m AS current_month, list(game_id ORDER BY game_id) AS monthly_ids FROM liked l
  WHERE m IN (DATE '{FIRST}', DATE '{SECOND}', DATE '{THIRD}') GROUP BY 1, 2),
everything AS (SELECT user_id, list(game_id ORDER BY game_id) AS all_ids FROM liked GROUP BY user_id),
users AS (
  SELECT u.user_id, u.current_month,
         list_filter(e.all_ids, lambda x: NOT list_contains(coalesce(p.monthly_ids, CAST([] AS BIGINT[])), x)) AS truth
  FROM uf u JOIN everything e ON u.user_id = e.user_id
  LEFT JOIN uf p ON p.user_id = u.user_id AND p.current_month = CAST(u.current_month - INTERVAL 1 MONTH AS DATE)),
hashed AS (SELECT *, md5('42|' || user_id || '|' || current_month) AS h FROM users),
picked AS (
  (SELECT *, 'train' AS split FROM hashed WHERE current_month <= DATE '{SECOND}' ORDER BY h LIMIT 200)
  UNION ALL
  (SELECT *, 'eval' AS split FROM hashed WHERE current_month > DATE '{SECOND}' ORDER BY h LIMIT 100)),
judged AS (SELECT user_id, current_month, split, truth, coalesce(ids, CAST([] AS BIGINT[])) AS recs
           FROM picked LEFT JOIN top ON game_review_month = CAST(current_month - INTERVAL 1 MONTH AS DATE)
           WHERE len(truth) > 0),
{_metric_parts('judged', 'user_id, current_month, split').strip()}""",
            ]
        ),
    ),
)
def _(spark, d):
    m = b.stored_models(spark, d)
    root = scratch_path(spark, "experiment")
    paths = {name: f"{root}/{name}" for name in ("metrics", "game", "user", "reviews")}
    features.backfill(spark, m["fact_reviews"], m["dim_games"], FIRST, THIRD, paths)
    users = spark.read.parquet(paths["user"])
    metrics = spark.read.parquet(paths["metrics"])
    return _round_all(
        evaluate.run_experiment(metrics, users, date.fromisoformat(SECOND), train_size=200, test_size=100, ks=KS)
    )


@workload("factor_recommendations", "M23")
def _(spark, d):
    facts = b.stored_models(spark, d)["fact_reviews"]
    model, users, games = recommend.fit_factors(facts, rank=16, seed=42, iterations=5)
    return recommend.recommend_by_factors(model, users, games, users, k=10)
