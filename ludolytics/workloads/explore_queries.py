"""Category profiles, distributions and popularity bands over games and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ludolytics.plans import explore, features
from ludolytics.workloads import bindings as b
from ludolytics.workloads.oracle import GAME_SELECT, NULLABLE, day, layered
from ludolytics.workloads.registry import workload

_LATEST = """
newest AS (SELECT game_id, game_review_month, game_num_reviews, game_weighted_score, game_num_positive_reviews,
                  game_num_negative_reviews
           FROM monthly_game_metrics
           QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY game_review_month DESC) = 1),
latest AS (SELECT g.*, n.* EXCLUDE (game_id) FROM dim_games g JOIN newest n ON g.game_id = n.game_id)"""


def _latest(spark, d):
    m = b.stored_models(spark, d)
    metrics = features.monthly_game_metrics(m["fact_reviews"]).join(
        m["dim_games"].select("game_id", "game_scrape_date"), "game_id"
    )
    return explore.games_with_latest_metrics(m["dim_games"], metrics)


def _round_all(df, digits=9):
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


@workload(
    "games_with_latest_metrics",
    "R04 J13 K01",
    layered(
        f"""
SELECT {GAME_SELECT}, {day('game_review_month')} AS game_review_month, game_num_reviews,
       round(game_weighted_score, 9) AS game_weighted_score, game_num_positive_reviews, game_num_negative_reviews
FROM latest""",
        _LATEST,
    ),
    NULLABLE,
)
def _(spark, d):
    return _round_all(_latest(spark, d)).orderBy(F.col("game_num_reviews").desc(), "game_id")


_CATEGORIES = """
exploded AS (SELECT game_name, game_num_positive_reviews,
                    unnest(CASE WHEN len(game_developers) = 0 THEN [NULL] ELSE game_developers END) AS category
             FROM latest)"""


@workload(
    "category_profile",
    "G12",
    layered(
        """
SELECT coalesce(category, 'none') AS category, count(*) AS count,
       round(sum(game_num_positive_reviews) / count(*), 9) AS avg_pos_reviews
FROM exploded GROUP BY category""",
        _LATEST + "," + _CATEGORIES,
    ),
)
def _(spark, d):
    profile = _round_all(explore.category_profile(_latest(spark, d), "game_developers"))
    return profile.withColumn("category", F.coalesce("category", F.lit("none")))


@workload(
    "category_members",
    "G12",
    layered(
        "SELECT coalesce(category, 'none') AS category, coalesce(game_name, 'unnamed') AS game_name FROM exploded",
        _LATEST + "," + _CATEGORIES,
    ),
)
def _(spark, d):
    members = explore.category_members(_latest(spark, d), "game_developers")
    return members.select(
        F.coalesce("category", F.lit("none")).alias("category"),
        F.coalesce("game_name", F.lit("unnamed")).alias("game_name"),
    )


def _nearest(column: str, p: float) -> str:
    return f"list(({column}) ORDER BY {column})[1 + CAST(round((count({column}) - 1) * {p}) AS BIGINT)]"


@workload(
    "summary_statistics",
    "G13",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS statistic, round(CAST({expr} AS DOUBLE), 5) AS value FROM lineitem"
        for name, expr in {
            "count": "count(l_extendedprice)",
            "null_count": "count(*) - count(l_extendedprice)",
            "mean": "avg(l_extendedprice)",
            "std": "stddev_samp(l_extendedprice)",
            "min": "min(l_extendedprice)",
            "q25": _nearest("l_extendedprice", 0.25),
            "q50": _nearest("l_extendedprice", 0.5),
            "q75": _nearest("l_extendedprice", 0.75),
            "max": "max(l_extendedprice)",
        }.items()
    ),
)
def _(spark, d):
    return _round_all(explore.summary_statistics(b.table(spark, d, "lineitem"), "l_extendedprice"), 5)


_PROBS = {"q25": 0.25, "q75": 0.75, "q95": 0.95}


@workload(
    "location_statistics",
    "G14",
    f"""
SELECT round(avg(l_extendedprice), 5) AS mean, round(quantile_cont(l_extendedprice, 0.5), 5) AS median,
       {', '.join(f'{_nearest("l_extendedprice", p)} AS {n}' for n, p in _PROBS.items())}
FROM lineitem""",
)
def _(spark, d):
    return _round_all(explore.location_statistics(b.table(spark, d, "lineitem"), "l_extendedprice", _PROBS), 5)


@workload(
    "location_statistics_by_flag",
    "G14",
    f"""
SELECT l_returnflag, round(avg(l_quantity), 9) AS mean, round(quantile_cont(l_quantity, 0.5), 9) AS median,
       {', '.join(f'{_nearest("l_quantity", p)} AS {n}' for n, p in _PROBS.items())}
FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, d):
    lines = b.table(spark, d, "lineitem")
    return _round_all(explore.location_statistics(lines, "l_quantity", _PROBS, ["l_returnflag"]))


@workload(
    "five_numbers",
    "G17",
    """
SELECT l_returnflag, l_linestatus, min(l_extendedprice) AS minimum,
       round(quantile_cont(l_extendedprice, 0.25), 5) AS q1, round(quantile_cont(l_extendedprice, 0.5), 5) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 5) AS q3, max(l_extendedprice) AS maximum
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def _(spark, d):
    lines = b.table(spark, d, "lineitem")
    return _round_all(explore.five_numbers(lines, "l_extendedprice", ["l_returnflag", "l_linestatus"]), 5)


def _histogram_sql(column: str, log: bool) -> str:
    x = f"log10({column})" if log else column
    low, high = "lo + bin * (hi - lo) / 20", "lo + (bin + 1) * (hi - lo) / 20"
    if log:
        low, high = f"pow(10, {low})", f"pow(10, {high})"
    return f"""
WITH v AS (SELECT {x} AS x FROM orders WHERE {column} IS NOT NULL {f'AND {column} > 0' if log else ''}),
span AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
binned AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, lo, hi FROM v, span)
SELECT bin, round({low}, 3) AS bin_start, round({high}, 3) AS bin_end, count(*) AS count
FROM binned GROUP BY bin, lo, hi"""


@workload("histogram", "G15", _histogram_sql("o_totalprice", False))
def _(spark, d):
    return _round_all(explore.histogram(b.table(spark, d, "orders"), "o_totalprice"), 3)


@workload("histogram_log", "G15", _histogram_sql("o_totalprice", True))
def _(spark, d):
    return _round_all(explore.histogram(b.table(spark, d, "orders"), "o_totalprice", log=True), 3)


@workload(
    "kernel_density",
    "G16",
    """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, stddev_samp(o_totalprice) AS sd,
                  count(*) AS n FROM orders),
bins AS (SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 1024)), 1023) AS b, count(*) AS w
         FROM orders, s GROUP BY 1),
points AS (SELECT g, lo + g * (hi - lo) / 199 AS x, w, (lo + (b + 0.5) * (hi - lo) / 1024) AS c,
                  sd * pow(n, -0.2) AS h, n
           FROM bins, s, (SELECT unnest(range(0, 200)) AS g))
SELECT round(any_value(x), 3) AS x,
       round(sum(w * exp(-pow((x - c) / h, 2) / 2) / (n * h * sqrt(2 * pi()))) * 1e6, 6) AS density
FROM points GROUP BY g""",
)
def _(spark, d):
    density = explore.kernel_density(b.table(spark, d, "orders"), "o_totalprice")
    return density.select(F.round("x", 3).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density"))


@workload(
    "kernel_density_log",
    "G16",
    """
WITH v AS (SELECT log10(o_totalprice) AS x FROM orders WHERE o_totalprice > 0),
s AS (SELECT min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd, count(*) AS n FROM v),
bins AS (SELECT least(floor((x - lo) / ((hi - lo) / 1024)), 1023) AS b, count(*) AS w FROM v, s GROUP BY 1),
points AS (SELECT g, lo + g * (hi - lo) / 199 AS x, w, (lo + (b + 0.5) * (hi - lo) / 1024) AS c,
                  sd * pow(n, -0.2) AS h, n
           FROM bins, s, (SELECT unnest(range(0, 200)) AS g))
SELECT round(pow(10, any_value(x)), 3) AS x, round(sum(w * exp(-pow((x - c) / h, 2) / 2) / (n * h * sqrt(2 * pi()))), 6) AS density
FROM points GROUP BY g""",
)
def _(spark, d):
    density = explore.kernel_density(b.table(spark, d, "orders"), "o_totalprice", log=True)
    return density.select(F.round("x", 3).alias("x"), F.round("density", 6).alias("density"))


_BANDS = f"""
q AS (SELECT {_nearest('game_num_reviews', 0.5)} AS q50, {_nearest('game_num_reviews', 0.75)} AS q75,
             {_nearest('game_num_reviews', 0.95)} AS q95 FROM latest)"""


@workload(
    "non_text_features",
    "F11 F26",
    layered(
        """
SELECT game_id, coalesce(game_name, 'unnamed') AS game_name, round(game_weighted_score, 9) AS game_weighted_score,
       game_is_free, game_num_reviews,
       CASE WHEN game_num_reviews <= 0 THEN 'no_reviews' WHEN game_num_reviews <= q50 THEN 'low_reviews'
            WHEN game_num_reviews <= q75 THEN 'moderate_reviews' WHEN game_num_reviews <= q95 THEN 'high_reviews'
            ELSE 'very_high_reviews' END AS game_num_reviews_cat,
       round(CAST(trunc((epoch(CAST(game_review_month AS TIMESTAMP)) - epoch(game_prerelease_date)) / 86400.0) AS BIGINT)
             / 365.25, 9) AS years_since_release
FROM latest, q""",
        _LATEST + "," + _BANDS,
    ),
)
def _(spark, d):
    out = _round_all(explore.non_text_features(_latest(spark, d)))
    return out.withColumn("game_name", F.coalesce("game_name", F.lit("unnamed")))


_PRICE = f"q AS (SELECT {_nearest('l_extendedprice', 0.95)} AS q FROM lineitem)"


@workload(
    "above_quantile",
    "F27",
    f"WITH {_PRICE} SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q WHERE l_extendedprice > q",
)
def _(spark, d):
    lines = b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return explore.above_quantile(lines, "l_extendedprice", 0.95)


@workload(
    "up_to_quantile",
    "F27",
    f"WITH {_PRICE} SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q WHERE l_extendedprice <= q",
)
def _(spark, d):
    lines = b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return explore.up_to_quantile(lines, "l_extendedprice", 0.95)


@workload(
    "text_lengths",
    "F14",
    layered("""
SELECT game_id, length(game_detailed_description) AS game_detailed_description_len,
       length(game_short_description) AS game_short_description_len FROM dim_games"""),
)
def _(spark, d):
    return explore.text_lengths(b.stored_models(spark, d)["dim_games"]).select(
        "game_id", "game_detailed_description_len", "game_short_description_len"
    )


@workload("long_documents", "P16", "SELECT doc_id, n_chars FROM documents WHERE length(text) > 10000")
def _(spark, d):
    return explore.longer_than(b.table(spark, d, "documents"), "text", 10_000).select("doc_id", "n_chars")


@workload(
    "members",
    "P15",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def _(spark, d):
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return explore.members(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])
