"""Metadata search for all ready sessions in one plan.

Sessions that ask for the same are one search. A search is driven by one of its list criteria (genres, categories,
developers, publishers), the one whose posting lists are shortest; the other criteria are checked on what it finds.
Developer and publisher criteria are parts of names: the names that hold them are found by their rarest short gram.

Games are ranked once by score and id, and posting lists are met in blocks of ranks, best first. A search that has its
hits leaves; the others meet the next block, which is WIDER times as large. So a search for what many games are meets a
block or two, and one for what few games are meets short lists to their end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.operators.keyed import top_rows
from ludolytics.operators.ordering import full_rank
from ludolytics.sources.writers import staged

#: Ranks of the first block, and how many times as large the next one is each time.
FIRST_BLOCK = 1_024
WIDER = 8
#: Characters of the grams that names are found by.
GRAM = 3
LISTS = {"genres": "game_genres", "categories": "game_categories", "developers": "game_developers", "publishers": "game_publishers"}
_PARTS_OF_NAMES = ("developers", "publishers")


def _listed(value: Column) -> Column:
    """The distinct values of a list criterion: a JSON list, or one value as it is; empty if there is none."""
    value = F.trim(value)
    many = F.from_json(value, "array<string>")
    values = F.when(value.startswith("["), many).when(value != "", F.array(value))
    values = F.filter(values, lambda x: x.isNotNull() & (x != ""))
    return F.array_sort(F.array_distinct(F.coalesce(values, F.expr("cast(array() AS array<string>)"))))


def criteria(ready: DataFrame) -> DataFrame:
    """(session_id, search, genres, …, score_min, described) of sessions with a list criterion; equal ones share ``search``.

    Takes (session_id, preferences). Dates and scores that cannot be read, empty values and a least score of 0 ask for
    nothing. A session without a list criterion gives no row.
    """
    said = lambda key: F.try_element_at("preferences", F.lit(key))
    lists = [_listed(F.lower(said(k)) if k in _PARTS_OF_NAMES else said(k)).alias(k) for k in LISTS]
    asked = ready.select(
        "session_id",
        *lists,
        said("release_date_after").try_cast("timestamp").alias("after"),
        said("release_date_before").try_cast("timestamp").alias("before"),
        F.nullif(said("review_score_min").try_cast("bigint"), F.lit(0)).alias("score_min"),
        F.nullif(said("review_score_description"), F.lit("")).alias("described"),
    )
    asked = asked.where(sum((F.size(k) for k in LISTS), F.lit(0)) > 0)
    content = F.to_json(F.struct(*(c for c in asked.columns if c != "session_id")))
    return asked.withColumn("search", F.sha2(content.cast("binary"), 256))


def _grams(text: Column, size: Column | int) -> Column:
    size = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - size + 1
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.expr("cast(array() AS array<int>)"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, size)))


def names_with_parts(names: DataFrame, parts: DataFrame) -> DataFrame:
    """(kind, part, value): the names (kind, value) that hold each part (kind, part), ignoring case."""
    low = names.select("kind", "value", F.lower("value").alias("low")).distinct()
    own = F.flatten(F.array(*(_grams(F.col("low"), size) for size in range(1, GRAM + 1))))
    filed = staged(low.select("kind", "value", "low", F.explode(own).alias("gram")))
    counts = filed.groupBy("kind", "gram").agg(F.count("*").alias("n"))
    probes = parts.distinct().select("kind", "part", F.explode(_grams(F.col("part"), F.least(F.length("part"), F.lit(GRAM)))).alias("gram"))
    # a part with a gram that no name has is in no name
    probes = probes.join(counts, ["kind", "gram"], "left")
    rarest = probes.groupBy("kind", "part").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "gram"))["gram"].alias("gram"))
    met = rarest.join(filed, ["kind", "gram"]).where(F.contains("low", "part"))
    return met.select("kind", "part", "value").distinct()


def _postings(games: DataFrame) -> DataFrame:
    """(kind, value, rank): in what lists the games stand."""
    out = None
    for kind in LISTS:
        part = games.select(F.lit(kind).alias("kind"), F.explode(F.array_distinct(kind)).alias("value"), "rank")
        out = part if out is None else out.unionByName(part)
    return out.where("value IS NOT NULL")


def _fits() -> Column:
    """Whether a game (g_…) meets all that a search asks for."""
    overlap = lambda k: (F.size(k) == 0) | F.coalesce(F.arrays_overlap(k, f"g_{k}"), F.lit(False))

    def holds(k: str) -> Column:
        found = F.exists(f"g_{k}", lambda name: F.exists(k, lambda part: F.contains(F.lower(name), part)))
        return (F.size(k) == 0) | F.coalesce(found, F.lit(False))

    fits = overlap("genres") & overlap("categories") & holds("developers") & holds("publishers")
    for asked, found in (
        ("after", F.col("g_day") >= F.col("after")),
        ("before", F.col("g_day") <= F.col("before")),
        ("score_min", F.col("g_score") >= F.col("score_min")),
        ("described", F.col("g_described") == F.col("described")),
    ):
        fits = fits & (F.col(asked).isNull() | F.coalesce(found, F.lit(False)))
    return fits


def search_ready_sessions(games: DataFrame, folded: DataFrame, limit: int = 100) -> DataFrame:
    """(session_id, game_id, game_name, game_review_score, rank): the best scored matching games of each READY session.

    Takes the games' dimension and ``retrieval.fold_preferences``'s rows. A game matches as in
    ``retrieval.metadata_search``; ties of the score go by id. A session that has no list criterion gives no row.
    """
    asked = staged(criteria(folded.where(F.col("status") == "READY")))
    searches = asked.drop("session_id").dropDuplicates(["search"])
    known = games.where("game_review_score IS NOT NULL AND game_review_score_description IS NOT NULL")
    ranked = full_rank(known.withColumn("_all", F.lit(0)), "_all", "game_review_score", "game_id").select(
        "rank", "game_id", "game_name", "game_review_score", *(F.col(c).alias(k) for k, c in LISTS.items()),
        F.col("game_prerelease_date").alias("day"), F.col("game_review_score_description").alias("described"),
    )
    ranked = staged(ranked)
    postings = staged(_postings(ranked))
    tags = None
    for kind in LISTS:
        part = searches.select("search", F.lit(kind).alias("kind"), F.explode(kind).alias("part"))
        tags = part if tags is None else tags.unionByName(part)
    names = postings.where(F.col("kind").isin(*_PARTS_OF_NAMES)).select("kind", "value")
    parts = tags.where(F.col("kind").isin(*_PARTS_OF_NAMES)).select("kind", "part")
    named = names_with_parts(names, parts)
    whole = tags.where(~F.col("kind").isin(*_PARTS_OF_NAMES)).select("kind", "part", F.col("part").alias("value")).distinct()
    lengths = postings.groupBy("kind", "value").agg(F.count("*").alias("n"))
    values = named.unionByName(whole).join(lengths, ["kind", "value"])
    tags = staged(tags.join(values, ["kind", "part"], "left").select("search", "kind", "value", F.coalesce("n", F.lit(0)).alias("n")))
    lists = tags.groupBy("search", "kind").agg(F.sum("n").alias("n"))
    driver = lists.groupBy("search").agg(F.min(F.struct("n", "kind"))["kind"].alias("kind"))
    open_ = staged(tags.join(driver, ["search", "kind"], "left_semi").where("value IS NOT NULL").select("search", "kind", "value").distinct())
    games_of = ranked.select("rank", "game_id", "game_name", *(
        F.col(c).alias(f"g_{n}") for c, n in [("game_review_score", "score"), ("day", "day"), ("described", "described"), *((k, k) for k in LISTS)]
    ))
    total = ranked.agg(F.max("rank")).first()[0] or 0
    found, low, high = [], 0, FIRST_BLOCK
    while low < total:
        block = postings.where((F.col("rank") > low) & (F.col("rank") <= high))
        pairs = open_.join(block, ["kind", "value"]).select("search", "rank").distinct()
        near = games_of.where((F.col("rank") > low) & (F.col("rank") <= high))
        hits = pairs.join(near, "rank").join(searches, "search").where(_fits())
        found.append(staged(hits.select("search", "rank", "game_id", "game_name", F.col("g_score").alias("game_review_score"))))
        low, high = high, high + (high - low) * WIDER
        if low < total:
            so_far = found[0]
            for more in found[1:]:
                so_far = so_far.unionByName(more)
            full = so_far.groupBy("search").agg(F.count("*").alias("n")).where(F.col("n") >= limit)
            open_ = staged(open_.join(full, "search", "left_anti"))
            if open_.isEmpty():
                break
    if not found:
        none = games_of.select(F.lit("").alias("search"), "rank", "game_id", "game_name", F.col("g_score").alias("game_review_score"))
        found.append(none.limit(0))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    best = top_rows(hits.withColumnRenamed("rank", "place"), ["search"], [F.col("place")], limit, rank="rank")
    out = asked.select("session_id", "search").join(best, "search")
    return out.select("session_id", "game_id", "game_name", "game_review_score", "rank")
