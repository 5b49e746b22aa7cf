"""Explicit schemas of landed files, state and serving tables."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, BOOL, TEXT, DATE, TS, INT = (
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.StringType(),
    T.DateType(),
    T.TimestampType(),
    T.IntegerType(),
)
TEXTS = T.ArrayType(TEXT)
LONGS = T.ArrayType(LONG)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


GAMES = _struct(
    appid=LONG,
    name=TEXT,
    type=TEXT,
    required_age=LONG,
    is_free=BOOL,
    minimum_pc_requirements=TEXT,
    recommended_pc_requirements=TEXT,
    controller_support=TEXT,
    detailed_description=TEXT,
    about_the_game=TEXT,
    short_description=TEXT,
    supported_languages=TEXTS,
    header_image=TEXT,
    developers=TEXTS,
    publishers=TEXTS,
    price=DOUBLE,
    categories=TEXTS,
    genres=TEXTS,
    windows_support=BOOL,
    mac_support=BOOL,
    linux_support=BOOL,
    release_date=TEXT,
    coming_soon=BOOL,
    recommendations=LONG,
    dlc=LONGS,
    review_score=LONG,
    review_score_desc=TEXT,
    scrape_date=DATE,
)

REVIEWS = _struct(
    rec_id=LONG,
    author_id=LONG,
    appid=LONG,
    playtime_forever=LONG,
    playtime_last_two_weeks=LONG,
    playtime_at_review=LONG,
    num_games_owned=LONG,
    num_reviews=LONG,
    last_played=LONG,
    language=TEXT,
    review=TEXT,
    timestamp_created=LONG,
    timestamp_updated=LONG,
    voted_up=BOOL,
    votes_up=LONG,
    votes_funny=LONG,
    weighted_vote_score=DOUBLE,
    comment_count=LONG,
    steam_purchase=BOOL,
    received_for_free=BOOL,
    written_during_early_access=BOOL,
    primarily_steam_deck=BOOL,
    scrape_date=DATE,
)

APP_IDS = _struct(appid=LONG, name=TEXT)

WATERMARKS = _struct(game_id=LONG, last_processed_timestamp=TS)

USER_FEATURES = _struct(
    user_id=LONG,
    monthly_game_ids=LONGS,
    past_game_ids=LONGS,
    all_game_ids=LONGS,
    future_game_ids=LONGS,
    current_month=DATE,
)

# landed JSON bodies; only the fields the typed rows need
_AUTHOR = _struct(
    steamid=TEXT,
    playtime_forever=LONG,
    playtime_last_two_weeks=LONG,
    playtime_at_review=LONG,
    num_games_owned=LONG,
    num_reviews=LONG,
    last_played=LONG,
)

REVIEW_BODY = _struct(
    recommendationid=TEXT,
    author=_AUTHOR,
    language=TEXT,
    review=TEXT,
    timestamp_created=LONG,
    timestamp_updated=LONG,
    voted_up=BOOL,
    votes_up=LONG,
    votes_funny=LONG,
    weighted_vote_score=TEXT,
    comment_count=LONG,
    steam_purchase=BOOL,
    received_for_free=BOOL,
    written_during_early_access=BOOL,
    primarily_steam_deck=BOOL,
)

_LABELLED = T.ArrayType(_struct(description=TEXT))

GAME_BODY = _struct(
    success=BOOL,
    data=_struct(
        name=TEXT,
        type=TEXT,
        required_age=TEXT,
        is_free=BOOL,
        # an app without requirements sends an empty list here, so keep the
        # raw text and parse it separately
        pc_requirements=TEXT,
        controller_support=TEXT,
        detailed_description=TEXT,
        about_the_game=TEXT,
        short_description=TEXT,
        supported_languages=TEXT,
        header_image=TEXT,
        developers=TEXTS,
        publishers=TEXTS,
        price_overview=_struct(initial=LONG),
        recommendations=_struct(total=LONG),
        categories=_LABELLED,
        genres=_LABELLED,
        platforms=_struct(windows=BOOL, mac=BOOL, linux=BOOL),
        release_date=_struct(date=TEXT, coming_soon=BOOL),
        dlc=LONGS,
    ),
)

PC_REQUIREMENTS = _struct(minimum=TEXT, recommended=TEXT)

REVIEW_PAGE = _struct(
    reviews=T.ArrayType(TEXT),
    query_summary=_struct(review_score=LONG, review_score_desc=TEXT),
)

APP_LIST = _struct(applist=_struct(apps=T.ArrayType(_struct(appid=LONG, name=TEXT))))

SERVING_GAME_COLUMNS = [
    "game_id",
    "game_name",
    "game_is_free",
    "game_developers",
    "game_publishers",
    "game_categories",
    "game_genres",
    "game_steam_release_date",
    "game_release_date",
    "game_prerelease_date",
    "game_short_description",
    "game_about",
    "game_detailed_description",
    "game_scrape_date",
    "game_review_score",
    "game_review_score_description",
]
