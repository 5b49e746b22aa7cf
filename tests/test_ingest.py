import json
from datetime import date, datetime

import pytest
from helpers import rows

from ludolytics import schemas
from ludolytics.plans import ingest

DAY = date(2024, 5, 1)


def details(**changes):
    data = {
        "name": "Game", "type": "game", "required_age": "18+", "is_free": False,
        "pc_requirements": {"minimum": "<b>cpu</b> 1", "recommended": ""}, "detailed_description": "<p>a<br>b</p>",
        "about_the_game": None, "short_description": "s", "supported_languages": "English<strong>*</strong>, French",
        "price_overview": {"initial": 1999, "final": 5}, "recommendations": {"total": 7},
        "categories": [{"id": 1, "description": "Co-op"}], "genres": [{"id": "2", "description": "RPG"}],
        "platforms": {"windows": True, "mac": False, "linux": False},
        "release_date": {"coming_soon": False, "date": "Jan 5, 2020"}, "developers": ["d"], "publishers": ["p"],
        "dlc": [5, 6],
    }
    data.update(changes)
    return json.dumps({"success": True, "data": {k: v for k, v in data.items() if v != "absent"}})


PAGE = json.dumps({"reviews": [{"x": 1}], "query_summary": {"review_score": 8, "review_score_desc": "Very Positive"}})


def flatten(spark, *bodies):
    landed = spark.createDataFrame([(i, d, r) for i, (d, r) in enumerate(bodies)], "appid long, details string, reviews string")
    return ingest.flatten_game_payload(landed, scrape_date=DAY)


def test_complete_game(spark):
    out = flatten(spark, (details(), PAGE))
    assert out.columns == schemas.GAMES.names
    row = out.collect()[0].asDict()
    assert row == {
        "appid": 0, "name": "Game", "type": "game", "required_age": 18, "is_free": False,
        "minimum_pc_requirements": "cpu 1", "recommended_pc_requirements": None, "controller_support": None,
        "detailed_description": "a b", "about_the_game": "", "short_description": "s",
        "supported_languages": ["English", "French"], "header_image": None, "developers": ["d"], "publishers": ["p"],
        "price": 19.99, "categories": ["Co-op"], "genres": ["RPG"], "windows_support": True, "mac_support": False,
        "linux_support": False, "release_date": "Jan 5, 2020", "coming_soon": False, "recommendations": 7,
        "dlc": [5, 6], "review_score": 8, "review_score_desc": "Very Positive", "scrape_date": DAY,
    }


def test_optional_parts(spark):
    body = details(
        price_overview="absent", recommendations="absent", developers="absent", publishers="absent", dlc="absent",
        required_age=0, pc_requirements={"recommended": "<i>gpu</i>"},
    )
    row = flatten(spark, (body, PAGE)).collect()[0]
    assert (row.price, row.recommendations, row.developers, row.publishers, row.dlc) == (None, None, [], [], [])
    assert row.required_age == 0
    assert (row.minimum_pc_requirements, row.recommended_pc_requirements) == (None, "gpu")
    assert flatten(spark, (details(required_age="all"), PAGE)).collect()[0].required_age is None


@pytest.mark.parametrize(
    "bad",
    [
        {"short_description": ""}, {"supported_languages": "absent"}, {"supported_languages": ""},
        {"pc_requirements": []}, {"pc_requirements": {}}, {"genres": []}, {"genres": "absent"}, {"categories": []},
    ],
)
def test_incomplete_games_are_left_out(spark, bad):
    assert flatten(spark, (details(**bad), PAGE)).isEmpty()


def test_failed_requests_are_left_out(spark):
    no_list = json.dumps({"query_summary": {}})
    empty_list = json.dumps({"reviews": [], "query_summary": {}})
    bodies = [(json.dumps({"success": False}), PAGE), (details(), no_list), (details(), None), (None, PAGE), ("{oops", PAGE)]
    assert flatten(spark, *bodies).isEmpty()
    assert flatten(spark, (details(), empty_list)).count() == 1


def test_app_list(spark):
    body = json.dumps({"applist": {"apps": [
        {"appid": 1, "name": " a"}, {"appid": 1, "name": " a"}, {"appid": 1, "name": "a "}, {"appid": 2, "name": "b\t"},
    ]}})
    out = ingest.parse_app_list(spark.createDataFrame([(body,)], "body string"))
    assert rows(out) == [(1, "a"), (1, "a"), (2, "b")]  # trimmed after the duplicates went


def test_review_body(spark):
    body = {
        "recommendationid": "77", "author": {"steamid": "76561197960268417", "playtime_forever": 0, "num_reviews": 3},
        "language": "english", "review": "ok", "timestamp_created": 1_700_000_000, "timestamp_updated": 1_700_000_001,
        "voted_up": True, "votes_up": 2, "votes_funny": 0, "weighted_vote_score": "0.5", "comment_count": 0,
        "steam_purchase": True, "received_for_free": False, "written_during_early_access": False,
        "primarily_steam_deck": False,
    }
    number = dict(body, weighted_vote_score=0)
    landed = spark.createDataFrame([(9, json.dumps(body)), (9, json.dumps(number))], "appid long, body string")
    out = ingest.flatten_review_payload(landed, scrape_date=DAY)
    assert out.columns == schemas.REVIEWS.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.REVIEWS]
    first, second = out.collect()
    assert (first.rec_id, first.author_id, first.appid) == (77, 76561197960268417, 9)
    assert (first.playtime_forever, first.last_played, first.num_reviews) == (None, None, 3)
    assert (first.weighted_vote_score, second.weighted_vote_score, first.votes_funny) == (0.5, 0.0, 0)


def test_cutoffs_are_per_game_and_in_whole_seconds(spark):
    state = spark.createDataFrame([(1, datetime(1970, 1, 1, 0, 1, 40, 900_000)), (3, None)], schemas.WATERMARKS)
    reviews = spark.createDataFrame(
        [(1, 1, 100), (2, 1, 101), (3, 2, 5), (4, 2, 0), (5, 3, 1)], "rec_id long, appid long, timestamp_created long"
    )
    assert rows(ingest.drop_seen(reviews, state), "rec_id") == [(2,), (3,), (5,)]
    # the newest review of game 1 is later than the state to the microsecond
    assert rows(ingest.games_with_new_reviews(reviews, state), "game_id") == [(1,), (2,), (3,)]
    assert rows(ingest.games_with_new_reviews(reviews.where("rec_id = 1"), state)) == []
    assert rows(ingest.newest_per_game(reviews.where("appid = 2"))) == [(2, datetime(1970, 1, 1, 0, 0, 5))]
