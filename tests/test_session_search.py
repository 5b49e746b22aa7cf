import json
import random
from datetime import datetime

import pytest

from helpers import rows
from ludolytics.plans import retrieval, session_search

GAMES = (
    "game_id bigint, game_name string, game_review_score bigint, game_review_score_description string, "
    "game_genres array<string>, game_categories array<string>, game_developers array<string>, "
    "game_publishers array<string>, game_prerelease_date timestamp"
)
DESCRIBED = ["Mixed", "Mostly Positive", None]


def make_games(rng, n):
    some = lambda values, k: None if rng.random() < 0.1 else [rng.choice(values) for _ in range(rng.randint(0, k))]
    studios = ["Red Fox", "Fox", "ÉCLAIR", "Blue Oxide", "x", "Big-Ox GmbH", None]
    return [
        (k, f"g{k}", rng.choice([None, 1, 2, 3, 9]), rng.choice(DESCRIBED), some(["Action", "RPG", "Puzzle"], 3),
         some(["Co-op", "Solo"], 2), some(studios, 2), some(studios, 2), rng.choice([None, datetime(2020, 1, 1), datetime(2022, 5, 5)]))
        for k in range(n)
    ]


def make_said(rng):
    said = {"status": rng.choice(["READY", "READY", "GATHERING"])}
    choose = {
        "genres": ['["Action"]', '["RPG","Puzzle"]', "Action", "[]", "", None, '["none"]'],
        "categories": ["Solo", '["Co-op","Solo"]'],
        "developers": ["FOX", '["ox","é"]', "zzz", "x", " "],
        "publishers": ['["Fox"]', "blue", "Fox GmbH"],
        "release_date_after": ["2021-01-01", "soon", ""],
        "release_date_before": ["2021-01-01"],
        "review_score_min": ["2", "0", "many"],
        "review_score_description": ["Mixed", ""],
    }
    for key, values in choose.items():
        if rng.random() < 0.35:
            said[key] = rng.choice(values)
    return said


def listed(value):
    value = (value or "").strip()
    return [v for v in (json.loads(value) if value.startswith("[") else [value]) if v]


def brute(games, said, limit):
    lists = {k: listed(said.get(k)) for k in session_search.LISTS}
    if said["status"] != "READY" or not any(lists.values()):
        return []
    day = lambda key: datetime.fromisoformat(said[key]) if (said.get(key) or "")[:2] == "20" else None
    least = int(said["review_score_min"]) if (said.get("review_score_min") or "").isdigit() else 0
    out = []
    for i, name, score, described, genres, categories, developers, publishers, released in games:
        fits = score is not None and described is not None
        for key, own in (("genres", genres), ("categories", categories)):
            fits &= not lists[key] or bool(set(lists[key]) & set(own or []))
        for key, own in (("developers", developers), ("publishers", publishers)):
            fits &= not lists[key] or any(p.lower() in n.lower() for p in lists[key] for n in own or [] if n)
        if day("release_date_after"):
            fits &= released is not None and released >= day("release_date_after")
        if day("release_date_before"):
            fits &= released is not None and released <= day("release_date_before")
        fits &= not least or (score or 0) >= least
        fits &= not said.get("review_score_description") or described == said["review_score_description"]
        if fits:
            out.append((-score, i, name))
    return [(i, name, -score, k + 1) for k, (score, i, name) in enumerate(sorted(out)[:limit])]


@pytest.mark.parametrize("block", [3, 1024])
def test_equal_to_a_search_of_each_session(spark, monkeypatch, block):
    monkeypatch.setattr(session_search, "FIRST_BLOCK", block)
    rng = random.Random(block)
    games, sessions = make_games(rng, 150), {k: make_said(rng) for k in range(90)}
    turns = [(s, n, key, value) for s, said in sessions.items() for n, (key, value) in enumerate(said.items())]
    folded = retrieval.fold_preferences(spark.createDataFrame(turns, "session_id bigint, turn int, key string, value string"))
    got = session_search.search_ready_sessions(spark.createDataFrame(games, GAMES), folded, limit=4)
    want = [(s, *hit) for s, said in sessions.items() for hit in brute(games, said, 4)]
    assert rows(got) == sorted(want, key=repr) and len(want) > 60


def test_parts_of_names(spark):
    names = ["Red Fox", "red", "ox", "O", "", "Éclair", "aaa"]
    parts = ["red", "ox", "o", "é", "fox ", "aaa", "aaaa", "x f"]
    found = session_search.names_with_parts(
        spark.createDataFrame([("d", n) for n in names], "kind string, value string"),
        spark.createDataFrame([("d", p) for p in parts] + [("p", "red")], "kind string, part string"),
    )
    assert rows(found) == sorted([("d", p, n) for p in parts for n in names if p in n.lower()], key=repr)


def test_nothing_to_search(spark):
    turns = spark.createDataFrame([(1, 0, "status", "READY"), (1, 1, "genres", "RPG")], "session_id bigint, turn int, key string, value string")
    folded = retrieval.fold_preferences(turns)
    assert session_search.search_ready_sessions(spark.createDataFrame([], GAMES), folded).collect() == []
    games = spark.createDataFrame(make_games(random.Random(1), 20), GAMES)
    assert session_search.search_ready_sessions(games, folded.where("false")).collect() == []


def test_few_blocks_are_met_when_hits_are_many(spark, monkeypatch):
    monkeypatch.setattr(session_search, "FIRST_BLOCK", 64)
    met, own = [], session_search._fits
    monkeypatch.setattr(session_search, "_fits", lambda: met.append(1) or own())
    games = [(k, f"g{k}", 5, "Mixed", ["RPG"], [], [], [], None) for k in range(5000)]
    turns = spark.createDataFrame([(1, 0, "status", "READY"), (1, 1, "genres", "RPG")], "session_id bigint, turn int, key string, value string")
    hits = session_search.search_ready_sessions(spark.createDataFrame(games, GAMES), retrieval.fold_preferences(turns), limit=10)
    assert [r["game_id"] for r in hits.orderBy("rank").collect()] == list(range(10)) and len(met) == 1
