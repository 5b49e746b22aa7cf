import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludolytics.llm import line_dedup, near_dedup
from ludolytics.llm.common import CLEANUP, stored
from llm_helpers import WORDS, sentence, text


def brute_components(rows):
    """Least reachable id by comparing all pairs of shingle sets; rows of one id are one document."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(s), find(i) if i is not None else None) for i, s in sets]


def check(documents, rows):
    got = near_dedup.near_duplicates(documents(rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = brute_components(rows)
    assert sorted([(r[0], r[1], r[2]) for r in got], key=key) == sorted(want, key=key)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_near_copies_equal_brute_force(documents):
    rng, rows = random.Random(4), []
    for group in range(6):
        base = text(group, 12).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(50)}"
            rows.append((1000 - len(rows), " ".join(copy)))
    rows += [(2000, "five words are one shingle"), (2001, "FIVE words are one shingle"), (2002, "too few"), (2003, "Too few")]
    check(documents, rows)


def test_near_copies_of_odd_rows(documents, odd):
    check(documents, odd)


def test_near_copies_of_nothing(documents):
    assert near_dedup.near_duplicates(documents([])).count() == 0


def test_open_pairs_are_decided(documents):
    # a chain: each text is close to the next only, so one star does not link them all
    words = sentence(1, 400).split()
    rows = [(k, " ".join(words[k * 12 : k * 12 + 200])) for k in range(10)]
    check(documents, rows)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (5, 5), (7, 40)]
    got = near_dedup.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == {**{k: 0 for k in range(1, 41)}, 101: 100}


def test_bucket_keys_agree_with_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 3, 20, 400):
        base = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
        assert (near_dedup.bucket_keys(base) == near_dedup.bucket_keys(base.copy())).all()
        other = np.unique(np.append(base[: max(1, size * 9 // 10)], rng.integers(0, 2**63, size // 20, dtype=np.uint64)))
        assert (near_dedup.bucket_keys(base) == near_dedup.bucket_keys(other)).any()


def lines_of(t):
    """Sentences, the long ones cut after the word of the least checksum in each window of 18 words."""
    out, sentences = [], "[^\\n]*?(?:[^.!?\\x20\\x09-\\x0D][.!?] |[\u3002\uff01\uff1f\u061f\u0964])|[^\\n]*\\n|[^\\n]+"
    for line in re.findall(sentences, t or ""):
        words = line.split(" ")
        if len(words) < 19:
            out.append(line)
            continue
        sums = [zlib.crc32(w.encode()) for w in words]
        ends = {min(range(i, i + 18), key=lambda k: (sums[k], k)) + 1 for i in range(len(words) - 17)}
        edges = sorted({0, len(words)} | ends)
        out += [" ".join(words[x:y]) + " " * (y < len(words)) for x, y in zip(edges, edges[1:])]
    return out


def brute_lines(rows):
    """Texts without windows of 15 words and more that stood earlier, in the order of the ids."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        every = lines_of(t)
        lines = [(k, re.sub(r"[\x20\x09-\x0D]+$", "", p)) for k, p in enumerate(every)]
        lines = [(k, p, max(p.count(" ") + 1, len(p) // 10)) for k, p in lines if p]
        sums = [0]
        for _, _, w in lines:
            sums.append(sums[-1] + w)
        windows, n = set(), len(lines)
        for a in range(n):
            windows |= set([(a, b) for b in range(a + 1, n + 1) if sums[b] - sums[a] >= 15][:1])
        windows |= set([(b, n) for b in range(n - 1, -1, -1) if sums[n] - sums[b] >= 15][:1])
        if sums[-1] < 15 and sum(len(p) for _, p, _ in lines) >= line_dedup.MIN_CHARS:
            windows = {(0, n)}
        gone = set()
        for a, b in sorted(windows):
            window = tuple(p for _, p, _ in lines[a:b])
            if window in seen:
                gone.update(range(lines[a][0], lines[b - 1][0] + 1))
            seen.add(window)
        out.append((i, t if t is None else "".join(p for k, p in enumerate(every) if k not in gone), len(gone)))
    return out


def test_repeated_lines_equal_brute_force(documents):
    rng, rows = random.Random(5), []
    blocks = [text(50 + k, rng.randint(1, 6)) for k in range(8)]
    for i in range(60):
        parts = [rng.choice(blocks + [text(i, 2), "short.", "", "  "]) for _ in range(rng.randint(1, 5))]
        rows.append((i, rng.choice(["\n", ". ", "\n\n"]).join(parts)))
    got = line_dedup.without_repeats(documents(rows)).select("doc_id", "text", "removed_lines").collect()
    assert sorted(map(tuple, got)) == brute_lines(rows)
    assert sum(r["removed_lines"] for r in got) > 50


def random_passage(rng, n, stops):
    words = [f"{rng.choice(WORDS)}{rng.randrange(500)}" for _ in range(n)]
    for _ in range(stops):
        k = rng.randrange(n)
        words[k] += rng.choice([".", "!", "?", ".\n", "\n\n"])
    return " ".join(words)


@pytest.mark.parametrize("stops", [0, 1, 2, 12])
def test_no_run_of_50_words_stays_twice(documents, stops):
    """The promise itself: passages on one line, in two sentences, inside other sentences, and between others."""
    rng = random.Random(stops)
    passages = [random_passage(rng, rng.choice([50, 51, 60, 150]), stops) for _ in range(12)]
    rows = []
    for k in range(120):
        parts = [random_passage(rng, rng.randint(1, 30), rng.choice([0, 2]))]
        for _ in range(rng.randint(1, 2)):
            parts += [rng.choice(passages), random_passage(rng, rng.randint(1, 30), rng.choice([0, 2]))]
        rows.append((k, " ".join(parts)))
    rows += [(500, passages[0]), (501, passages[0].rstrip("\n") + ".")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(documents(rows)).collect()}
    seen = {}
    for k, t in sorted(got.items()):
        words = t.split()
        for i in range(len(words) - 49):
            other = seen.setdefault(tuple(words[i : i + 50]), (k, i))
            assert other == (k, i), (k, other)
    for k, t in rows:  # the first copy of all that goes stays somewhere, and little else goes
        lost = [w for w in set(t.split()) - set(got[k].split()) if not any(w in p for p in passages)]
        assert len(lost) <= 36 and not (k == 0 and lost)
    assert sum(len(t.split()) for t in got.values()) < sum(len(t.split()) for _, t in rows) - 60 * 100


def test_passages_without_spaces(documents):
    passage = "\u8fd9\u662f\u4e00\u4e2a\u5f88\u957f\u7684\u53e5\u5b50" * 20 + "\u3002"
    rows = [(k, f"\u7b2c{k}\u6bb5\u3002{passage}\u5b8c{k}") for k in range(4)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(documents(rows)).collect()}
    assert got[0] == rows[0][1] and all(got[k] == f"\u7b2c{k}\u6bb5\u3002\u5b8c{k}" for k in (1, 2, 3))


def test_lines_of_odd_ends_equal_brute_force(documents):
    """Stops of several scripts, marks, and lines of about as many words as four windows and a few more."""
    rng, rows = random.Random(9), []
    signs = ["a", "bb", "\u00e9", "\U0001f600", ".", "!", "?", "\u3002", "\uff01", "\u061f", "\u0964", " ", "\n", "\t", ". ", "w ", "\x01"]
    for k in range(400):
        rows.append((k, "".join(rng.choice(signs[: rng.choice([16, 17])]) for _ in range(rng.choice([1, 5, 40, 200])))))
    for k in range(400, 700):
        rows.append((k, " ".join(str(rng.randrange(rng.choice([3, 1000]))) for _ in range(rng.choice([*range(17, 44), 300])))))
    got = documents(rows).select("doc_id", line_dedup.pieces(F.col("text")).alias("lines")).collect()
    assert {r["doc_id"]: r["lines"] for r in got} == {k: lines_of(t) for k, t in rows}


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(k).getName() for k in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_what_was_shuffled_for_stored_rows_is_deleted(spark, documents):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    rows = stored(documents([(k, text(k)) for k in range(50)]).repartition(3).groupBy("doc_id").count(), "counts")
    for _ in range(100):  # deleted soon after
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and spark.conf.get(CLEANUP) == setting
    assert rows.count() == 50


def test_a_text_is_shuffled_once(documents):
    plan = line_dedup.without_repeats(documents([(k, text(k)) for k in range(3)]))._jdf.queryExecution().analyzed().toString()
    assert "c0, doc_id#" in plan and "c1, text#" not in plan


def test_a_column_of_the_added_name(documents):
    rows = documents([(1, text(1)), (2, text(1))], extra=False).selectExpr("*", "'x' AS removed_lines")
    got = line_dedup.without_repeats(rows)
    assert got.columns[-2:] == ["removed_lines", "removed_lines"] and sorted(r[-1] for r in got.collect())[0] == 0


def test_lines_of_odd_rows(documents, odd):
    df = documents(odd)
    got = line_dedup.without_repeats(df)
    assert got.columns == [*df.columns, "removed_lines"]
    texts = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(texts) == len(odd)
    assert (1, None) in texts and (2, "") in texts and (6, "") in texts and texts.count((5, text(5))) in (0, 2)
    assert line_dedup.without_repeats(documents([])).count() == 0


@pytest.mark.parametrize("operator", [near_dedup.near_duplicates])
def test_no_broadcast_or_cross_join_is_asked_for(documents, operator):
    plan = operator(documents([(k, text(k)) for k in range(20)]))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
