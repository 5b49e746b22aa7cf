import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ludolytics.llm import importance
from llm_helpers import sentence, text


def words_of(t):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
    return re.findall(rb"[0-9a-z\x80-\xff]+", low)


def grams_of(t, longest):
    w = words_of(t)
    return [b" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def counts_of(texts, longest, buckets):
    out = [0] * buckets
    for t in texts:
        for g in grams_of(t, longest):
            out[zlib.crc32(g) % buckets] += 1
    return out


def test_hashes_equal_the_library():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 6000, dtype=np.uint8)
    starts, lengths = rng.integers(0, 5800, 2000), np.where(rng.random(2000) < 0.8, rng.integers(0, 33, 2000), rng.integers(0, 200, 2000))
    got = importance.xxhash64(data, importance._eight_bytes(data), starts, lengths)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]


def test_equal_hashes_of_other_bytes_get_other_slots(monkeypatch):
    monkeypatch.setattr(importance, "xxhash64", lambda data, eight, starts, lengths: np.full(len(starts), 5, dtype=np.uint64))
    data = np.frombuffer(b"abcabdabcxyz" + b"q" * 80 + b"q" * 79 + b"r", dtype=np.uint8)
    starts, lengths = np.array([0, 3, 6, 9, 0, 12, 92]), np.array([3, 3, 3, 3, 2, 80, 80])
    table = importance.GramTable(data, importance._eight_bytes(data), starts, lengths, 1000)
    assert table.slot[0] == table.slot[2] and len(set(table.slot.tolist())) == 6
    assert table.count[table.slot].tolist() == [2, 1, 2, 1, 1, 1, 1]
    want = [zlib.crc32(data[a : a + n].tobytes()) % 1000 for a, n in zip(starts, lengths)]
    assert table.bucket[table.slot].tolist() == want


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_counts_and_weights_equal_plain_python(spark, documents, odd, longest, monkeypatch):
    rows = odd + [(100 + k, text(k)) for k in range(30)] + [(200, "A-b\x00CÉ d" * 40), (201, "x" * 300 + " " + "中" * 200)]
    target = [sentence(k, 30) for k in range(5)] + [None, ""]
    buckets = 97
    docs, other = documents(rows), documents(list(enumerate(target)))
    counted = [importance.bucket_counts(d, "text", longest, buckets) for d in (docs, other)]
    plain = [counts_of([t for _, t in rows], longest, buckets), counts_of(target, longest, buckets)]
    for got, want in zip(counted, plain):
        assert dict(map(tuple, got.collect())) == {k: n for k, n in enumerate(want) if n}
    gain = importance.gains(*counted, buckets)
    (s, t), (ss, tt) = plain, map(sum, plain)
    assert gain.tolist() == [math.floor(1000 * math.log((b + 1) * (ss + buckets) / ((a + 1) * (tt + buckets)))) for a, b in zip(s, t)]
    got = sorted(map(tuple, importance.weights(docs, gain, longest=longest).collect()), key=repr)
    want = []
    for i, body in rows:
        own = [int(gain[zlib.crc32(g) % buckets]) for g in grams_of(body, longest)]
        want.append((i, len(words_of(body)), len(own), sum(own) // len(own) if own else 0))
    assert got == sorted(want, key=repr)


def test_draw_equals_a_sort(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([5, 19, 20, 40]), 40, rng.choice([-50, 0, 0, 300])) for k in range(900)]
    rows += [(901, 30, 30, 9000)] * 7 + [(None, 30, 30, 8000)] * 3
    weighed = spark.createDataFrame(rows, "doc_id bigint, n_words bigint, n_features bigint, weight bigint").repartition(5)
    got = importance.draw(weighed, percent=10, least_words=20).collect()

    def score(i, weight):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        return weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    fits = sorted((-score(i, w), i is None, i or 0) for i, n, _, w in rows if n >= 20)
    want = [(-s, None if none else i, k + 1) for k, (s, none, i) in enumerate(fits[: len(fits) * 10 // 100])]
    assert len(got) == len(rows) and all(r["score"] == score(r["doc_id"], r["weight"]) for r in got)
    assert sorted((r["rank"], r["score"], r["doc_id"]) for r in got if r["rank"]) == [(k, s, i) for s, i, k in want]


def test_nothing_to_draw(spark, documents):
    kinds = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    assert importance.draw(spark.createDataFrame([], kinds)).collect() == []
    few = importance.draw(spark.createDataFrame([(1, 3, 3, 7), (2, 25, 25, 1)], kinds)).collect()
    assert [r["rank"] for r in few] == [None, None]
    assert importance.gains(*[importance.bucket_counts(documents([]))] * 2).tolist() == [0] * importance.BUCKETS
    assert len(list(importance._tables(pa.array([], pa.string()), 1, 10))) == 0
