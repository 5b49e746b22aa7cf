import random

import numpy as np
import pytest

from ludolytics.llm import suffix_dedup
from llm_helpers import sentence, text

SIZE = suffix_dedup.LENGTH


def brute(rows):
    """Which bytes of each row go: those of a string of SIZE bytes that starts in a row of a smaller id too."""
    least, out = {}, []
    key = lambda i: -1 if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - SIZE + 1):
            least[b[k : k + SIZE]] = min(least.get(b[k : k + SIZE], key(i)), key(i))
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - SIZE + 1):
            if least[b[k : k + SIZE]] < key(i):
                gone[k : k + SIZE] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((i, len(b), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=repr)


def check(documents, rows):
    got = suffix_dedup.without_repeats(documents(rows).repartition(3)).collect()
    got = [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["removed"]], bytes(r["kept"])) for r in got]
    assert sorted(got, key=repr) == brute(rows)


def random_rows(rng):
    kinds = ["ab", "abc é", "中文\x00", "the old river bends past seven quiet mills".split()]
    kind = rng.choice(kinds)
    some = lambda n: ("" if isinstance(kind, str) else " ").join(rng.choice(kind) for _ in range(n))
    pool = [some(rng.randint(5, 60)) for _ in range(12)]
    rows = []
    for _ in range(rng.randint(1, 40)):
        parts = (rng.choice(pool) if rng.random() < 0.5 else some(rng.randint(1, 40)) for _ in range(rng.randint(0, 8)))
        rows.append((rng.randint(0, 30), "".join(parts)))
    return rows


@pytest.mark.parametrize("sizes", [(1 << 20, 2 << 20, 64 << 20, 2 << 20, 1 << 19), (100, 3, 900, 500, 200), (700, 1, 2000, 100, 90)])
def test_equal_to_brute_force(documents, monkeypatch, sizes):
    for name, size in zip(("SHARD_BYTES", "BUCKET_GRAMS", "BUCKET_BYTES", "MERGE_BYTES", "SORT_BYTES"), sizes):
        monkeypatch.setattr(suffix_dedup, name, size)
    rng = random.Random(sizes[0])
    rows = []
    for k in range(6):
        rows += [(100 * rng.randint(0, 2) + i, t) for i, t in random_rows(rng)]
    check(documents, rows)


def test_copies_and_passages(documents, odd):
    passage = sentence(900, 40)
    rows = [(k, text(k)) for k in range(20, 40)] + [(50 + k, text(22)) for k in range(30)]
    rows += [(100 + k, f"{sentence(k, 6)} {passage} {sentence(300 + k, 6)}") for k in range(25)]
    rows += [(200, passage[:SIZE]), (201, passage[: SIZE - 1]), (202, passage[1 : SIZE + 1] * 2)]
    check(documents, [r for r in odd if len(r[1] or "") < 5000] + rows)


def test_the_repeats_of_one_document_stay(documents):
    line = sentence(1, 20)
    check(documents, [(5, (line + "\n") * 6), (5, line), (6, "x" * 200), (7, "x" * 49), (8, "x" * 51)])


def test_frequent_grams_change_nothing(documents, monkeypatch):
    line = sentence(3, 9)
    rows = [(k, f"{sentence(10 + k, 5)} {line} {sentence(90 + k % 4, 5)}") for k in range(80)]
    want = brute(rows)
    for share in (4, 100_000):
        monkeypatch.setattr(suffix_dedup, "HOT_SHARE", share)
        check(documents, rows)
    assert any(spans for _, _, spans, _ in want)


def test_merged_rows_are_the_suffixes_in_order():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    shards, places = [], []
    for low in range(0, 40, 10):
        own = strings[low : low + 10]
        data = np.frombuffer(b"".join(s + b"\xff" for s in own), dtype=np.uint8)
        order, before, first = suffix_dedup.shard_transform(data, np.array([len(s) for s in own]))
        shards.append((before, first))
        places += [data[k:].tobytes() for k in order]
        assert [data[k - 1] for k in order] == before.tolist()
        shown = [data[k:].tobytes().split(b"\xff")[0] + b"\xff" for k in order]
        assert shown == sorted(shown)
    for length in (1, 2, 5, 8):
        rows, block = suffix_dedup.merge_shards(shards, length)
        got = [places[r][:length] for r in rows]
        every = [s[k : k + length] for s in strings for k in range(len(s) - length + 1)]
        assert got == sorted(g for g in every if every.count(g) > 1)
        assert [a == b for a, b in zip(got, got[1:])] == [a == b for a, b in zip(block, block[1:])]


def test_empty_table(documents):
    assert suffix_dedup.without_repeats(documents([])).collect() == []
