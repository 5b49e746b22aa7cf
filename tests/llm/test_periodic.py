import random
import re

import numpy as np
import pytest

from ludolytics.llm import periodic
from ludolytics.llm.common import mix


def brute(words):
    """(start, length, period) of all runs, by comparing each word with the one each lag later."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            first = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - first
            own = words[first : first + size]
            if size >= max(6, 4 * q) and not any(own[d:] == own[: size - d] for d in range(1, q)):
                out.append((first, size, q))
    return sorted(out)


def without(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def random_words(rng):
    words = []
    for _ in range(rng.randint(0, 4)):
        words += [rng.randrange(rng.choice([2, 3, 30])) for _ in range(rng.randint(0, 20))]
        period = [rng.randrange(rng.choice([1, 2, 4, 50])) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 24, 33, 40]))]
        words += (period * 8)[: int(len(period) * rng.choice([2, 3.9, 4, 4.2, 5, 7]))]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = 99
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [random_words(rng) for _ in range(rng.randint(1, 5))]
        x = mix(np.array([w for t in texts for w in t], dtype=np.uint64))
        want = [(k, *r) for k, t in enumerate(texts) for r in brute(t)]
        assert periodic.find_runs(x, np.cumsum([0, *map(len, texts)])) == want


@pytest.mark.parametrize("period", [1, 7, 8, 9, 16, 17, 100, 1000, 5000])
def test_a_run_of_any_period_is_seen(period):
    rng = random.Random(period)
    words = list(range(10_000, 10_037)) + [rng.randrange(period) for _ in range(period)] * 4 + [77_777, 88_888]
    x = mix(np.array(words, dtype=np.uint64))
    found = [r for r in periodic.find_runs(x, np.array([0, len(x)])) if r[2] >= 4 * r[3]]
    if period >= 2:
        assert any(s <= 37 and s + n >= 37 + 4 * period for _, s, n, q in found if period % q == 0)
    else:
        assert found == []  # four words are too short a run


def test_rows(spark, documents, odd):
    rng = random.Random(9)
    rows = odd + [(100 + k, " ".join(f"w{w}" for w in random_words(rng))) for k in range(60)]
    rows += [(200, "Tick tick " * 30), (201, "\ttick" * 30 + "\n"), (202, " a b " * 9 + "\x1c" * 3)]
    got = sorted(map(tuple, periodic.periodic_runs(documents(rows)).collect()), key=repr)
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute(words) if len(words) < 3000 else []
        want.append((i, len(words), runs, " ".join(without(words, runs))))
    assert [(i, n, [tuple(r) for r in runs], c) for i, n, runs, c in got] == sorted(want, key=repr)


def test_empty_table(documents):
    assert periodic.periodic_runs(documents([])).collect() == []
