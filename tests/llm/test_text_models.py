import random
import re

import numpy as np
import public_tokenizers
import pytest

from ludolytics.llm import common, decontaminate, host_quality, lang_id, piece_bpe, toxicity
from llm_helpers import sentence, text

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_contamination(rows, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = []
    for item, t in items:
        w = cut(t)
        size = min(10, len(w))
        windows += [(item, tuple(w[k : k + size])) for k in range(len(w) - size + 1) if size]
    out = []
    for i, t in rows:
        w, hit, found = cut(t), set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found.add(item)
        out.append((i, len(w), len(hit), ",".join(sorted(str(f) for f in found if f is not None))))
    return sorted(out, key=str)


ITEMS = [(1, text(1, 3)), (2, "Only four words here"), (2, sentence(8, 10)), (3, text(1, 3)), (4, None), (5, "..."), (None, "lone-item x")]


def check_contamination(spark, documents, rows, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS items", "'x' AS item")
    found = decontaminate.find_benchmark(documents(rows), bench, keep=("lang", "hits"))
    assert found.columns[5:] == ["lang", "hits"]
    found = found.toDF("doc_id", "text", "n_words", "hits", "items", "lang", "own")
    got = [(r["doc_id"], r["n_words"], sum(h["end"] - h["start"] for h in r["hits"]), ",".join(r["items"])) for r in found.collect()]
    assert sorted(got, key=str) == brute_contamination(rows, items)


def test_contamination_equals_brute_force(spark, documents, odd):
    rng, rows = random.Random(2), []
    for k in range(40):
        words = sentence(500 + k, 30).split()
        for piece in rng.sample([text(1, 3), "ONLY four, words here!", sentence(8, 10), "lone item X", sentence(8, 9)], 2):
            own = piece.split()
            a = rng.randrange(len(own))
            words[rng.randrange(len(words)) : 0] = own[a : a + rng.randint(1, len(own))]
        rows.append((k, rng.choice([" ", "-", "\n"]).join(words)))
    check_contamination(spark, documents, rows + odd + [(50, text(1, 3))], ITEMS)


def test_contamination_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    rows = [(1, text(1, 3) + " " + sentence(8, 10)), (2, sentence(3)), (3, None)]
    check_contamination(spark, documents, rows, ITEMS)


def test_contamination_of_nothing(spark, documents):
    check_contamination(spark, documents, [], ITEMS)
    check_contamination(spark, documents, [(1, text(1))], [])


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(library):
    table, rng = piece_bpe.PieceTable(MODEL), random.Random(3)
    alphabet = [*"abcdefghijklmnopqrstuvwxyz", "the", " ", "  ", "\n", ".", ",", "==", "\u00e9", "\u4e2d", "\u2581", "\U0001f600", "\x00", "    "]
    texts = ["", " ", "  a", "aaaaaaaaaaaaaaa", "<s> </s> <0x0A>", "x" * 3000, "\u2581\u2581a "]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    pieces = [p.replace("\u2581", " ") for p in table.ids]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    ids, counts = table.encode(texts)
    for t, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert own.tolist() == library.encode(t), t
        assert table.decode(own.tolist()) == library.decode(own.tolist()), t
    for _ in range(500):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(1, 8))]
        assert table.decode(ids) == library.decode(ids), ids


def test_memory_limits_change_nothing(library, monkeypatch):
    for name, limit in (("PAIR_PLACES", 64), ("STEP_CHARS", 20)):
        monkeypatch.setattr(piece_bpe, name, limit)
    table = piece_bpe.PieceTable(MODEL)
    table.words = common.WordMemory(np.int32, places=64)
    for k in range(60):
        texts = [sentence(j) + "\n" + "y" * (k + j) for j in range(k, k + 3)]
        ids, counts = table.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t) for t in texts]


def test_words_of_one_hash_are_told_apart():
    memory, asked = common.WordMemory(np.uint16, places=256), []

    def learn(words):
        asked.extend(words)
        return np.frombuffer(b"".join(words), np.uint8).astype(np.uint16), np.array([len(w) for w in words])

    words = [b"", b"a", b"b", b"ab", b"abcdefgh", b"abcdefgh1", b"abcdefgh2", b"x" * 16, b"x" * 15 + b"y", b"a\x00", b"a"] * 3
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    for _ in range(2):
        ids, counts = memory(data, starts, ends, np.full(len(words), 7, np.uint64), learn)
        assert ids.tolist() == data.tolist() and counts.tolist() == [len(w) for w in words]
    assert sorted(asked) == sorted(set(words))


def test_pieces_of_odd_rows(documents, odd, library):
    both = piece_bpe.decode(piece_bpe.encode(documents(odd), MODEL), MODEL).collect()
    assert sorted(map(str, piece_bpe.round_trip(documents(odd), MODEL).collect())) == sorted(map(str, both))
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in odd]
    assert sorted(map(str, map(tuple, both))) == sorted(map(str, want))
    assert piece_bpe.encode(documents([]), MODEL).count() == piece_bpe.round_trip(documents([]), MODEL).count() == 0


def test_language(documents, odd, spark):
    rng = random.Random(1)
    stems = {"xx": ["kal", "mor", "tis"], "yy": ["\u00e9ro", "vun", "sli"]}
    make = lambda lang: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(20))
    rows = [(make(lang), lang) for lang in stems for _ in range(40)] + [(None, "xx"), ("kal", None)]
    model = lang_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["xx", "yy"]
    got = lang_id.predict(documents([(k, make("xx" if k % 2 else "yy")) for k in range(30)] + odd), model).collect()
    assert all(r["lang_pred"] == ("xx" if r["doc_id"] % 2 else "yy") for r in got[10:30])
    undecided = [r for r in got[30:] if r["doc_id"] in (1, 2, 3)]
    assert len(undecided) == 3 and all(r["lang_pred"] == "und" and r["score"] == 0 for r in undecided)
    assert len(got) == 30 + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    # an unseen word goes by its longest known n-grams
    assert model.predict("kalkalmortis")[0] == "xx" and model.predict("vun\u00e9rosli")[0] == "yy"
    assert model.predict("12 \u00b2 _ !")[0] == "und"
    nothing = lang_id.fit(spark.createDataFrame([], "text string, lang string"))
    assert nothing.predict("kal") == ("und", 0.0)


def test_language_scores_equal_plain_python(spark, documents):
    """The sums of the back-off written out: counts of all texts, a common floor, longest known n-grams of other words."""
    import math
    from collections import Counter

    rng = random.Random(5)
    stems = {"xx": ["kal", "mor", "tis", "po"], "yy": ["\u00e9ro", "vun", "sli", "po"]}
    make = lambda lang: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(12))
    rows = [(make(lang), lang) for lang, n in (("xx", 30), ("yy", 12)) for _ in range(n)]
    model = lang_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    words, grams = {x: Counter() for x in stems}, {x: Counter() for x in stems}
    for t, lang in rows:
        for w in t.split():
            words[lang][w] += 1
            for size in (1, 2, 3, 4):
                m = w if size == 1 else f"^{w}$"
                grams[lang].update(m[k : k + size] for k in range(len(m) - size + 1))
    totals = {x: sum(words[x].values()) for x in stems}
    floor = 0.5 / max(totals.values())
    rate = lambda counts, x, key: math.log(counts[x][key] / totals[x] + floor)

    def sums(t):
        out = dict.fromkeys(stems, 0.0)
        for w in t.lower().split():
            if any(words[x][w] for x in stems):
                keys, counts = [w], words
            else:
                counts = grams
                for size in (4, 3, 2, 1):
                    m = w if size == 1 else f"^{w}$"
                    keys = [m[k : k + size] for k in range(len(m) - size + 1)]
                    keys = [k for k in keys if any(grams[x][k] for x in stems)]
                    if keys:
                        break
            for x in stems:
                out[x] += sum(rate(counts, x, k) for k in keys) / max(1, len(keys))
        return out

    texts = [make(x) for x in "xx yy xx yy".split()] + ["kalvun poq morzz", "zzz", "vunvunvunsli KAL"]
    for t in texts:
        own = sums(t)
        best = max(own.values())
        lang, score = model.predict(t)
        assert own[lang] == pytest.approx(best) and score == pytest.approx(1 / sum(math.exp(v - best) for v in own.values()))


def test_rare_language_held_out(spark, documents, monkeypatch):
    monkeypatch.setattr(lang_id, "SAMPLE_DOCS", 60)
    rng = random.Random(12)
    stems = {"xx": ["kal", "mor", "tis", "po"], "yy": ["\u00e9ro", "vun", "sli", "po"], "zz": ["dwe", "kal", "nib", "po"]}
    make = lambda lang: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(20))
    rows = [(make(lang), lang) for lang, n in (("xx", 2000), ("yy", 1000), ("zz", 6)) for _ in range(n)]
    model = lang_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["xx", "yy", "zz"]
    got = lang_id.predict(documents([(k, make(["xx", "yy", "zz"][k % 3])) for k in range(90)]), model).collect()
    assert all(r["lang_pred"] == ["xx", "yy", "zz"][r["doc_id"] % 3] for r in got)


def test_language_backs_off_by_one_character_at_a_time():
    model = lang_id.Model(["a", "b"], {"known": np.array([0.0, -1.0])}, {"^zq": np.array([-2.0, -1.0]), "z": np.array([0.0, -9.0])})
    places = {w: model.word(w) for w in ("known", "zqx", "xz", "xx")}
    rows = {w: model.rows[k].tolist() for w, k in places.items()}
    assert rows == {"known": [0.0, -1.0], "zqx": [-2.0, -1.0], "xz": [0.0, -9.0], "xx": [0.0, 0.0]}


def test_toxicity_held_out(spark, documents, odd):
    rng = random.Random(8)
    bad = ["grumblefink", "snotwaddle", "zorgblat"]

    def make(k, toxic):
        words = sentence(k * 31, rng.randint(60, 120)).split()
        for _ in range(4 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        return " ".join(words)

    rows = [(k, make(k, k % 3 == 0)) for k in range(600)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)] + [(None, 1), (9999, None)], "doc_id bigint, toxic int")
    docs = documents(rows + [(i and i + 1000, t) for i, t in odd])
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model, keep=("text", "score")).toDF("doc_id", "s", "predicted", "text", "own").collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["s"] <= 1 and r["own"] == "x" for r in got)
    held_out = [r for r in got if r["doc_id"] is not None and 400 <= r["doc_id"] < 600]
    assert sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held_out) >= 0.97 * len(held_out)
    assert all(r["predicted"] == 0 for r in got if r["text"] in (None, "", " \n\t "))


def test_toxicity_of_a_rare_language_held_out(spark, documents):
    # one text of five is of a language whose toxic words are made of pieces that ordinary texts of it hold too
    rng = random.Random(9)
    pieces = ["kal", "mor", "tis", "vun", "sli", "ero", "pag", "dwe", "nib", "hox", "jut", "fyr"]

    def make(k, toxic):
        if k % 5:
            words = sentence(k * 31, 80).split()
            return " ".join([*words, "snotwaddle", "zorgblat"] if toxic else words)
        words = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 3))) for _ in range(80)]
        for _ in range(6 if toxic else int(rng.random() < 0.1)):
            words[rng.randrange(len(words))] = "zaqqem" + rng.choice(pieces)
        return " ".join(words)

    rows = [(k, make(k, k % 3 == 0)) for k in range(2400)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(1600)], "doc_id bigint, toxic int")
    docs = documents(rows)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).where("doc_id >= 1600").collect()
    for toxic in (True, False):
        rare = [r["predicted"] for r in got if r["doc_id"] % 5 == 0 and (r["doc_id"] % 3 == 0) == toxic]
        assert sum(p == int(toxic) for p in rare) >= 0.8 * len(rare)


def test_toxicity_scores_equal_plain_python(spark, documents, odd):
    """Windows cut one by one, compressed with each dictionary by itself, and the logistic function of what they save."""
    import math

    import zstandard

    rows = odd + [(100 + k, text(k) + (" snotwaddle zorgblat" * (k % 3))) for k in range(40)]
    labels = spark.createDataFrame([(100 + k, int(k % 3 > 0)) for k in range(40)], "doc_id bigint, toxic int")
    docs = documents(rows)
    model = toxicity.fit(docs, labels)

    def size(window, content):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(level=3, dict_data=known, **plain).compress(window))

    def score(t):
        words = (t or "").lower().split()
        data = f" {' '.join(words)} ".encode() if words else b""
        at, saved = 0, []
        while at == 0 or at < len(data) - 16:
            window = data[at : at + 64]
            saved.append(size(window, model.ordinary) - size(window, model.toxic))
            at += 48
        over = [sum(x >= k for x in saved) for k in range(1, 7)]
        given = [1.0, min(max(*saved, 0), 8), math.log(len(saved)), *map(math.log1p, over), *(math.sqrt(n / len(saved)) for n in over)]
        return 1 / (1 + math.exp(-min(max(sum(a * b for a, b in zip(given, model.weights)), -30), 30)))

    some = [r for r in rows if len(r[1] or "") < 5000]
    got = toxicity.score(docs.where("text IS NULL OR length(text) < 5000"), model).collect()
    want = sorted((str(i), score(t)) for i, t in some)
    for (i, s), (j, w) in zip(sorted((str(r["doc_id"]), r["score"]) for r in got), want):
        assert i == j and abs(s - w) < 1e-9


def test_kinds_are_languages_without_being_told():
    rng = random.Random(2)
    stems = [["kal", "mor", "tis"], ["\u00e9ro", "vun", "sli"], ["zuq", "wex", "yop"]]
    texts = [" ".join("".join(rng.choice(stems[k % 3]) for _ in range(3)) for _ in range(60)).encode() for k in range(60)]
    kinds = toxicity._kinds(texts, 45)
    groups = [set(kinds[k::3].tolist()) for k in range(3)]
    assert not (groups[0] & groups[1] or groups[0] & groups[2] or groups[1] & groups[2])
    assert toxicity._kinds([], 0).tolist() == [] and toxicity._kinds([b"", b"a"], 1).tolist() == [0, 0]


def test_toxicity_without_labels(spark, documents):
    docs = documents([(1, text(1)), (2, None)])
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, empty)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    assert [r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()] == [0, 0]


def test_quality_rules_equal_brute_force(documents, odd):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["a", "b", "c#", "$d", "x\ny", "\n\n", "z\x0b"]) for _ in range(rng.randint(0, 90)))) for k in range(60)]
    got = host_quality.text_rules(documents(rows + odd)).drop("host").collect()
    want = []
    for i, t in rows + odd:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        again = {p for k, x in enumerate(windows) if windows.count(x) > 1 for p in (k, k + 1, k + 2)} if len(w) < 1000 else set()
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want.append((i, len(w), sum(map(len, w)), sum(c in host_quality.SYMBOLS for c in t), len(lines) - len(set(lines)), len(again), failed))
    small = lambda rows: sorted(str(tuple(r)) for r in rows if r[1] < 1000)
    assert small(got) == small(want)


def test_host_verdicts(spark):
    rows = [(k, sentence(k, 60) if k % 10 else "few", "good") for k in range(40)]
    rows += [(100 + k, "few" if k else sentence(k, 60), "bad") for k in range(40)] + [(300, sentence(3, 60), None), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 AS rate", "2 AS of")
    got = host_quality.host_verdicts(df).collect()
    assert len(got) == len(rows)
    assert all(not r["kept"] for r in got if r["host"] == "bad")
    assert all(r["kept"] == (r["n_words"] >= 50) for r in got if r["host"] == "good")
    rates = {r["host"]: r["host_rate"] for r in got}
    assert 0.1 < rates["good"] < rates[None] < rates["bad"] < 39 / 40
    assert host_quality.host_verdicts(df.limit(0)).count() == 0


def test_counting_grams_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    texts = [toxicity._plain(" ".join(rng.choice(vocabulary, 2_000)) + " badword" * (k % 2)) for k in range(280)]
    labels = np.arange(280) % 2
    tracemalloc.start()
    other, own = toxicity._segments(texts, np.zeros(280, dtype=np.int64), labels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts)) > 3_900_000 and most < 120e6
    assert b"badword" in own and b"badword" not in other
