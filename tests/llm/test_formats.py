import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from llm_helpers import text
from ludolytics.llm import chat, records, url_rules

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("role", ["user", "assistant", "system", "", "to<ol>>", "\\"])
def test_turns_are_read_back(role):
    rng = random.Random(role)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<<", ">>", "<", ">", "[", "\\", "\\\\", " ", "a", "\n", "system", "/", "<</system>>"]
    for _ in range(3000):
        said = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        turn, start, end = chat.format_turn(role, said)
        assert chat.parse(turn) == [(role, said, start, end)]
        assert chat.unescape(turn[start:end]) == said
        follow, _, _ = chat.format_turn("user", "next")
        assert [t[:2] for t in chat.parse(turn + follow)] == [(role, said), ("user", "next")]


def test_plain_content_is_not_escaped():
    assert chat.format_turn("user", "a [b] c > d")[0] == "[INST] a [b] c > d [/INST]"
    assert "\\[INST]" in chat.format_turn("user", "x [INST]")[0]


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 40)
    rows = [(1, 2, "assistant", "two </s>"), (1, 1, "user", "one"), (1, 3, "user", None), (1, 4, "assistant", "four"), (1, 4, "assistant", "four")]
    rows += [(2, None, None, "x"), (None, 1, "user", "lone"), (3, 0, "assistant", "\\")]
    rows += [(9, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(50)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS part", "2 AS loss")
    formatted = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.read_conversations(formatted).collect()}
    import hashlib

    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in (1, 2, None, 3, 9):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        learnt = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == digest("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), digest(learnt))
    assert formatted.where("conv_id = 9").count() > 5
    assert chat.read_conversations(chat.format_conversations(df.limit(0))).count() == 0


def library_ids(texts, plain_specials=False):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = plain_specials
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def own_ids(tokenizer, texts):
    data = [t.encode() for t in texts]
    return [x.tolist() for x in tokenizer(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))]


@pytest.mark.parametrize("plain_specials", [False, True])
def test_words_equal_the_library(plain_specials):
    rng, own = random.Random(1), records.WordTokenizer(TOKENIZER, 1, plain_specials)
    assert own.by_words
    alphabet = [*"abcABC\u00e9\u00c9\u00df\u03a3\u03c3\u0130'.,;:!?-_()[]<>=~\u0338\u0301 \t\r\x0b\x1c0\u00b2\u2167\u4e2d\U0001f600", "the", "'s", "'LL", "  ", "\n"]
    texts = ["", " ", "\n", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "x <|endoftext|> y"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(8000)]
    texts += ["".join(rng.choice([*alphabet, "<|endoftext|>"]) for _ in range(rng.randint(1, 25))) for _ in range(500)]
    for got, want in zip(own_ids(own, texts), library_ids(texts, plain_specials)):
        assert got == [*want, 1]


def test_another_kind_of_tokenizer_gets_whole_texts(tmp_path):
    import json

    file = json.load(open(TOKENIZER))
    file["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    other = tmp_path / "joined.json"
    other.write_text(json.dumps(file))
    own = records.WordTokenizer(str(other), None)
    assert not own.by_words
    assert own_ids(own, ["ab cd", "", "x"]) == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in ["ab cd", "", "x"]]


def test_an_id_of_many_rows_is_dealt_to_several_files(spark, documents):
    rows = [(7, text(k)) for k in range(200)] + [(None, text(k)) for k in range(300, 420)] + [(k, text(k)) for k in range(40)]
    folder = records.record_folder(spark)
    files = records.write_records(documents(rows).repartition(3), folder, TOKENIZER, end_id=1)
    read = records.read_records(files, folder).orderBy("start").collect()
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in read]
    assert order == sorted(order) and len(read) == len(rows)
    assert max(r["n_records"] for r in files.collect()) < 200
    want = sorted(str((i, [*ids, 1])) for (i, _), ids in zip(rows, library_ids([t for _, t in rows])))
    assert sorted(str((r["doc_id"], r["token_ids"])) for r in read) == want


def test_records(spark, documents, odd):
    folder = records.record_folder(spark)
    files = records.write_records(documents(odd), folder, TOKENIZER, end_id=1)
    read = records.read_records(files, folder)
    rows = read.collect()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == sorted((i for i, _ in odd), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += len(r["token_ids"])
    want = sorted(str((i, [*ids, 1])) for (i, _), ids in zip(odd, library_ids([t or "" for _, t in odd])))
    assert sorted(str((r["doc_id"], r["token_ids"])) for r in rows) == want
    sums = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in records.checksums(read).collect()}
    assert sorted(map(str, records.record_checksums(files, folder).collect())) == sorted(map(str, records.checksums(read).collect()))
    for r in rows:
        crc = zlib.crc32(np.array(r["token_ids"], "<u4").tobytes())
        assert sums[r["doc_id"], r["start"]] == (len(r["token_ids"]), crc)
    mixed = records.shuffled_records(spark, files, folder, seed=3).collect()
    assert sorted(str((r["doc_id"], r["token_ids"])) for r in mixed) == want
    assert [r["doc_id"] for r in mixed] != [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]


def test_no_records(spark, documents):
    folder = records.record_folder(spark)
    files = records.write_records(documents([]), folder, TOKENIZER)
    assert files.count() == records.read_records(files, folder).count() == records.record_checksums(files, folder).count() == 0


def test_damage_is_noticed():
    import io

    good = records.frame(7, 2, b"\x01\x00\x02\x00")
    doc_id, ids = records.read_frame(io.BytesIO(good))
    assert doc_id == 7 and ids.tolist() == [1, 2]
    for k in range(len(good)):
        bad = bytearray(good)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(bad)))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(good[:-1]))


FIXED = [url_rules.HostRule("block", "net", "/"), url_rules.HostRule("allow", "example.net", "/en/")]


def test_fixed_rules(spark):
    urls = {
        "http://a.NET/x": ("a.net", "/x", "net/", "block"),
        "https://Example.net/en/1?q#f": ("example.net", "/en/1", "example.net/en/", "allow"),
        "https://www.example.net/EN/1": ("www.example.net", "/EN/1", "net/", "block"),
        "x://internet/": ("internet", "/", None, "allow"),
        "x://a.net?/": ("a.net", "", None, "allow"),
        "a.net/x": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "a://b://c": ("b:", "//c", None, "allow"),
    }
    rows = [(k, u) for k, u in enumerate(urls)] + [(None, None), (0, "http://a.NET/x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "1 AS tokens", "2 AS signature", "3 AS host")
    got = url_rules.judge(df, FIXED).collect()
    assert len(got) == len(rows)
    for r in got:
        want = ("", "", None, "allow") if r["page_id"] is None else urls[rows[r["page_id"]][1]]
        assert (r["host"], r["path"], r["rule"]) == want[:3]
        # without a fixed rule the mined ones decide, if there is any token
        assert r["verdict"] == want[3] or (r["rule"] is None and "a" in r["host"].split("."))
    assert url_rules.judge(df.limit(0), FIXED).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng, rows = random.Random(2), []
    for k in range(400):
        section, kind = rng.choice(["news", "shop", "bet"]), rng.choice(["x", "y"])
        blocked = section == "bet" or (section == "shop" and kind == "y")
        rows.append((k, f"http://{kind}.site{k % 40}.org/{section}/{k}", ("block" if blocked else "allow") if k % 2 else None))
    df = spark.createDataFrame(rows, "page_id bigint, url string, given string")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(df, [], label_col="given").collect()}
    for k, url, _ in rows:
        section, kind = url.split("/")[3], url[7]
        assert got[k] == ("block" if section == "bet" or (section == "shop" and kind == "y") else "allow")
    # every frequent combination of tokens with its confidence, counted directly
    host, path = url_rules.host_and_path(df["url"])
    token_rows = df.select(url_rules.tokens(host, path, df["url"]).alias("tokens"), df["given"].alias("label"))
    mined = url_rules.mine(token_rows, min_support=0.05, min_confidence=0.8).collect()
    labelled = [(set(r["tokens"]), r["label"]) for r in token_rows.collect() if r["label"]]
    assert mined
    for r in mined:
        held = [label for tokens, label in labelled if set(r["items"]) <= tokens]
        assert held.count(r["verdict"]) == r["support"] >= 0.05 * len(labelled) - 1e-9
        assert abs(r["confidence"] - r["support"] / len(held)) < 1e-9 and r["confidence"] >= 0.8
