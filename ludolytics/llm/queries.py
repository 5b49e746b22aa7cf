"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.llm import (
    chat,
    decontaminate,
    host_quality,
    importance,
    lang_id,
    line_dedup,
    near_dedup,
    periodic,
    piece_bpe,
    records,
    suffix_dedup,
    toxicity,
    url_rules,
)
from ludolytics.llm.common import table
from ludolytics.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return register


def _fold(column: str, folds: int) -> Column:
    """crc32 of an id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


@query("op1_url_rules")
def _url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = [
        url_rules.HostRule("block", "net", "/"),
        url_rules.HostRule("allow", "example.net", "/en/"),
        url_rules.HostRule("block", "example.com", "/de/"),
        url_rules.HostRule("allow", "org", "/fr/"),
    ]
    return url_rules.judge(table(spark, sf_dir, "pages"), fixed)


@query("op2_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(_fold("doc_id", 5) != 0))
    return toxicity.score(docs, model).withColumn("held_out", _fold("doc_id", 5) == 0)


@query(
    "op3_line_dedup",
    r"""
    WITH sentence AS (
        SELECT doc_id, unnest(range(len(s))) AS number, unnest(s) AS line
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''),
                     '[^\n]*?(?:[^.!?\x20\x09-\x0D][.!?] |[。！？؟।])|[^\n]*\n|[^\n]+') AS s FROM documents)),
    long_line AS (
        SELECT doc_id, number, string_split(line, ' ') AS words FROM sentence
        WHERE length(line) - length(replace(line, ' ', '')) >= 18),
    word AS (
        SELECT doc_id, number, unnest(range(1, len(words) + 1)) AS i, len(words) AS n, unnest(words) AS w FROM long_line),
    remainders AS (
        SELECT list(list_reduce(list_prepend(i, range(8)),
                    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS r
        FROM (SELECT unnest(range(256)) AS i)),
    checksum AS (
        SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen(w)), lambda k:
                    16 * (strpos('0123456789ABCDEF', hex(encode(w))[2 * k + 1]) - 1)
                    + strpos('0123456789ABCDEF', hex(encode(w))[2 * k + 2]) - 1)),
                lambda c, x: xor(r[xor(c, x) % 256 + 1], c // 256))) AS c
        FROM (SELECT DISTINCT w FROM word), remainders),
    ends AS (
        SELECT DISTINCT doc_id, number, arg_min(i, c * 1048576 + i) OVER (
                   PARTITION BY doc_id, number ORDER BY i ROWS BETWEEN CURRENT ROW AND 17 FOLLOWING) AS e, n, i
        FROM word JOIN checksum USING (w) QUALIFY i <= n - 17
        UNION ALL SELECT doc_id, number, len(words), len(words), 0 FROM long_line),
    part AS (
        SELECT doc_id, number, lag(e, 1, 0) OVER (PARTITION BY doc_id, number ORDER BY e) AS low, e, n
        FROM (SELECT DISTINCT doc_id, number, e, n FROM ends)),
    piece AS (
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY number, low) AS number, piece,
               regexp_replace(piece, '[\x20\x09-\x0D]+$', '') AS bare
        FROM (SELECT doc_id, number, 0 AS low, line AS piece FROM sentence
              WHERE length(line) - length(replace(line, ' ', '')) < 18
              UNION ALL SELECT doc_id, number, low, array_to_string(words[low + 1:e], ' ') || CASE WHEN e < n THEN ' ' ELSE '' END
              FROM part JOIN long_line USING (doc_id, number))),
    line AS (
        SELECT doc_id, number, bare, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS place,
               sum(greatest(length(bare) - length(replace(bare, ' ', '')) + 1, length(bare) // 10))
                   OVER (PARTITION BY doc_id ORDER BY number) AS upto,
               greatest(length(bare) - length(replace(bare, ' ', '')) + 1, length(bare) // 10) AS w
        FROM piece WHERE bare <> ''),
    body AS (
        SELECT doc_id, list(bare ORDER BY place) AS lines, list(number ORDER BY place) AS numbers, sum(w) AS w,
               sum(length(bare)) AS chars, count(*) AS n
        FROM line GROUP BY doc_id),
    forwards AS (SELECT a.doc_id, a.place AS low, min(b.place) AS high FROM line a JOIN line b
                 ON a.doc_id = b.doc_id AND b.place BETWEEN a.place AND a.place + 14 AND b.upto - a.upto + a.w >= 15 GROUP BY ALL),
    backwards AS (SELECT a.doc_id, max(a.place) AS low, b.n AS high FROM line a JOIN body b
                  ON a.doc_id = b.doc_id AND a.place >= b.n - 14 AND b.w - a.upto + a.w >= 15 GROUP BY ALL),
    span AS (FROM forwards UNION FROM backwards UNION SELECT doc_id, 1, n FROM body WHERE w < 15 AND chars >= 60),
    windows AS (SELECT doc_id, low, high, array_to_string(lines[low:high], chr(1)) AS body FROM span JOIN body USING (doc_id)),
    later AS (SELECT doc_id, low, high FROM windows QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, low) > 1),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(numbers[low], numbers[high] + 1)) AS number FROM later JOIN body USING (doc_id)),
    kept AS (
        SELECT p.doc_id, string_agg(p.piece, '' ORDER BY p.number) FILTER (g.number IS NULL) AS text,
               count(g.number) AS removed_lines
        FROM piece p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.number = p.number GROUP BY p.doc_id)
    SELECT d.doc_id, coalesce(removed_lines, 0) AS removed_lines, length(coalesce(k.text, '')) AS kept_chars,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
    """,
)
def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return line_dedup.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "removed_lines",
        F.length(text).cast("bigint").alias("kept_chars"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )


@query(
    "op4_benchmark_decontamination",
    r"""
    WITH plain AS (
        SELECT 'd' AS kind, doc_id::VARCHAR AS id, coalesce(text, '') AS text FROM documents
        UNION ALL SELECT 'b', item_id::VARCHAR, coalesce(text, '') FROM benchmark),
    cut AS (
        SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM plain),
    sizes AS (SELECT DISTINCT least(10, len(words)) AS k FROM cut WHERE kind = 'b' AND len(words) > 0),
    places AS (
        SELECT kind, id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM cut, sizes
        WHERE len(words) >= k AND (kind = 'd' OR k = least(10, len(words)))),
    windows AS (SELECT kind, id, k, i, array_to_string(list_slice(words, i, i + k - 1), ' ') AS w FROM places),
    met AS (
        SELECT d.id, b.id AS item, d.i, d.k FROM windows d JOIN windows b ON d.w = b.w AND d.k = b.k
        WHERE d.kind = 'd' AND b.kind = 'b'),
    spots AS (
        SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS p FROM met) GROUP BY id),
    named AS (
        SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT id, item FROM met) GROUP BY id)
    SELECT c.id::BIGINT AS doc_id, len(c.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM cut c LEFT JOIN spots s ON c.id = s.id LEFT JOIN named n ON c.id = n.id WHERE c.kind = 'd'
    """,
)
def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination(found)


@query("op5_language_id")
def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(_fold("doc_id", 4) != 2), id_col="doc_id")
    held_out = docs.select("doc_id", "text", (_fold("doc_id", 4) == 2).alias("held_out"))
    return lang_id.predict(held_out, model).withColumn("held_out", _fold("doc_id", 4) == 2)


@query(
    "op6_chat_format",
    """
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    shown AS (
        SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 2 * length(role) + 9 END
                  + length(text)
                  + CASE WHEN regexp_matches(text, '\\\\|\\[/?INST\\]|</?s>|<<|>>') OR (role <> 'user' AND suffix(text, '<'))
                         THEN length(text) - length(regexp_replace(text, '[\\\\\\[<>]', '', 'g')) ELSE 0 END AS chars
        FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars
    FROM shown GROUP BY conv_id
    """,
)
def _chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    own = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role")
    turns = turns.unionByName(own.withColumn("text", F.lit(text)))
    return chat.read_conversations(chat.format_conversations(turns))


@query("op7_token_records")
def _token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = records.record_folder(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    files = records.write_records(table(spark, sf_dir, "documents"), folder, tokenizer, end_id=1)
    return records.record_checksums(files, folder)


@query(
    "op8_minhash_near_dedup",
    r"""
    WITH RECURSIVE cut AS (
        SELECT doc_id, list_filter(string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
        FROM documents),
    places AS (
        SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM cut WHERE len(words) > 0),
    shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS s FROM places),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
        GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 75 * (x.n + y.n - c)),
    edges AS (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links),
    reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT r.doc_id, e.v FROM reached r JOIN edges e ON e.u = r.other)
    SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
    FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
    """,
)
def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op9_host_quality",
    r"""
    WITH parts AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    windows AS (
        SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM parts)),
    again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
    repeated AS (
        SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) AS s(j) GROUP BY doc_id),
    rules AS (
        SELECT p.doc_id, p.source, len(words) AS n_words,
               length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
               length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
               len(words) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(words) AS base_failed
        FROM parts p LEFT JOIN repeated r ON p.doc_id = r.doc_id),
    hosts AS (
        SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS f FROM rules GROUP BY source),
    moments AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v, avg(1 / n) AS c FROM hosts),
    prior AS (
        SELECT m, CASE WHEN v > m * (1 - m) * c
                       THEN least(greatest(m * (1 - m) / (v - m * (1 - m) * c) - 1, 1), 1000) ELSE 1000 END AS k
        FROM moments),
    verdicts AS (SELECT source, (f + k * m) / (n + k) <= 0.5 AS good FROM hosts, prior)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND good AS kept
    FROM rules r JOIN verdicts v ON r.source IS NOT DISTINCT FROM v.source
    """,
)
def _host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.host_verdicts(table(spark, sf_dir, "documents")).drop("host", "host_rate")


@query("op10_piece_bpe")
def _piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = piece_bpe.round_trip(table(spark, sf_dir, "documents"), model)
    listed = F.concat_ws(",", F.col("token_ids").cast("array<string>"))
    return both.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query(
    "op11_periodic_runs",
    r"""
    WITH remainders AS (
        SELECT list(list_reduce(list_prepend(i, range(8)),
                    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS r
        FROM (SELECT unnest(range(256)) AS i)),
    hashed AS (
        SELECT doc_id, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(length(doc_id::VARCHAR)), lambda k: 48 + (doc_id::VARCHAR)[k + 1]::BIGINT)),
                   lambda c, x: xor(r[xor(c, x) % 256 + 1], c // 256))) AS h,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS own
        FROM documents, remainders),
    places AS (
        SELECT doc_id, own, len(own) AS n, h % 10 = 0 AND len(own) > 0 AS changed, h // 10 % greatest(len(own), 1) AS a,
               1 + (len(own) - h // 10 % greatest(len(own), 1)) // (3 + h // 10 % 8) AS p
        FROM hashed),
    bodies AS (
        SELECT doc_id, n, CASE WHEN changed THEN list_transform(range(n), lambda i:
                              own[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE own END AS words
        FROM places),
    grams AS (
        SELECT doc_id, n, i, array_to_string(words[i + 1:i + 5], ' ') AS w
        FROM (SELECT *, unnest(range(n - 4)) AS i FROM bodies)),
    pairs AS (
        SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.w = y.w
        WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
    stretches AS (
        SELECT doc_id, q, min(i) AS s, count(*) + 4 + q AS len FROM islands GROUP BY doc_id, q, island
        HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
    runs AS (
        SELECT * FROM stretches x WHERE NOT EXISTS (
            FROM stretches y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
    listed AS (
        SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS shown
        FROM runs GROUP BY doc_id),
    best AS (
        SELECT doc_id, s AS start, len AS length, q AS period, 1000 * len // q AS exponent_milli FROM runs
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len::DOUBLE / q DESC, s, q) = 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
    left_over AS (
        SELECT b.doc_id, string_agg(b.w, ' ' ORDER BY b.i) AS text
        FROM (SELECT doc_id, unnest(range(n)) AS i, unnest(words) AS w FROM bodies) b ANTI JOIN gone USING (doc_id, i)
        GROUP BY b.doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, exponent_milli,
           sha256(coalesce(shown, '')) AS runs_sha256, sha256(coalesce(l.text, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN left_over l USING (doc_id)
    """,
)
def _periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, own).alias("own"))
    # the words from the a-th on repeat the first p of them
    docs = docs.withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("own"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", F.expr("CAST(1 + floor((n - a) / (3 + g % 8)) AS INT)"))
    repeated = F.expr(
        """array_join(concat(slice(own, 1, a), slice(flatten(array_repeat(
               slice(own, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a)), ' ')"""
    )
    docs = docs.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs)
    more = "r.length * best.period > best.length * r.period"
    best = f"aggregate(runs, get(runs, 0), (best, r) -> IF({more}, r, best))"
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.select("doc_id", "runs", "collapsed", F.expr(best).alias("best"), lines.alias("lines"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query(
    "op12_importance_resampling",
    r"""
    WITH plain AS (
        SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
        UNION ALL SELECT 'b', 0, coalesce(text, '') FROM benchmark),
    cut AS (
        SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM plain),
    counted AS (SELECT kind, id, w, count(*) AS n FROM (SELECT kind, id, unnest(words) AS w FROM cut) GROUP BY ALL),
    remainders AS (
        SELECT list(list_reduce(list_prepend(i, range(8)),
                    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS r
        FROM (SELECT unnest(range(256)) AS i)),
    hashed AS (
        SELECT w, list_reduce(list_prepend(4294967295, list_transform(range(strlen(w)), lambda k:
                    16 * (strpos('0123456789ABCDEF', hex(encode(w))[2 * k + 1]) - 1)
                    + strpos('0123456789ABCDEF', hex(encode(w))[2 * k + 2]) - 1)),
                lambda c, x: xor(r[xor(c, x) % 256 + 1], c // 256)) AS c
        FROM (SELECT DISTINCT w FROM counted), remainders),
    buckets AS (SELECT w, xor(c, 4294967295) % 10000 AS bucket FROM hashed),
    totals AS (
        SELECT b.bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t
        FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN buckets USING (bucket) LEFT JOIN counted USING (w)
        GROUP BY b.bucket),
    gains AS (
        SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS gain
        FROM totals),
    weights AS (
        SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
        FROM counted JOIN buckets USING (w) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id),
    scored AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE)
                                                          / 4294967296)))::BIGINT AS score
        FROM documents LEFT JOIN weights ON id = doc_id),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
        FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, place AS rank
    FROM scored LEFT JOIN (FROM ranked WHERE place <= 10 * n // 100) USING (doc_id)
    """,
)
def _importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = [importance.bucket_counts(t) for t in (docs, table(spark, sf_dir, "benchmark"))]
    return importance.draw(importance.weights(docs, importance.gains(*counts)))


@query(
    "op13_suffix_dedup",
    r"""
    WITH bytes AS (SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
    places AS (SELECT doc_id, b, unnest(range(1, n - 48)) AS i FROM bytes WHERE n >= 50),
    windows AS (SELECT doc_id, i, b[i:i + 49] AS w FROM places),
    shared AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
    later AS (SELECT doc_id, i FROM windows JOIN shared USING (w) WHERE doc_id > least),
    marked AS (
        SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS apart FROM later),
    numbered AS (SELECT doc_id, i, count(*) FILTER (apart) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
    spans AS (SELECT doc_id, min(i) AS low, max(i) + 50 AS high FROM numbered GROUP BY doc_id, span),
    cut AS (
        SELECT doc_id, count(*) AS n_spans, sum(high - low)::BIGINT AS n_removed,
               list_prepend(1, list(high ORDER BY low)) AS starts, list(low ORDER BY low) AS ends
        FROM spans GROUP BY doc_id),
    left_over AS (
        SELECT doc_id, list_transform(range(1, len(starts) + 1),
                   lambda k: hex(b[starts[k]:coalesce(ends[k], n + 1) - 1])) AS pieces
        FROM cut JOIN bytes USING (doc_id))
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           CASE WHEN pieces IS NULL THEN sha256(b) ELSE sha256(unhex(array_to_string(pieces, ''))) END AS kept_sha256
    FROM bytes LEFT JOIN cut USING (doc_id) LEFT JOIN left_over USING (doc_id)
    """,
)
def _suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
