"""Quality rules of documents with verdicts for whole hosts, in DataFrame expressions only.

Rules are counted for each text by array expressions, within the row. A host's documents that fail are counted, the
rates are drawn to an overall prior (a beta distribution whose two parameters are fitted to the hosts' rates by their
mean and variance), and hosts whose drawn rate is high lose all their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import stored

_SPACE = "[\\x20\\x09-\\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A document of fewer words fails.
MIN_WORDS = 50
#: A document with more than this share (in hundredths) of its words in repeated windows fails.
MAX_REPEATED = 50
WINDOW = 3
#: A host fails if its drawn failure rate is over this.
MAX_HOST_RATE = 0.5
#: The most documents that the prior weighs as much as.
PRIOR_LIMIT = 1000.0


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def text_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed), one row per row.

    Words are runs of anything but ASCII white space. NULL and empty texts have no words, lines or symbols and fail.
    n_repeat_words counts the words that lie in a window of three words which the text holds twice or more.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"))
    parts = F.filter(F.split("text", _SPACE), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(_without(line, _SPACES)) > 0)
    rows = rows.select(
        "doc_id",
        "host",
        F.length(_without(F.col("text"), _SPACES)).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        parts.alias("words"),
    )
    rows = rows.withColumn("n_words", F.size("words").cast("bigint"))
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW),
            lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(WINDOW))),
        ),
    )
    rows = rows.withColumn("windows", windows)
    # windows by hash and place: equal ones become neighbours, so one pass finds all that have an equal one
    ranked = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("ranked", F.when(F.size("windows") > F.size(F.array_distinct("windows")), ranked))
    rows = rows.withColumn("hashes", F.transform("ranked", lambda x: x["h"]))
    rows = rows.withColumn("order", F.transform("ranked", lambda x: x["i"]))

    def equal(k: Column, j: Column) -> Column:
        return F.coalesce(F.get("hashes", k) == F.get("hashes", j), F.lit(False))

    again = F.filter("order", lambda i, k: equal(k, k - 1) | equal(k, k + 1))
    rows = rows.withColumn("places", F.sort_array(again))
    # each window adds the words up to the next one, at most its own three
    gaps = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.get("places", k + 1) - p, F.lit(WINDOW))),
        F.lit(0).cast("bigint"),
        lambda total, gap: total + gap,
    )
    repeated = F.coalesce(gaps, F.lit(0).cast("bigint"))
    duplicates = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")
    rows = rows.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        duplicates.alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def host_rates(rules: DataFrame) -> DataFrame:
    """(host, n_docs, n_failed, rate): failure rates of hosts, drawn to the beta prior that fits all hosts' rates.

    The prior's mean is the mean of the hosts' rates and its weight follows from their variance beyond what chance
    gives; if the hosts differ no more than by chance (or there is one host only) the weight is PRIOR_LIMIT documents.
    A NULL host is a host of its own.
    """
    failed = F.sum(F.col("base_failed").cast("bigint"))
    hosts = rules.groupBy("host").agg(F.count("*").alias("n_docs"), failed.alias("n_failed"))
    hosts = hosts.withColumn("raw", F.col("n_failed") / F.col("n_docs"))
    moments = hosts.agg(F.avg("raw"), F.var_pop("raw"), F.avg(1 / F.col("n_docs")))
    mean, spread, chance = moments.first()  # three numbers
    weight = PRIOR_LIMIT
    if mean is not None and spread > mean * (1 - mean) * chance:
        weight = min(max(mean * (1 - mean) / (spread - mean * (1 - mean) * chance) - 1, 1.0), PRIOR_LIMIT)
    drawn = (F.col("n_failed") + F.lit(weight * (mean or 0.0))) / (F.col("n_docs") + F.lit(weight))
    return hosts.select("host", "n_docs", "n_failed", drawn.alias("rate"))


def host_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The columns of ``text_rules`` with ``host_rate`` and ``kept``: no rule failed, and the host didn't either.

    Rows with a NULL or repeated doc_id are judged like any other; an empty table gives an empty result.
    """
    rules = stored(text_rules(docs, id_col, text_col, host_col), "rules")
    rates = host_rates(rules).select(F.col("host").alias("of"), F.col("rate").alias("host_rate"))
    both = rules.join(rates, F.col("host").eqNullSafe(F.col("of")), "left").drop("of")
    return both.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= MAX_HOST_RATE))
