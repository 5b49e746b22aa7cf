"""URL filter by association rules.

The labelled urls become sets of tokens (labels of the host, parts of the path, names of parameters) with the label as
one more token. The first parts of a path are marked by their place, the others stand anywhere in it. Spark's FP-growth finds the token combinations that occur often, and those that foretell a
label with enough confidence and support become rules; a rule that a shorter one already covers as well is dropped.
Urls are matched by an inverted index: a rule is filed under its rarest token and met by the token sets that hold it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least share of the labelled urls that hold a combination, and least share of a combination's urls with its label.
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
#: Leading path parts whose tokens tell their place.
PATH_PARTS = 2
LABELS = ("allow", "block")


@dataclass(frozen=True)
class HostRule:
    """A fixed rule: it fits a host and its subdomains if the url's path starts with ``path``."""

    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` and for NULL."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fixed_rule(host: Column, path: Column, rules: list[HostRule]) -> Column:
    """struct(rule, verdict) of the longest fitting rule (host and path together), NULL if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.host)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        this = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, this).otherwise(out)
    return out


def tokens(host: Column, path: Column, url: Column) -> Column:
    """The distinct tokens of a url: ``h:`` labels of the host, ``p1:``, ``p2:``, ``p:`` path parts, ``q:`` parameter names."""
    labels = F.transform(F.filter(F.split(host, "\\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    place = lambda k: F.when(k < PATH_PARTS, (k + 1).cast("string")).otherwise(F.lit(""))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    parts = F.transform(parts, lambda x, k: F.concat(F.lit("p"), place(k), F.lit(":"), x))
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^[^?#]*\\?([^#]*)", 1), "&")
    query = F.transform(F.filter(query, lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(labels, parts, query))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, items, verdict, confidence, support) from rows of (tokens, label); rows without a label are left out.

    Tokens that too few urls hold are taken out before the transactions are built. At most 1 / min_support times the
    tokens of a url are frequent, whatever the table's size; the support is a share, alike at every size. No labelled row
    gives no rule.
    """
    rows = labelled.where(F.col("label").isin(*LABELS)).select("tokens", "label")
    total = rows.count()
    least = min_support * total
    single = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    frequent = [r[0] for r in single.where(F.col("n") >= F.lit(least)).select("token").collect()]  # bounded, see above
    known = F.array(*map(F.lit, sorted(frequent))) if frequent else F.expr("cast(array() AS array<string>)")
    baskets = rows.select(F.array_intersect("tokens", known).alias("tokens"), "label")
    items = F.concat("tokens", F.array(F.concat(F.lit("label="), "label")))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    sets = model.fit(baskets.select(items.alias("items"))).freqItemsets
    label = F.get(F.filter("items", lambda x: x.startswith("label=")), 0)
    plain = F.array_sort(F.filter("items", lambda x: ~x.startswith("label=")))
    sets = sets.select(plain.alias("items"), label.alias("label"), "freq")
    whole = sets.where("label IS NULL").select("items", F.col("freq").alias("n"))
    found = sets.where("label IS NOT NULL AND size(items) > 0").join(whole, "items")
    rules = found.withColumn("confidence", F.col("freq") / F.col("n")).where(F.col("confidence") >= min_confidence)
    rules = rules.select("items", F.substring("label", 7, 100).alias("verdict"), "confidence", F.col("freq").alias("support"))
    return _pruned(rules)


def _pruned(rules: DataFrame) -> DataFrame:
    """Without the rules that one with one token less, the same verdict and no less confidence makes needless."""
    rules = rules.withColumn("rule_id", F.xxhash64(F.array_join("items", "\x01")))
    shorter = rules.select(
        "rule_id", "verdict", "confidence",
        F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("inner"),
    )
    general = rules.select(
        F.col("items").alias("inner"), "verdict", F.col("confidence").alias("other")
    )
    needless = shorter.join(general, ["inner", "verdict"]).where("other >= confidence").select("rule_id", "verdict").distinct()
    return rules.join(needless, ["rule_id", "verdict"], "left_anti")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(signature, verdict, confidence, items) of the best rule that each token set (signature, tokens) holds.

    The best has the highest confidence, then the most tokens, then the highest support; equal ones: allow first.
    """
    counts = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    filed = rules.select("rule_id", "items", "verdict", "confidence", "support", F.explode("items").alias("token"))
    filed = filed.join(counts, "token", "left").groupBy("rule_id", "verdict").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))["token"].alias("token"),
        F.first("items").alias("items"), F.first("confidence").alias("confidence"), F.first("support").alias("support"),
    )
    met = sets.select("signature", "tokens", F.explode("tokens").alias("token")).join(filed, "token")
    met = met.where(F.size(F.array_except("items", "tokens")) == 0)
    order = F.struct(
        (-F.col("confidence")).alias("c"), (-F.size("items")).alias("s"), (-F.col("support")).alias("n"), "verdict", "items"
    )
    best = met.groupBy("signature").agg(F.min(order).alias("best"))
    return best.select(
        "signature", F.col("best.verdict").alias("mined"), (-F.col("best.c")).alias("confidence"), F.col("best.items").alias("items")
    )


def judge(
    pages: DataFrame, fixed: list[HostRule], id_col: str = "page_id", url_col: str = "url", label_col: str | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence, combination), one row per row.

    A fixed rule decides where one fits. The other urls get the verdict of the best mined rule, ``allow`` if none
    matches. The labels that the rules are mined from are those of ``label_col`` (allow or block), by default the
    verdicts of the fixed rules. NULL urls and such without ``://`` have an empty host and path and no token, so no
    mined rule matches. A NULL or repeated page_id is passed on; an empty table gives an empty result.
    """
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), label.alias("given"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", "url", "given", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), fixed))
    rows = rows.withColumn("tokens", tokens(F.col("host"), F.col("path"), F.col("url")))
    label = F.col("given") if label_col else F.col("fixed.verdict")
    rules = mine(rows.select("tokens", label.alias("label")))
    vocabulary = rules.select(F.explode("items").alias("token")).distinct()
    known = sorted(r[0] for r in vocabulary.collect())  # frequent tokens only
    kept = F.array_intersect("tokens", F.array(*map(F.lit, known))) if known else F.expr("cast(array() AS array<string>)")
    # the many urls share few token sets once rare tokens are gone: match these, each once
    rows = rows.withColumn("kept", F.array_sort(kept)).withColumn("signature", F.array_join("kept", "\x01"))
    undecided = rows.where("fixed IS NULL AND size(kept) > 0")
    sets = undecided.groupBy("signature").agg(F.first("kept").alias("tokens"))
    out = rows.join(match(sets, rules), "signature", "left")
    return out.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", "mined", F.lit("allow")).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.col("confidence")).alias("confidence"),
        F.when(F.col("fixed").isNull(), F.array_join("items", " ")).alias("combination"),
    )
