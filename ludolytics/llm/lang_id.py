"""Language of texts: known words first, shorter and shorter character n-grams for the others.

A word that the model knows adds its log frequency in each language. Of any other word the longest n-grams (four, three,
two, one characters, with marks for the word's ends) of which the model knows at least one are taken, and the mean of
their log frequencies is added.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.llm.common import stored

#: Expected number of documents of each language that the model is learnt from, drawn by a hash of id and text.
SAMPLE_DOCS = 5_000
#: The most frequent words and n-grams that the model holds of each language, however many languages there are.
MAX_WORDS = 25_000
MAX_GRAMS = 25_000
LONGEST = 4
UNKNOWN = "und"
#: Scores of unknown words that a task keeps before its memory is emptied.
KEPT = 200_000


def letter_words(text: str) -> list[str]:
    """Runs of letters in lower case; numbers that count as word characters cut a run too."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    if all(map(str.isalpha, words)):
        return words
    return [w for run in words for w in "".join(c if c.isalpha() else " " for c in run).split()]


class Model:
    """Log frequencies of words and n-grams in each language; one row of a matrix for each."""

    def __init__(self, languages: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray]) -> None:
        self.languages, self.grams = languages, grams
        self.known = {word: k for k, word in enumerate(words)}
        self.rows = np.array(list(words.values()), dtype=np.float64).reshape(len(words), len(languages))
        self.limit = len(words) + KEPT

    def backed_off(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest n-grams of a word that are known."""
        marked = f"^{word}$"
        for size in range(LONGEST, 0, -1):
            text = marked if size > 1 else word
            rows = [v for k in range(len(text) - size + 1) if (v := self.grams.get(text[k : k + size])) is not None]
            if rows:
                return sum(rows) / len(rows)
        return np.zeros(len(self.languages))

    def word(self, word: str) -> int:
        """The row of a word; one that is not known gets a row of its own, until there are too many."""
        row = self.known.get(word)
        if row is None:
            row = self.known[word] = len(self.known)
            if row >= len(self.rows):
                self.rows = np.vstack([self.rows, np.zeros((max(1024, len(self.rows)), len(self.languages)))])
            self.rows[row] = self.backed_off(word)
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its probability); equal ones: the first in alphabetical order. No letter: und, 0."""
        counts = Counter(letter_words(text or ""))
        if not counts or not self.languages:
            return UNKNOWN, 0.0
        if len(self.known) > self.limit:
            for unseen in list(self.known)[self.limit - KEPT :]:
                del self.known[unseen]
        rows = [self.word(w) for w in counts]
        total = np.fromiter(counts.values(), dtype=np.float64, count=len(rows)) @ self.rows[rows]
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _log_rates(counts: list[tuple[str, str, int]], languages: list[str], totals: dict[str, float]) -> dict[str, np.ndarray]:
    """Log frequency of each key in each language; all languages have the same floor, half a count in the largest."""
    place = {name: k for k, name in enumerate(languages)}
    base = np.array([max(totals.get(name, 0), 1) for name in languages], dtype=np.float64)
    rows: dict[str, np.ndarray] = {}
    for key, lang, n in counts:
        rows.setdefault(key, np.zeros(len(languages)))[place[lang]] += n
    floor = 0.5 / base.max() if languages else 1.0
    return {key: np.log(row / base + floor) for key, row in rows.items()}


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str | None = None) -> Model:
    """Learn from rows with a text and a language.

    About SAMPLE_DOCS rows of each language are drawn by a hash of id (if there is one) and text, all rows of a rarer
    one; their words and n-grams are counted on the cluster. The most frequent ones of each language come to the driver
    with their counts in all languages. Rows that repeat are drawn and count each. Without a row with text and language
    the model knows none.
    """
    keys = [F.col(text_col), *([F.col(id_col)] if id_col else [])]
    rows = labelled.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(*keys), F.lit(1 << 40)).alias("place")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    share = F.lit(1 << 40)
    for lang, n in rows.groupBy("lang").count().where(F.col("count") > SAMPLE_DOCS).collect():  # one row a language
        share = F.when(F.col("lang") == lang, F.lit((SAMPLE_DOCS << 40) // n)).otherwise(share)
    rows = rows.where(F.col("place") < share)
    words = rows.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("\\p{L}+"), F.lit(0))).alias("key"))
    words = stored(words.groupBy("key", "lang").agg(F.count("*").alias("n")), "word-counts")
    marked = F.concat(F.lit("^"), "key", F.lit("$"))
    grams = [F.transform(F.sequence(F.lit(1), F.length("key")), lambda i: F.substring("key", i, F.lit(1)))]

    def marked_grams(size: int) -> Column:
        last = F.length("key") + 3 - size
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(marked, i, F.lit(size))))

    grams += map(marked_grams, range(2, LONGEST + 1))
    grams = [F.coalesce(g, F.expr("cast(array() AS array<string>)")) for g in grams]
    pieces = words.select("lang", "n", F.explode(F.concat(*grams)).alias("key"))
    pieces = stored(pieces.groupBy("key", "lang").agg(F.sum("n").alias("n")), "gram-counts")
    totals = dict(words.groupBy("lang").agg(F.sum("n")).collect())  # one row a language
    languages = sorted(totals)

    def most(counts: DataFrame, limit: int) -> list[tuple[str, str, int]]:
        order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
        best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
        kept = counts.join(best.select("key").distinct(), "key", "left_semi")
        return [tuple(r) for r in kept.select("key", "lang", "n").orderBy("key", "lang").collect()]

    return Model(
        languages,
        _log_rates(most(words, MAX_WORDS), languages, totals),
        _log_rates(most(pieces, MAX_GRAMS), languages, totals),
    )


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row: the whole text decides.

    A NULL, empty or letterless text is ``und`` with score 0, and so is every text if nothing was learnt. A NULL or
    repeated doc_id is passed on; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MAX_WORDS and MAX_GRAMS of each language bound its size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [own.predict(text) for text in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())]
                yield pa.record_batch(columns, names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"doc_id {kind}, lang_pred string, score double"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)
