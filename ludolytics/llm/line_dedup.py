"""Repeated passages, found by winnowing over line hashes, in DataFrame expressions only.

A text is cut into lines: after line feeds, after the stops of sentences, and a line of more than LONGEST words by its
content, after the word of the least checksum in each window of LONGEST words. So a passage in another paragraph, on one
long line or without any stop is cut alike in all its copies but for its first and last words.

A window is the least number of consecutive lines (blank ones aside) with WORDS words or more, counted from any line
forwards, or from the last line backwards; a text of fewer words is one window. The least line hash of a window's first two
lines is its fingerprint, so texts that share a window share its fingerprint, and every shared run of 50 words holds one.
Fingerprints that stand at one place only are dropped by a count; the windows around the others are compared as wholes,
the first place of each is found, and every later one is deleted. Neighbouring windows extend a match in both
directions, line by line, as far as the texts agree.

Counts are made before rows meet, and are stored before they are joined, so that a join can deal a fingerprint or
passage of a third of all texts to many tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import stored

#: Words of a line, at most, and of a window, at least.
LONGEST = 18
WORDS = 15
#: Characters below which a text of fewer words is no passage.
MIN_CHARS = 60
#: Stops of scripts without spaces; one ends a line if no stop and space follow, which then end it.
SIGNS = "\u3002\uff01\uff1f\u061f\u0964"
SIGN = f"[{SIGNS}](?![.!?] )"
#: One stop and a space, after a sign of the same line.
STOP = "[.!?] (?<=[^.!?\\x20\\x09-\\x0D][.!?] )"
#: The ends of lines.
ENDS = f"(?:\n|{SIGN}|{STOP})"
_MARK = "\x01"
#: White space at the end of a line, which is not compared.
BLANK = " \t\n\x0b\f\r"
#: Characters that count as a word where there are no spaces.
WORD_CHARS = 10


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _cut_by_content(line: Column) -> Column:
    """The parts of a long line that end with the word of the least checksum in some window of LONGEST words."""
    number = lambda key: key.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")

    def minima(keys: Column, blocks: Column) -> Column:
        def of_four(first_of: Column, g: Column) -> Column:
            def least(first: int, last: int) -> Column:
                """Of the keys so many places after the four windows' begin; whole blocks have their own."""
                values, at = [], first
                while at <= last:
                    whole = at % 4 == 0 and at + 3 <= last
                    values.append(F.get(blocks, g + at // 4) if whole else F.get(keys, first_of + at))
                    at += 4 if whole else 1
                return F.least(*values)

            # most often one word is in all four windows and less than any other
            shared = lambda k: (number(k) - first_of).between(3, LONGEST - 1)
            there = lambda i: F.get(keys, first_of + (i + LONGEST - 1)).isNotNull()
            each = [least(0, LONGEST - 1)]
            each += [F.when(there(i), least(i, i + LONGEST - 1)).otherwise(each[0]) for i in (1, 2, 3)]
            return _let(least(0, LONGEST + 2), lambda k: F.when(shared(k), F.array(k)).otherwise(F.array(*each)))

        return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size(keys) - LONGEST, F.lit(4)), of_four)))

    def parts(words: Column) -> Column:
        # a key is the word's checksum, then its number
        keys = F.transform(words, lambda w, i: F.shiftleft(F.crc32(w.cast("binary")), 31) + i)
        block = lambda x: lambda i: F.least(*(F.get(x, i + k) for k in range(4)))
        blocks = lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - 1, F.lit(4)), block(x))
        chosen = _let(keys, lambda x: _let(blocks(x), lambda y: minima(x, y)))
        ends = F.transform(chosen, lambda k: number(k) + 1)
        edges = F.array_distinct(F.concat(F.array(F.lit(0)), ends, F.array(F.size(words))))

        def part(low: Column, high: Column) -> Column:
            own = F.array_join(F.slice(words, low + 1, high - low), " ")
            return F.when(high < F.size(words), F.concat(own, F.lit(" "))).otherwise(own)

        def between(e: Column) -> Column:
            return F.zip_with(F.slice(e, F.lit(1), F.size(e) - 1), F.slice(e, F.lit(2), F.size(e)), part)

        return _let(edges, between)

    return _let(F.split(line, " "), parts)


def _marked(text: Column) -> Column:
    """The text with the mark after each end of a line; a pattern of all ends would take four times as long."""
    out = F.replace(F.regexp_replace(text, STOP, f"$0{_MARK}"), F.lit("\n"), F.lit("\n" + _MARK))
    has_sign = reduce(lambda a, b: a | b, (F.contains(text, F.lit(sign)) for sign in SIGNS))
    return _let(out, lambda x: F.when(has_sign, F.regexp_replace(x, SIGN, f"$0{_MARK}")).otherwise(x))


def pieces(text: Column) -> Column:
    """The lines of a text, with what separates them; they make up the text."""
    text = F.coalesce(text, F.lit(""))
    # the ends are marked and the text split there; a text that has the mark itself is split at its ends one by one
    slowly = F.split(text, f"(?<={ENDS})")
    lines = F.when(F.contains(text, F.lit(_MARK)), slowly).otherwise(F.split(_marked(text), _MARK))
    sentences = F.filter(lines, lambda s: s != "")
    return F.flatten(F.transform(sentences, lambda s: F.when(_spaces(s) < LONGEST, F.array(s)).otherwise(_cut_by_content(s))))


def bare(piece: Column) -> Column:
    """A line without the white space at its end; empty if there is nothing else."""
    return F.rtrim(piece, F.lit(BLANK))


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc, part, chars, at, h, m, w): numbers, two hashes and words of the lines of (doc, part, text), no blank ones."""
    lines = F.transform(pieces(F.col("text")), lambda x, i: F.struct(i.alias("at"), bare(x).alias("line")))
    lines = F.filter(lines, lambda x: x["line"] != "")
    weight = lambda x: F.greatest(_spaces(x) + 1, F.floor(F.length(x) / WORD_CHARS).cast("int"))
    lines = F.transform(
        lines,
        lambda x: F.struct(
            x["at"].alias("at"), F.xxhash64(x["line"]).alias("h"), F.hash(x["line"]).alias("m"), weight(x["line"]).alias("w"),
            F.length(x["line"]).alias("n"),
        ),
    )
    rows = docs.select("doc", "part", lines.alias("lines"))
    chars = F.aggregate("lines.n", F.lit(0), lambda a, b: a + b)
    return rows.select("doc", "part", chars.alias("chars"), *(f"lines.{c}" for c in "at h m w".split()))


def _spans(hashes: DataFrame) -> DataFrame:
    """The rows of ``hashes``, once for each window, with ``first``, its first place in the arrays, and ``size``, its lines."""
    h, w, n, back = F.col("h"), F.col("w"), F.size("h"), F.col("back")
    words = lambda first, size: F.aggregate(F.slice(w, first, size), F.lit(0), lambda a, b: a + b)

    def enough(i: Column, step: int) -> Column:
        total, out = F.get(w, i), None
        for k in range(1, WORDS + 1):
            out = F.when(total >= WORDS, k) if out is None else out.when(total >= WORDS, k)
            total = total + F.get(w, i + step * k)
        return out

    # functions of arrays are interpreted and find the sizes only, once a text; what follows for each window is compiled
    rows = hashes.where(n > 0).withColumn("back", _let(n - 1, lambda i: enough(i, -1)))
    # few words: the text is a window; else one begins with each line before the last one, which ends the text
    whole = F.when(F.col("chars") >= MIN_CHARS, n)
    last = F.when(words(n - back + 1, back - 1) >= WORDS, back)
    every = F.concat(F.transform(F.sequence(F.lit(0), n - back), lambda i: enough(i, 1)), F.array(last))
    rows = rows.withColumn("sizes", F.when(back.isNull(), F.array(whole)).otherwise(every))
    # not posexplode, for which the sizes would be found a second time, to see whether there are any
    rows = rows.select("*", F.posexplode_outer("sizes").alias("i", "size")).where("size IS NOT NULL")
    ends = F.col("i") == F.size("sizes") - 1
    return rows.withColumn("first", F.when(ends, n - F.col("size")).otherwise(F.col("i")))


def _fingerprints(hashes: DataFrame) -> DataFrame:
    """(print): line hashes that are the least of two neighbours, the first of equal ones, and those of lines that are windows."""
    h, i = F.col("h"), F.col("i")
    least = (F.col("print") <= F.get(h, i + 1)) | (F.col("print") < F.get(h, i - 1))
    return (
        hashes.select("h", "w", F.posexplode("h").alias("i", "print"))
        .where(F.coalesce(least, F.lit(False)) | (F.get("w", i) >= WORDS) | (F.size(h) == 1))
        .select("print")
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc, part, gone): the numbers of the lines in windows that stand earlier too."""
    hashes = stored(line_hashes(docs), "lines")
    prints = _fingerprints(hashes)
    prints = stored(prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"), "prints")
    first, size = F.col("first"), F.col("size")
    lines, one = F.slice("h", first + 1, size), F.get("h", first)
    windows = _spans(hashes).select(
        "doc", "part", F.when(size == 1, one).otherwise(F.least(one, F.get("h", first + 1))).alias("print"),
        F.xxhash64(lines).alias("window"), F.hash(F.slice("m", first + 1, size)).alias("check"),
        F.get("at", first).alias("first"), F.get("at", first + size - 1).alias("last"),
    )
    likely = stored(windows.join(prints, "print", "left_semi"), "likely-windows")
    key = ["print", "window", "check"]
    place = F.struct("doc", "part", "first")
    first = likely.groupBy(*key).agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
    first = stored(first.where("n > 1").select(*key, "earliest"), "first-places")
    later = likely.join(first, key).where(place != F.col("earliest"))
    found = later.groupBy("doc", "part").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    covered = F.transform("found", lambda s: F.sequence(s["first"], s["last"]))
    return stored(found.select("doc", "part", F.array_distinct(F.flatten(covered)).alias("gone")), "repeated-lines")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their columns, repeated lines taken out of ``text_col``, and a last one, ``removed_lines``.

    A run is repeated if it stands earlier in the same text or in one of a smaller id (NULL first, then by the hash of the
    text). The first copy stays. A NULL text stays NULL, an empty one empty; what is left of a text that is one repeated
    run is empty. Rows that repeat both id and text are one document and are cut alike, as often as its lines repeat
    elsewhere. An empty table gives no row. Other columns may have any names; one called ``removed_lines`` stays, before
    the one that is added.
    """
    others = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text_col]
    keyed = docs.select(
        F.struct(*others).alias("row"),
        F.col(id_col).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("part"),
        F.col(text_col).alias("text"),
    )
    found = repeated_lines(keyed.select("doc", "part", "text"))
    found = found.select(F.col("doc").alias("d"), F.col("part").alias("p"), "gone")
    both = keyed.join(found, F.col("doc").eqNullSafe(F.col("d")) & (F.col("part") == F.col("p")), "left")
    both = both.select("row", "text", "gone", F.when(F.col("gone").isNotNull(), pieces(F.col("text"))).alias("all"))
    # "all" is used twice, so it is computed once and not again for each of its elements
    kept = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), "gone")
    text = F.coalesce(F.array_join(F.transform(kept, lambda i: F.get("all", i)), ""), F.col("text"))
    columns = [(text if c == text_col else F.col(f"row.c{k}")).alias(c) for k, c in enumerate(docs.columns)]
    return both.select(*columns, F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("removed_lines"))
