"""Conversations as training text, checked by a grammar round trip.

The text of a conversation is the sequence of its turns, and each turn carries its own marks:

    user       [INST] text [/INST]
    assistant  <s>text</s>
    other      <<role>>text<</role>>

A turn is rendered as it is and read back by a deterministic parser. If the parser does not give back the role and the
text, the content conflicts with the marks: the turn is rendered again with a backslash before every backslash and every
bracket that can begin a mark, and read back again. The parser takes a backslash off whatever follows it. As each turn is
read back whole by itself, so is their sequence.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (opening, closing) marks of the two roles that have their own.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
_CONTROL = re.compile(r"[\\\[<>]")
#: An escaped character, or a mark without its spaces.
_TOKEN = re.compile(r"\\(?s:.)|\[/?INST\]|</?s>|<<|>>")
#: Characters of a part; a longer conversation has several parts, cut between turns.
PART_CHARS = 1 << 20


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(?s:(.))", r"\1", text)


def _render(role: str, shown: str, text: str) -> tuple[str, int, int]:
    """(turn, start and end of its text); ``shown`` is the role as it stands in its marks."""
    before, after = MARKS.get(role) or (f"<<{shown}>>", f"<</{shown}>>")
    return before + text + after, len(before), len(before) + len(text)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a rendered text; start and end are those of the text as rendered.

    Raises ValueError where the text does not follow the grammar.
    """
    turns, at = [], 0
    while at < len(text):
        for role, (before, after) in MARKS.items():
            if text.startswith(before, at):
                mark, start = after.strip(), at + len(before)
                break
        else:
            if not text.startswith("<<", at):
                raise ValueError(f"no turn at {at}")
            close = _next(text, at + 2)
            if close is None or close[0] != ">>":
                raise ValueError(f"open role at {at}")
            rendered = text[at + 2 : close[1]]
            role, start, mark, after = unescape(rendered), close[1] + 2, "<<", f"<</{rendered}>>"
        found = _next(text, start)
        if found is None or found[0] != mark:
            raise ValueError(f"open turn at {at}")
        end = found[1] - (len(after) - len(after.lstrip()))
        if end < start or not text.startswith(after, end):
            raise ValueError(f"wrong end at {end}")
        turns.append((role, unescape(text[start:end]), start, end))
        at = end + len(after)
    return turns


def _next(text: str, at: int) -> tuple[str, int] | None:
    """The next mark that is not escaped, and its place."""
    for m in _TOKEN.finditer(text, at):
        if m[0][0] != "\\":
            return m[0], m.start()
    return None


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn and the place of its text, as plain as the grammar allows."""
    for change in (str, escape):
        turn, start, end = _render(role, change(role), change(text))
        try:
            if [(r, t) for r, t, _, _ in parse(turn)] == [(role, text)]:
                return turn, start, end
        except ValueError:
            continue
    raise ValueError(f"turn of role {role!r} cannot be rendered")


_PARTS = "part bigint, n_turns bigint, formatted string, loss array<struct<start:bigint,end:bigint>>"


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss): the text of each conversation and the ranges of characters to learn.

    Rows are in the order of ``turn`` (NULL first; equal ones by role and text); repeated rows are repeated turns. NULL
    and empty texts are empty turns, a NULL role is an empty role. Rows with a NULL conv_id are one conversation. The
    texts of assistants are under the loss mask, without their marks. A conversation longer than PART_CHARS has several
    parts; they stand in order, one after the other, in one partition, and are read turn by turn, so that a conversation
    of any length passes through a task without being held. Other columns are not read.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, part, n, size, texts, loss, open_ = None, 0, 0, 0, [], [], False
        held, kind = 0, None
        for batch in batches:
            kind = batch.column(0).type
            for own, role, text in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(2), batch.column(3)))):
                if open_ and (own != conv or size >= PART_CHARS):
                    done.append((conv, part, n, "".join(texts), loss))
                    held += size
                    part = part + 1 if own == conv else 0
                    n, size, texts, loss = 0, 0, [], []
                    if held >= PART_CHARS:
                        yield _batch(done, kind, span)
                        done, held = [], 0
                conv, open_ = own, True
                turn, start, end = format_turn(role or "", text or "")
                if role == "assistant":
                    loss.append({"start": size + start, "end": size + end})
                texts.append(turn)
                size += len(turn)
                n += 1
        if open_:
            done.append((conv, part, n, "".join(texts), loss))
            yield _batch(done, kind, span)

    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role_col, text_col)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", role_col, text_col)
    kind = turns.schema[conv_col].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {kind}, {_PARTS}")


def _batch(done: list[tuple], kind: pa.DataType, span: pa.DataType) -> pa.RecordBatch:
    conv, part, n, text, loss = zip(*done)
    columns = [pa.array(conv, kind), pa.array(part, pa.int64()), pa.array(n, pa.int64()), pa.array(text), pa.array(loss, span)]
    return pa.record_batch(columns, names=["conv_id", "part", "n_turns", "formatted", "loss"])


def read_conversations(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from formatted text.

    Takes the rows of ``format_conversations`` as they come, the parts of a conversation in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[list] = []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def out(rows: list[list]) -> pa.RecordBatch:
            ready = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]] for r in rows]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], names=names)

        for batch in batches:
            kinds[0] = batch.column(0).type
            for conv, part, text, loss in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4))):
                if part == 0:
                    if len(done) >= 4096:
                        yield out(done)
                        done = []
                    done.append([conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0])
                row = done[-1]
                for role, said, _, _ in parse(text):
                    row[1] += 1
                    row[2].update(f"{role}\n{said}\n".encode())
                for r in loss:
                    learnt = unescape(text[r["start"] : r["end"]])
                    row[3] += len(learnt)
                    row[4].update(learnt.encode())
                row[5] += len(text)
        if done:
            yield out(done)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        run,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
