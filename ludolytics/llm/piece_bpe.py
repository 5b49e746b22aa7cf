"""Encoding and decoding with a byte-pair SentencePiece model by a prefix table.

For every prefix of a piece of text exactly one token can be the last of its encoding. The table stores it: of the
vocabulary's matches that end there (an automaton gives them) it is the one that starts the text, or that is compatible
with the last token of the prefix before it. Two tokens are compatible if merging their joint text ends in these two
again. The ids are read off the table backwards. No merge is carried out on the text itself.

A text is cut where no vocabulary piece can span the cut: before a space that follows another character, and between
two characters that are neighbours in no piece. Words are looked up many at a time in a memory of bounded size. New ones
go through the automaton together: a step takes one more character behind every place whose piece can still grow. Their
tables are filled together too, one length of prefix after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.common import SPACED_WORDS, WordHasher, WordMemory, held_by_worker

SPACE = "\u2581"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
#: Places of the memory of tested pairs of pieces, of nine bytes each.
PAIR_PLACES = 1 << 20
#: Characters of new words that go through the automaton together; a longer word goes alone.
STEP_CHARS = 1 << 18


class Numbered:
    """Numbers with a value each, in arrays with open addressing; ``places`` is a power of two."""

    def __init__(self, places: int, kind: type) -> None:
        self.places, self.kind = places, kind
        self.clear()

    def clear(self) -> None:
        self.key, self.value, self.held = np.full(self.places, -1), np.zeros(self.places, dtype=self.kind), 0

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each number, or the free one where it would stand."""
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - (self.places - 1).bit_length())
        at = spread.astype(np.int64)
        open_ = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (self.places - 1)
            key = self.key[at[open_]]
            open_ = open_[(key != keys[open_]) & (key >= 0)]
        return at

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, whether there is one) of each number."""
        at = self._place(keys)
        return self.value[at], self.key[at] == keys

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct numbers that it does not have; of very many only as many as fill half of it."""
        keys, values = keys[: self.places // 2], values[: self.places // 2]
        if 2 * (self.held + len(keys)) > self.places:
            self.clear()
        self.held += len(keys)
        open_ = np.arange(len(keys))
        while len(open_):
            at = self._place(keys[open_])
            self.key[at] = keys[open_]  # of several the last one gets the place
            self.value[at] = values[open_]
            open_ = open_[self.key[at] != keys[open_]]


class PieceDecoder:
    """Texts of the ids of one model; built inside a task from the model's file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        # the model of the file, read through the library only for its list of pieces
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.unknown = model.unk_id()
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in range(size) if model.is_byte(i)}
        self.control = {i for i in range(size) if model.is_control(i)}
        #: What decoding makes of each id; byte ids are joined first.
        self.shown = [p.replace(SPACE, " ") for p in self.pieces]
        self.shown = ["" if i in self.control else " \u2047 " if i == self.unknown else s for i, s in enumerate(self.shown)]
        self._prepare(model)

    def _prepare(self, model) -> None:
        """What a table needs besides."""

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; bytes that are no UTF-8 become U+FFFD one by one."""
        if not ids:
            return ""
        if self.bytes.keys().isdisjoint(ids):
            out = "".join(map(self.shown.__getitem__, ids))
        else:
            parts, run = [], bytearray()
            for i in ids:
                if i in self.bytes:
                    run.append(self.bytes[i])
                else:
                    if run:
                        parts.append(_utf8(bytes(run)))
                        run.clear()
                    parts.append(self.shown[i])
            out = "".join(parts) + _utf8(bytes(run))
        first = next((i for i in ids if i not in self.control), None)
        return out[1:] if first is not None and self.pieces[first].startswith(SPACE) else out


class PieceTable(PieceDecoder):
    """Encoder and decoder of one model."""

    def _prepare(self, model) -> None:
        byte_ids = {b: i for i, b in self.bytes.items()}
        #: Ids of a character that is no piece.
        self.spelled = (lambda c: [byte_ids[b] for b in c.encode()]) if byte_ids else (lambda c: [self.unknown])
        skipped = self.control | {self.unknown} | self.bytes.keys()
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in skipped}
        scores = {p: model.get_score(i) for p, i in self.ids.items()}
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in scores.items()}
        # characters that only longer pieces hold can be joined, but have no id of their own
        self.known = [*self.ids, *sorted({c for p in self.ids for c in p} - set(self.ids))]
        self.id_of = np.array([self.ids.get(p, -1) for p in self.known])
        self.size_of = np.array([len(p) for p in self.known])
        self.lasting: dict[str, tuple | None] = {}
        self.whole = np.array([self.merges(p) is not None for p in self.known])
        characters = sorted({c for p in self.known for c in p})
        self.code = np.zeros(0x110000, dtype=np.int32)  # 0: in no piece
        self.code[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        codes = {c: k for k, c in enumerate(characters, 1)}
        self.width = len(characters) + 1
        beside = np.unique([codes[a] * self.width + codes[b] for p in self.ids for a, b in zip(p, p[1:])])
        self.neighbours = Numbered(1 << (4 * len(beside) + 16).bit_length(), np.bool_)
        self.neighbours.put(beside, np.ones(len(beside), dtype=bool))
        # the automaton: a node for each beginning of a piece, node 0 for the empty one
        nodes, edges, piece = 1, {}, [-1]
        for k, p in enumerate(self.known):
            node = 0
            for c in p:
                step = node * self.width + codes[c]
                if step not in edges:
                    edges[step], nodes = nodes, nodes + 1
                    piece.append(-1)
                node = edges[step]
            piece[node] = k
        self.edges = Numbered(1 << (4 * len(edges) + 16).bit_length(), np.int32)
        self.edges.put(np.array(list(edges)), np.array(list(edges.values())))
        self.piece_of = np.array(piece)
        self.pairs, self.words = Numbered(PAIR_PLACES, np.bool_), WordMemory(np.int32)
        self.hasher = WordHasher(SPACED_WORDS)

    def merges(self, piece: str) -> tuple | None:
        """How merging builds a piece: (rank, first symbol after, last symbol after) of each step; None if it doesn't."""
        if piece in self.lasting:
            return self.lasting[piece]
        symbols, steps, rank = list(piece), [], self.rank
        while len(symbols) > 1:
            best = min((rank.get(a + b, 1 << 40), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if best[0] == 1 << 40:
                break
            symbols[best[1] : best[1] + 2] = [symbols[best[1]] + symbols[best[1] + 1]]
            steps.append((best[0], symbols[0], symbols[-1]))
        out = self.lasting[piece] = tuple(steps) if len(symbols) == 1 else None
        return out

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging left + right gives these two pieces again.

        Both sides' own steps run as they would alone; the next to run is the one of the best rank, of equal ones the
        leftmost. If the symbols at the border can ever be joined before that, the pieces don't stay.
        """
        a, b, rank = self.merges(left), self.merges(right), self.rank
        if a is None or b is None:
            return False
        i = j = 0
        x, y, none = left[-1], right[0], 1 << 40
        while True:
            across = rank.get(x + y, none)
            ours = a[i][0] if i < len(a) else none
            theirs = b[j][0] if j < len(b) else none
            if across < ours and across <= theirs and across < none:
                return False
            if ours <= theirs and ours < none:
                x = a[i][2]
                i += 1
            elif theirs < none:
                y = b[j][1]
                j += 1
            else:
                return True

    def fit(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether pairs of pieces, by number, are compatible; remembered."""
        keys = before.astype(np.int64) * len(self.known) + piece
        found, known = self.pairs.get(keys)
        if not known.all():
            new = np.unique(keys[~known])
            fits = [self.compatible(self.known[k // len(self.known)], self.known[k % len(self.known)]) for k in new.tolist()]
            fits = np.array(fits, dtype=bool)
            found[~known] = fits[np.searchsorted(new, keys[~known])]
            self.pairs.put(new, fits)
        return found

    def _matches(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces in the text that do not go beyond the end given for their start."""
        place, node, found = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64), []
        at = place
        while len(place):
            node, on = self.edges.get(node * self.width + codes[at])
            on &= codes[at] > 0
            place, at, node = place[on], at[on] + 1, node[on].astype(np.int64)
            piece = self.piece_of[node]
            full = piece >= 0
            found.append((place[full], at[full], piece[full]))
            on = at < ends[place]
            place, at, node = place[on], at[on], node[on]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has) of some words."""
        text = "".join(words)
        n = len(text)
        codes = self.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        edges = np.cumsum([0, *map(len, words)])
        cut = np.ones(n + 1, dtype=bool)
        if n > 1:
            cut[1:n] = ~self.neighbours.get(codes[:-1].astype(np.int64) * self.width + codes[1:])[1]
        cut[edges] = True
        firsts = np.flatnonzero(cut)
        part = np.cumsum(cut[:n]) - 1
        begin, finish = firsts[:-1][part], firsts[1:][part]
        start, end, piece = self._matches(codes, finish)
        last = np.full(n + 1, -1)  # for each prefix of a part, by its end, the number of its last token
        size = end - begin[start]
        order = np.argsort(size, kind="stable")
        start, end, piece = start[order], end[order], piece[order]
        levels = np.flatnonzero(np.append(True, np.diff(size[order]) > 0)) if len(order) else order
        for low, high in zip(levels, np.append(levels[1:], len(order))):
            s, p = start[low:high], piece[low:high]
            first = s == begin[s]
            before = np.where(first, -1, last[s])
            fits = first & self.whole[p]
            asked = np.flatnonzero(before >= 0)
            fits[asked] = self.fit(before[asked], p[asked])
            last[end[low:high][fits]] = p[fits]
        # read backwards, a token of every part at a time
        at, ends, tokens = firsts[1:], [], []
        floor = firsts[:-1]
        while len(at):
            token = last[at]
            ends.append(at)
            tokens.append(token)
            at = at - np.where(token >= 0, self.size_of[token], 1)
            at, floor = at[at > floor], floor[at > floor]
        ends = np.concatenate(ends) if ends else at
        order = np.argsort(ends)
        ends, token = ends[order], np.concatenate(tokens)[order] if tokens else at
        ids = np.where(token >= 0, self.id_of[token], -1).astype(np.int32)
        spelled = np.flatnonzero(ids < 0).tolist()
        sizes = np.ones(len(ids), dtype=np.int64)
        if spelled:
            spelling = {k: self.spelled(text[ends[k] - 1]) for k in spelled}
            sizes[spelled] = [len(x) for x in spelling.values()]
            ids, places = np.repeat(ids, sizes), np.cumsum(sizes) - sizes
            for k, own in spelling.items():
                ids[places[k] : places[k] + len(own)] = own
        sums = np.append(0, np.cumsum(sizes))[np.searchsorted(ends, edges, side="right")]
        return ids, np.diff(sums)

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has) of new words, each with the spaces before it."""
        shown, found = [w.decode().replace(" ", SPACE) for w in words], []
        sizes = np.cumsum([len(w) for w in shown]) // STEP_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(sizes) > 0) + 1).tolist(), len(shown)]
        for low, high in zip(cuts, cuts[1:]):
            found.append(self._together(shown[low:high]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each text has)."""
        # a text begins with a space, the first of a word's; an empty one has none
        shown = [b" " + text.replace(SPACE, " ").encode() if text else b"" for text in texts]
        offsets = np.cumsum([0, *map(len, shown)])
        data = np.frombuffer(b"".join(shown), dtype=np.uint8)
        space = np.append(data == 32, False)
        first = space[:-1] & np.append(True, ~space[:-2]) if len(data) else space[:-1]
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))[: len(starts)]

        ids, counts = self.words(data, starts, ends, self.hasher.ranges(data, starts, ends), self.learn)
        sums = np.append(0, np.cumsum(counts))[np.searchsorted(starts, offsets)]
        return ids, np.diff(sums)


def _utf8(data: bytes) -> str:
    """Whole characters as they are, any other byte as U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("\ufffd")
            at += 1
    return "".join(out)


def _ids_of(table: PieceTable, texts: list[str | None]) -> pa.ListArray:
    ids, counts = table.encode([text or "" for text in texts])
    offsets = np.append(0, np.cumsum(counts))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def _texts_of(table: PieceDecoder, lists: pa.ListArray) -> pa.StringArray:
    return pa.array([table.decode(ids or []) for ids in lists.to_pylist()], pa.string())


def _mapped(rows: DataFrame, id_col: str, names: list[str], other: str, columns) -> DataFrame:
    """The rows' first column and what ``columns`` makes of the second, some rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                yield pa.record_batch([part.column(0), *columns(part.column(1))], names=["doc_id", *names])

    return rows.mapInArrow(run, f"doc_id {rows.schema[id_col].dataType.simpleString()}, {other}")


def _table(model: str) -> PieceTable:
    return held_by_worker(("pieces", model), lambda: PieceTable(model))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids): one row per row, the ids the model's library gives (no begin or end id, no sampling).

    NULL and empty texts have no ids; a NULL or repeated id is passed on as it is; an empty table gives no row; other
    columns are not read. Texts are encoded whole, whatever their length. ``model`` is the path of the model's file on
    the executors.
    """

    def columns(texts: pa.Array) -> list[pa.Array]:
        return [_ids_of(_table(model), texts.to_pylist())]

    rows = docs.select(F.col(id_col), F.col(text_col))
    return _mapped(rows, id_col, ["token_ids"], "token_ids array<int>", columns)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(doc_id, token_ids, decoded): the text of each list of ids; NULL is an empty list. Rows are passed on as in encode."""

    def columns(lists: pa.Array) -> list[pa.Array]:
        return [lists, _texts_of(held_by_worker(("decoder", model), lambda: PieceDecoder(model)), lists)]

    rows = encoded.select(F.col(id_col), F.col(ids_col))
    return _mapped(rows, id_col, ["token_ids", "decoded"], "token_ids array<int>, decoded string", columns)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids, decoded): ``decode`` of ``encode``, by one worker with one table."""

    def columns(texts: pa.Array) -> list[pa.Array]:
        lists = _ids_of(_table(model), texts.to_pylist())
        return [lists, _texts_of(_table(model), lists)]

    rows = docs.select(F.col(id_col), F.col(text_col))
    return _mapped(rows, id_col, ["token_ids", "decoded"], "token_ids array<int>, decoded string", columns)
