"""Token ids in binary record files with a separate offset index.

A file holds frames: length of the payload (8 bytes), masked checksum of these 8 bytes (4), payload, masked checksum
of the payload (4); all numbers are little-endian. The payload is a flag byte (1: there is a document id), the
document id (8 bytes), the bytes of one token id (1) and the ids. Beside ``part-N.rec`` stands ``part-N.idx``: for each
frame its offset in the file and the number of its tokens (8 bytes each), so readers can fetch frames in any order.

Files are in ascending order of the document ids, and so are the frames of a file. A task writes under a name of its
own and renames at the end, so a repeated task leaves the same files.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ludolytics.llm.common import WordHasher, WordMemory, byte_class, held_by_worker, stored, text_slices
from ludolytics.session import scratch_path

_HEAD, _CRC, _PAYLOAD = "<QI", "<I", "<BqB"
_INDEX = np.dtype([("offset", "<u8"), ("tokens", "<u8")])
#: Parts of words whose ids a task keeps before its memory is emptied; longer ones than KEPT_LENGTH are not kept.
KEPT_PARTS = 250_000
KEPT_LENGTH = 64
#: All but space and line feed.
_WORDS = ~byte_class((0x20, 0x20), (0x0A, 0x0A))


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted so that checksums of data that holds checksums stay sound."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, width: int, ids: bytes) -> bytes:
    payload = struct.pack(_PAYLOAD, doc_id is not None, doc_id or 0, width) + ids
    size = struct.pack("<Q", len(payload))
    return size + struct.pack(_CRC, masked(size)) + payload + struct.pack(_CRC, masked(payload))


def read_frame(stream) -> tuple[int | None, np.ndarray] | None:
    """The next frame of an open file, None at its end; damage raises."""
    head = stream.read(struct.calcsize(_HEAD))
    if not head:
        return None
    if len(head) < struct.calcsize(_HEAD) or masked(head[:8]) != struct.unpack(_HEAD, head)[1]:
        raise ValueError("damaged frame length")
    size = struct.unpack(_HEAD, head)[0]
    payload, check = stream.read(size), stream.read(struct.calcsize(_CRC))
    if len(payload) < size or len(check) < struct.calcsize(_CRC) or masked(payload) != struct.unpack(_CRC, check)[0]:
        raise ValueError("damaged frame")
    has_id, doc_id, width = struct.unpack_from(_PAYLOAD, payload)
    return (doc_id if has_id else None), np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_PAYLOAD))


class WordTokenizer:
    """Ids of whole texts by a tokenizer file of the tokenizers library.

    For tokenizers that lower the case, drop white space and never join letters with other signs, the ids of a text are
    those of its words one after the other. Words are cut at spaces and line feeds, and ASCII signs around a word of
    letters are taken off it; the library gets each new part once, many at a time, and the words' ids are kept in a memory
    of bounded size. Whether a tokenizer is of this kind is tried on PROBES; texts go to the library whole if it isn't,
    and if they hold one of its special strings, which it gives ids of their own. ``plain_specials`` makes these strings
    ordinary text.
    """

    #: Not the apostrophe, which begins contractions.
    SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    PROBES = (
        "Two words, and a third.", " (spaces)  around ", "line\nfeeds\n\nand\ttabs\r\n", "it's we'll I'd O'Neil 'quoted'",
        "a1b2 3.14 1,000 x-y x--y", "e.g. i.e. U.S.A.", "\u00c9t\u00e9 stra\u00dfe \u0130stanbul \u03a3\u03c3\u03c2", "e\u0301 \u4e2d\u6587\u5b57 \U0001f600!",
        "[x] {y} <z> #tag @name & 50% $5 *b* ~c~ `d` a_b a|b a\\b", "MiXeD CaSe", "...!?", "", " ", "averylongwordwithoutanyspaceatall",
    )

    def __init__(self, path: str, end_id: int | None, plain_specials: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added if not (plain_specials and t.special)]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.end = None if end_id is None else self.kind.type(end_id)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.hasher, self.words = WordHasher(_WORDS, lower=False), WordMemory(self.kind)
        self.parts: dict[str, bytes] = {}
        self.by_words = True
        probes = [p.encode() for p in self.PROBES]
        data, offsets = np.frombuffer(b"".join(probes), dtype=np.uint8), np.cumsum([0, *map(len, probes)])
        ids, counts = self._by_words(data, offsets)
        want = [self._whole(p) for p in probes]
        self.by_words = counts.tolist() == [len(w) for w in want] and ids.tolist() == np.concatenate(want).tolist()

    def split(self, word: str) -> tuple[str, ...]:
        """Parts that are tokenized alike alone and in the word."""
        core = word.strip(self.SIGNS)
        if not core or not (core[0].isalpha() and core[-1].lower().isalpha()):
            return (word,)
        shown = core.lower() if core.isascii() else core
        if len(core) == len(word):
            return (shown,)
        if word.startswith(core):
            return shown, word[len(core) :]
        at = word.index(core)
        return (word[:at], shown, word[at + len(core) :]) if at + len(core) < len(word) else (word[:at], shown)

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of new parts; those of letters only are one word each to the tokenizer, which marks its end."""
        known: dict[str, bytes] = {}
        for simple in (True, False):
            parts = [p for p in new if p.isalpha() == simple]
            for first in range(0, len(parts), 4096):
                some = parts[first : first + 4096]
                joined = " ".join(some)
                cuts = None
                if simple and self.ends.any():
                    ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids)
                    cuts = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
                if cuts is None or len(cuts) != len(some) + 1:
                    starts = np.cumsum([0, *(len(p) + 1 for p in some)])
                    found = self.tokenizer.encode(joined, add_special_tokens=False)
                    ids = np.array(found.ids, dtype=np.int64)
                    cuts = np.searchsorted(np.array([place for place, _ in found.offsets], dtype=np.int64), starts)
                data, cuts = ids.astype(self.kind).tobytes(), (cuts * self.width).tolist()
                known.update((part, data[low:high]) for part, low, high in zip(some, cuts[:-1], cuts[1:]))
        return known

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has) of new words."""
        split = [self.split(w.decode()) for w in words]
        if len(self.parts) > KEPT_PARTS:
            self.parts.clear()
        wanted = {p for parts in split for p in parts}
        known = self._learn([p for p in wanted if p not in self.parts])
        self.parts.update((p, ids) for p, ids in known.items() if len(p) <= KEPT_LENGTH)
        find = lambda p: self.parts[p] if p in self.parts else known[p]
        found = [b"".join(map(find, parts)) for parts in split]
        return np.frombuffer(b"".join(found), self.kind), np.array([len(f) for f in found], dtype=np.int64) // self.width

    def _by_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, edges, starts, ends = self.hasher(data, offsets)
        ids, counts = self.words(data, starts, ends, hashes, self.learn)
        return ids, np.diff(np.append(0, np.cumsum(counts))[edges])

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=self.kind)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each of some texts, and the end id."""
        whole = data.tobytes()
        texts = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
        if not self.by_words:
            found = [self._whole(whole[a:b]) for a, b in texts]
        else:
            ids, counts = self._by_words(data, offsets)
            found = np.split(ids, np.cumsum(counts)[:-1])
            if any(s in whole for s in self.special):
                for k, (a, b) in enumerate(texts):
                    if any(s in whole[a:b] for s in self.special):
                        found[k] = self._whole(whole[a:b])
        return found if self.end is None else [np.append(f, self.end) for f in found]


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenize whole texts and write them to ``folder``; returns one row a file: (part, n_records, n_tokens, n_bytes).

    ``folder`` must be reachable from all executors. Ids are whole numbers, as bigint or as text that can be cast to it;
    other text is an error. NULL and empty texts make a record with the end id alone; a NULL doc_id comes first; rows that
    share a doc_id stand one after the other in any order, in several files if there are very many; an empty table writes
    no file. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _file_system(folder)
        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        names = [(f"{base}/.{own}.{kind}", f"{base}/part-{part:06d}.{kind}") for kind in ("rec", "idx")]
        out, places, offset = None, [], 0
        encode = held_by_worker(("words", tokenizer, end_id), lambda: WordTokenizer(tokenizer, end_id))
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(names[0][0])
                for doc_id, ids in zip(batch.column(0).slice(first, len(offsets) - 1).to_pylist(), encode(data, offsets)):
                    framed = frame(doc_id, encode.width, ids.tobytes())
                    out.write(framed)
                    places.append((offset, len(ids)))
                    offset += len(framed)
        if out is None:
            return
        out.close()
        index = np.array(places, dtype=_INDEX)
        with files.open_output_stream(names[1][0]) as stream:
            stream.write(index.tobytes())
        for temporary, final in names:
            files.move(temporary, final)
        numbers = (part, len(index), int(index["tokens"].sum()), offset)
        yield pa.record_batch([pa.array([x], pa.int64()) for x in numbers], ["part", "n_records", "n_tokens", "n_bytes"])

    kinds = "part bigint, n_records bigint, n_tokens bigint, n_bytes bigint"
    return stored(_in_order(docs, id_col, text_col).mapInArrow(run, kinds), "record-files")


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) in ranges of about as many rows each, sorted; an id of very many rows is dealt to several ranges.

    The bounds of the ranges are quantiles of the ids alone, so texts are read once. An id that is several bounds goes
    to any of the ranges between them, by a hash of the text.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    number = F.coalesce("id", F.lit(-(1 << 63)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [k / n for k in range(1, n)]
    found = rows.agg(F.percentile_approx(number, F.array(*map(F.lit, steps)), 100 * n)).first()[0] if steps else None
    if not found:
        return rows.coalesce(1).sortWithinPartitions("id") if n == 1 else rows.sortWithinPartitions("id")
    bounds = F.array(*map(F.lit, found))

    def passed(under: bool) -> Column:
        """How many bounds are less than the id, or not more than it; found by halving."""
        at = F.lit(0)
        for step in reversed([1 << k for k in range(len(found).bit_length())]):
            bound = F.get(bounds, at + (step - 1))
            at = at + F.when(bound < number if under else bound <= number, step).otherwise(0)
        return at

    low, high = passed(True), passed(False)
    ranged = rows.withColumn("low", low).withColumn("high", high)
    spread = F.pmod(F.xxhash64("text"), F.col("high") - F.col("low") + 1)
    ranged = ranged.select("id", "text", (F.col("low") + spread).cast("int").alias("range"))
    return ranged.repartitionById(n, "range").select("id", "text").sortWithinPartitions("id")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, token_ids) of every record; start counts the ids of all records before it.

    A file that is damaged or cut off raises. An empty manifest gives no row.
    """

    def rows(records: list[tuple]) -> pa.RecordBatch:
        return _rows(records)

    return _read(manifest, folder, rows, "doc_id bigint, start bigint, token_ids array<int>")


def record_checksums(manifest: DataFrame, folder: str) -> DataFrame:
    """``checksums`` of ``read_records``, in one pass over the files."""

    def rows(records: list[tuple]) -> pa.RecordBatch:
        sizes = [len(ids) for _, _, ids in records]
        crc = [zlib.crc32(ids.astype("<u4").tobytes()) for _, _, ids in records]
        columns = [[r[0] for r in records], [r[1] for r in records], sizes, crc]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _read(manifest, folder, rows, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _read(manifest: DataFrame, folder: str, make: Callable[[list[tuple]], pa.RecordBatch], kinds: str) -> DataFrame:
    """What ``make`` makes of the (doc_id, start, ids) of some records at a time."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = manifest.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_stream(f"{root}/part-{part:06d}.rec", buffer_size=1 << 20) as stream:
                    rows, held = [], 0
                    while (record := read_frame(stream)) is not None:
                        rows.append((record[0], base, record[1]))
                        base += len(record[1])
                        held += len(record[1])
                        if held > 1 << 20:
                            yield make(rows)
                            rows, held = [], 0
                    if rows:
                        yield make(rows)

    files = max(1, manifest.count())
    return starts.repartition(files, "part").mapInArrow(run, kinds)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    ids = np.concatenate([r[2] for r in rows]).astype(np.int32)
    offsets = np.cumsum([0, *(len(r[2]) for r in rows)])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), lists]
    return pa.record_batch(columns, ["doc_id", "start", "token_ids"])


def checksums(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): CRC-32 of each record's ids as little-endian 32-bit numbers.

    A record without ids has the CRC of no bytes, 0. Ids may be NULL or repeat; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())]
            yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return records.select("doc_id", "start", "token_ids").mapInArrow(run, kinds)


def shuffled_records(spark: SparkSession, manifest: DataFrame, folder: str, seed: int) -> DataFrame:
    """(doc_id, token_ids) of every record in an order drawn by ``seed``, fetched by the offset indexes.

    A damaged frame raises. An empty manifest gives no row.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                with files.open_input_stream(f"{root}/part-{part:06d}.idx") as stream:
                    offsets = np.frombuffer(stream.read(), dtype=_INDEX)["offset"].astype(np.int64)
                for first in range(0, len(offsets), 1 << 16):
                    some = offsets[first : first + (1 << 16)]
                    yield pa.record_batch([pa.array(np.full(len(some), part)), pa.array(some)], ["part", "offset"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                streams, out = {}, []
                for part, offset in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    if part not in streams:
                        streams[part] = files.open_input_file(f"{root}/part-{part:06d}.rec")
                    streams[part].seek(offset)
                    doc_id, ids = read_frame(streams[part])
                    out.append((doc_id, 0, ids))
                for stream in streams.values():
                    stream.close()
                yield _rows(out).select(["doc_id", "token_ids"])

    found = manifest.select("part").repartition(max(1, manifest.count()), "part")
    found = found.mapInArrow(places, "part bigint, offset bigint")
    drawn = F.xxhash64("part", "offset", F.lit(seed))
    ordered = found.withColumn("drawn", drawn).repartitionByRange("drawn").sortWithinPartitions("drawn")
    return ordered.select("part", "offset").mapInArrow(fetch, "doc_id bigint, token_ids array<int>")


def record_folder(spark: SparkSession) -> str:
    """A fresh folder for record files below the shared one."""
    return scratch_path(spark, "records")
