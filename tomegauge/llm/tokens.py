"""Texts to token ids, written as wavelet matrices in contiguous shards and read back.

A tokenizer that splits at white space gives a text the ids of its words one after the other,
so each distinct word is encoded once per Python worker and looked up in arrays from then on. Documents go to
their shards in ascending order of their ids; a shard is one file in the shared folder.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tomegauge.llm.common import partitions_for, range_splits, ready_for_python, with_range
from tomegauge.llm.hashing import _SPACE, mix
from tomegauge.llm.wavelet import WaveletMatrix
from tomegauge.session import scratch_path

#: Tokens after which a shard is full. A single longer document makes a longer shard.
SHARD_TOKENS = 2_000_000
#: Words whose ids a worker remembers, a power of two; when it is full, those not used since the last time are forgotten.
REMEMBERED = 1 << 20
#: Words encoded in one call.
TOGETHER = 256
#: Bytes of texts worked on at once; a longer text is worked on alone.
TEXT_BYTES = 2 << 20


class WordIds:
    """Ids of words in numpy arrays: an open-addressed table from a word's bytes to its place in a pool of ids.

    A word of up to 24 bytes is held as three integers and compared whole; longer words are in a dictionary.
    """

    LANES = 3

    def __init__(self, kind: str, size: int = REMEMBERED) -> None:
        self.kind, self.most = kind, size
        self.slots = 2 * size
        self.clear()

    def clear(self) -> None:
        self.words = 0
        self.lanes = np.zeros((self.slots, self.LANES), dtype=np.uint64)
        self.length = np.zeros(self.slots, dtype=np.uint8)  # 0: free
        self.start = np.zeros(self.slots, dtype=np.int64)
        self.count = np.zeros(self.slots, dtype=np.int32)
        self.used = np.zeros(self.slots, dtype=bool)
        self.pool, self.filled = np.zeros(1 << 16, dtype=self.kind), 0
        self.long: dict[bytes, tuple[int, int]] = {}

    def add_ids(self, ids: np.ndarray) -> int:
        """Put ids at the end of the pool; gives their place."""
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), dtype=self.kind)])
        at = self.filled
        self.pool[at : at + len(ids)] = ids
        self.filled += len(ids)
        return at

    @classmethod
    def cut(cls, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The bytes of words as integers, filled up with zeros; ``data`` goes on for 24 bytes after the last word."""
        eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
        lanes = np.empty((len(starts), cls.LANES), dtype=np.uint64)
        for lane in range(cls.LANES):
            have = np.clip(lengths - 8 * lane, 0, 8)
            lanes[:, lane] = eight[np.minimum(starts + 8 * lane, len(eight) - 1)] & _MASKS[have]
        return lanes

    def _slot(self, lanes: np.ndarray) -> np.ndarray:
        mixed = mix(mix(mix(lanes[:, 2]) ^ lanes[:, 1]) ^ lanes[:, 0])
        return (mixed >> np.uint64(64 - self.slots.bit_length() + 1)).astype(np.int64)

    def find(self, lanes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The slot of each word, -1 where it is not known."""
        found = np.full(len(lanes), -1, dtype=np.int64)
        open_, slot = np.arange(len(lanes)), self._slot(lanes)
        while len(open_):
            own = self.length[slot]
            same = (own == lengths[open_]) & (self.lanes[slot] == lanes[open_]).all(axis=1)
            found[open_[same]] = slot[same]
            on = ~same & (own > 0)
            open_, slot = open_[on], (slot[on] + 1) & (self.slots - 1)
        return found

    def insert(self, lanes: np.ndarray, lengths: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        """Add words that differ from each other and from those known."""
        open_, slot = np.arange(len(lanes)), self._slot(lanes)
        while len(open_):
            _, first = np.unique(slot, return_index=True)
            first = first[self.length[slot[first]] == 0]
            taken, who = slot[first], open_[first]
            self.lanes[taken], self.length[taken] = lanes[who], lengths[who]
            self.start[taken], self.count[taken], self.used[taken] = starts[who], counts[who], True
            left = np.ones(len(open_), dtype=bool)
            left[first] = False
            open_, slot = open_[left], (slot[left] + 1) & (self.slots - 1)
        self.words += len(lanes)

    def make_room(self, words: int) -> None:
        """Forget the words not used since the last time if so many more do not fit; all of them if that is not enough."""
        if self.words + len(self.long) + words <= self.most:
            return
        kept = np.flatnonzero(self.used)
        lanes, lengths, start, count, pool = self.lanes[kept], self.length[kept], self.start[kept], self.count[kept], self.pool
        self.clear()
        if len(kept) + words <= self.most // 2:
            ends = np.cumsum(count)
            places = np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
            at = self.add_ids(pool[places])
            self.insert(lanes, lengths, at + ends - count, count)
            self.used[:] = False


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


class Encoder:
    """The ids of texts by a tokenizer given as JSON. The ids of words are remembered.

    Words are cut at ASCII white space only, so that other characters reach the tokenizer.
    It must drop white space and treat the words between alone, as word-end BPE does.
    """

    _last: tuple[int, Encoder] | None = None

    def __init__(self, config: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.tokenizer = Tokenizer.from_str(config)
        # Two bytes an id where all ids fit, else four.
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = WordIds(self.kind, remembered)
        self.mark = self._mark()

    @classmethod
    def of(cls, config: str) -> Encoder:
        mark = zlib.crc32(config.encode())
        if cls._last is None or cls._last[0] != mark:
            cls._last = (mark, cls(config))
        return cls._last[1]

    def _mark(self) -> tuple[str, int] | None:
        """A character that is one id as a word of its own; it tells words apart that are encoded together."""
        for mark in "|~^=+":
            ids = self.tokenizer.encode(f"a {mark} b", add_special_tokens=False).ids
            if len(ids) == 3 and self.tokenizer.encode(mark, add_special_tokens=False).ids == ids[1:2]:
                return mark, ids[1]
        return None

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Put the ids of words into the pool; gives the place and the number of each word's.

        Many words are encoded as one text with marks between them. Words that hold the mark or an added token, which may take
        white space along, are encoded alone, and so is a group in which the number of marks is not what it must be.
        """
        start, count = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        apart = [*self.added, self.mark[0].encode()] if self.mark else [b""]
        whole = b" ".join(words)
        apart = [a for a in apart if a in whole]
        plain = [k for k, w in enumerate(words) if not any(a in w for a in apart)] if apart else range(len(words))
        alone = set(range(len(words))) - set(plain) if apart else set()
        groups = [plain[at : at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        between = f" {self.mark[0]} ".encode() if self.mark else b""
        texts = [between.join([words[k] for k in group]).decode("utf-8", "replace") for group in groups]
        for group, one in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(one.ids, dtype=self.kind)
            marks = np.flatnonzero(ids == self.mark[1])
            if len(marks) != len(group) - 1:
                alone.update(group)
                continue
            at, edges = self.known.add_ids(ids), np.concatenate([[-1], marks, [len(ids)]])
            start[group], count[group] = at + edges[:-1] + 1, np.diff(edges) - 1
        for k in sorted(alone):
            ids = self.tokenizer.encode(words[k].decode("utf-8", "replace"), add_special_tokens=False).ids
            start[k], count[k] = self.known.add_ids(np.array(ids, dtype=self.kind)), len(ids)
        return start, count

    def _places(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of ids of each word; those not known are encoded."""
        known, lengths = self.known, ends - starts
        short = np.flatnonzero(lengths <= 8 * known.LANES)
        first, last = int(starts[0]), int(ends[-1])
        array = np.frombuffer(data[first:last] + bytes(32), dtype=np.uint8)
        lanes = known.cut(array, starts[short] - first, lengths[short])
        sizes = lengths[short].astype(np.uint8)
        slots = known.find(lanes, sizes)
        long = [(k, data[starts[k] : ends[k]]) for k in np.flatnonzero(lengths > 8 * known.LANES).tolist()]
        missing = np.flatnonzero(slots < 0)
        if len(missing) or any(w not in known.long for _, w in long):
            fresh = {data[starts[k] : ends[k]]: at for at, k in zip(missing.tolist(), short[missing].tolist(), strict=True)}
            fresh_long = list({w for _, w in long} - known.long.keys())
            before = known.words
            known.make_room(len(fresh) + len(fresh_long))
            if known.words != before or any(w not in known.long and w not in fresh_long for _, w in long):
                return self._places(data, starts, ends)  # some were forgotten
            place, number = self.learn([*fresh, *fresh_long])
            rows = np.array(list(fresh.values()), dtype=np.int64)
            known.insert(lanes[rows], sizes[rows], place[: len(rows)], number[: len(rows)])
            known.long.update(zip(fresh_long, zip(place[len(rows) :].tolist(), number[len(rows) :].tolist(), strict=True), strict=True))
            slots[missing] = known.find(lanes[missing], sizes[missing])
        start, count = np.empty(len(starts), dtype=np.int64), np.empty(len(starts), dtype=np.int64)
        known.used[slots] = True
        start[short], count[short] = known.start[slots], known.count[slots]
        for k, word in long:
            start[k], count[k] = known.long[word]
        return start, count

    def _ids(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has; so many words at once that their ids can be remembered together."""
        found, counts, step = [np.empty(0, dtype=self.kind)], [np.empty(0, dtype=np.int64)], max(1, self.known.most // 4)
        for at in range(0, len(starts), step):
            start, count = self._places(data, starts[at : at + step], ends[at : at + step])
            sums = np.cumsum(count)
            found.append(self.known.pool[np.repeat(start - (sums - count), count) + np.arange(sums[-1])])
            counts.append(count)
        return np.concatenate(found), np.concatenate(counts)

    def packed(self, texts: list[bytes | None], end: int) -> list[bytes]:
        """Per text its ids and the end id, one after the other in ``kind``."""
        out, at = [], 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop] or b"") <= TEXT_BYTES):
                size, stop = size + len(texts[stop] or b""), stop + 1
            part = [t or b"" for t in texts[at:stop]]
            data = b"\n".join(part)
            blank = _SPACE[np.frombuffer(data, dtype=np.uint8)]
            edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
            starts, ends = edges[::2], edges[1::2]
            ids, count = self._ids(data, starts, ends)
            # The end of each text comes after its last word.
            upto = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in part]))
            sums = np.concatenate([[0], np.cumsum(count)])[upto]
            ids = np.insert(ids, sums, end)
            bounds = (sums + np.arange(1, len(part) + 1)).tolist()
            out += [ids[a:b].tobytes() for a, b in zip([0, *bounds[:-1]], bounds, strict=True)]
            at = stop
        return out

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        packed = self.packed([(t or "").encode("utf-8", "replace") for t in texts], end)
        return [np.frombuffer(ids, dtype=self.kind).astype("<u4") for ids in packed]


def _encode(config: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = Encoder.of(config)
            width = bytes([int(encoder.kind[-1])])  # the first byte says how wide the ids are
            packed = [width + ids for ids in encoder.packed(batch.column("text").to_pylist(), end)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_tie"), batch.column("_place"), pa.array(packed, pa.binary())],
                ["doc_id", "_tie", "_place", "ids"],
            )

    return run


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u2" if data[0] == 2 else "<u4", offset=1).astype(np.uint32)


def _write(folder: str, shard_tokens: int):
    def put(name: str, data: bytes) -> None:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        half = f"{path}/{name}.{uuid.uuid4().hex}.half"
        with store.open_output_stream(half) as out:
            out.write(data)
        store.move(half, f"{path}/{name}")  # whole or not at all; a repeated task puts the same file again

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, part, ids, documents, size, done = None, 0, [], [], 0, []

        def close() -> None:
            nonlocal part, ids, documents, size
            if documents:
                put(f"{place:08d}-{part:06d}.wm", WaveletMatrix.pack(ids, documents))
                done.append((f"{place:08d}-{part:06d}.wm", place, part, len(documents), size))
                part, ids, documents, size = part + 1, [], [], 0

        for batch in batches:
            for at, doc_id, data in zip(*(batch.column(c).to_pylist() for c in ("_place", "doc_id", "ids")), strict=True):
                if at != place:
                    close()
                    place, part = at, 0
                tokens = unpacked(data)
                if size + len(tokens) > shard_tokens:
                    close()
                ids.append(doc_id)
                documents.append(tokens)
                size += len(tokens)
        close()
        columns = list(zip(*done, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "place", "part", "docs", "tokens"])

    return run


def write_shards(docs: DataFrame, folder: str, config: str, end: int, shard_tokens: int = SHARD_TOKENS, ranges: int | None = None) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write the shards to a folder that all executors share; gives their list.

    One row per file: ``file, place, part, docs, tokens``. Documents are in order
    of doc_id (null last), then of a hash of the text. Null and empty texts have the end id
    only. Rows that repeat are written as often as they occur. Extra columns are ignored; an empty table writes no file.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    parts = ranges or partitions_for(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
    rows = with_range(rows, "doc_id", range_splits(docs, "doc_id", parts), "_place")
    rows = rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(_encode(config, end), "doc_id long, _tie long, _place int, ids binary")
    rows = rows.repartition(parts, "_place").sortWithinPartitions("_place", F.col("doc_id").asc_nulls_last(), "_tie")
    listed = rows.mapInArrow(_write(folder, shard_tokens), "file string, place long, part long, docs long, tokens long")
    path = scratch_path(spark, "shard-list")
    listed.write.parquet(path)
    return spark.read.schema(listed.schema).parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, data in zip(batch.column("file"), batch.column("content"), strict=True):
            found = WaveletMatrix(data.as_py()).documents()
            sums = [zlib.crc32(t.astype("<u4").tobytes()) for _, _, t in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file.as_py()] * len(found)), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([len(f[2]) for f in found], pa.int64()), pa.array(sums, pa.int64())],
                ["file", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, file`` of every document in the files of a folder.

    ``start`` counts the ids of all documents before, over all shards in order. What holds for nulls, empty texts and
    repeats was settled when the files were written. A folder without files cannot be read.
    """
    spark = shards.sparkSession
    order = Window.orderBy("place", "part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    first = shards.select(F.col("file").alias("name"), F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("first"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    rows = files.mapInArrow(_read, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")
    rows = rows.join(first, F.col("file") == F.col("name"))
    return rows.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "file")


def round_trip(docs: DataFrame, config: str, end: int, shard_tokens: int = SHARD_TOKENS, ranges: int | None = None) -> DataFrame:
    """Write the shards of ``docs`` to the scratch folder and read them back: one row per row of ``docs``.

    Null and empty texts are the end id alone. Repeated rows and ids are documents of their own; a null doc_id comes last.
    Other columns are ignored; an empty table gives no rows.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    shards = write_shards(docs, folder, config, end, shard_tokens, ranges)
    if shards.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, file string")
    return read_shards(shards, folder)
