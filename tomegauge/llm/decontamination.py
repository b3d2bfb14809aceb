"""Benchmark passages in documents, found by CGK embeddings and bit-sampling LSH.

Windows are set at anchors, places with one of the four-byte grams chosen from the items: in each stretch of
``STRETCH`` bytes the one that the items have least often, so that texts hold few of them. From
an anchor on, random walks (CGK) turn the text into longer strings, such that few edits become
few differing places. Tables of sampled places of these walks hash the windows; one that meets a window of an item in any of the
``TABLES`` tables, and shows the same at enough steps, is a candidate. It is then embedded over the whole size of the
item, by walks from the anchor to either end, and dropped if the places sampled from them clearly differ. What is left is
verified by exact edit distance against every passage around the window. Window and item are compared
with A-Z in lower case and runs of white space as one blank; words play no part.

An anchor outlives edits of a fifth of the characters with a chance of 0.4; an item of 100 bytes has five or more. Recall
against brute force is at least 0.9 with 10, 16 and 20 % of the characters edited (test), as long as the edits
are within the share that ``SIMILARITY`` allows; shorter items are found less surely. An item that occurs unchanged, with its blanks, is always found. Windows that
look alike within one item are kept once, so a repetitive item sets as few as any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomegauge.llm.common import ready_for_python
from tomegauge.llm.hashing import fold, seeded

SIMILARITY = 0.8
#: Items of fewer characters are no evidence and are left out; longer ones are searched in pieces of this many bytes.
LEAST, PIECE = 20, 1000
#: Characters of items that one pass over the documents looks for; more items take more passes.
BLOCK = 1_000_000
#: Bytes of a gram, and bytes of an item that hold one chosen gram at least.
GRAM, STRETCH = 4, 18
#: Walks from an anchor, their steps, and the tables of so many places that are sampled from them.
WALKS, STEPS, TABLES, PLACES = 2, 56, 12, 7
#: Share of the steps at which a candidate shows the same as the item.
AGREE = 0.6
#: Walks over windows of the item's size, the places sampled of each, and the part of a walk, in lengths of the
#: window, from which they are taken; later on most walks have left their text.
LONG_WALKS, SAMPLED, REACH = 2, 96, 1.8
#: Least share of these places at which a candidate shows the same as the item.
CLOSE = 0.24
#: What walks show beyond an item and beyond a text: bytes that UTF-8 has not, so that no end looks like another.
ITEM_GAP, TEXT_GAP = b"\xff", b"\xfe"
#: Windows embedded at once; and those of the size of an item.
ROOM, CHECKED = 8192, 1024


def plain(text: str | None) -> bytes:
    return b" ".join(fold(text).split())


def pieces(item: bytes) -> list[bytes]:
    """The item, or parts of about equal size where it is long."""
    count = -(-len(item) // PIECE)
    size = -(-len(item) // count)
    return [item[k : k + size] for k in range(0, len(item), size)]


def edits(item: bytes, text: bytes) -> int:
    """Least edit distance between the item and any passage of the text (bit-parallel columns)."""
    places: dict[int, int] = {}
    for k, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << k
    full, top = (1 << len(item)) - 1, 1 << len(item) - 1
    up, down, score = full, 0, len(item)
    best = score
    for c in text:
        match = places.get(c, 0)
        tall, wide = match | down, (((match & up) + up) ^ up) | match | down
        more, less = down | (~(wide | up) & full), up & wide
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            best = min(best, score)
        more, less = (more << 1) & full, (less << 1) & full
        up, down = less | (~(tall | more) & full), more & tall
    return best


def _laid(texts: list[bytes], gap: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, before, between and after them as many gaps as a short walk can go; first byte and end of each."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes + STEPS) - sizes
    return np.frombuffer(gap * STEPS + b"".join(t + gap * STEPS for t in texts), dtype=np.uint8), starts, starts + sizes


def _grams(flat: np.ndarray) -> np.ndarray:
    """A hash of 24 bits for the gram at each byte."""
    wide = flat.astype(np.uint32)
    total = wide[: len(wide) - GRAM + 1].copy()
    for k in range(1, GRAM):
        total |= wide[k : len(wide) - GRAM + 1 + k] << np.uint32(8 * k)
    return (total * np.uint32(0x9E3779B1)) >> np.uint32(8)


class Index:
    """A block of items: the grams that set windows, the tables of their walks, and the walks of whole items."""

    def __init__(self, rows: list[tuple[int | None, bytes]], seed: int = 11) -> None:
        parts = [(item_id, part) for item_id, text in rows for part in pieces(text)]
        self.ids, self.texts = [p[0] for p in parts], [p[1] for p in parts]
        self.turns = (seeded(WALKS * STEPS * 256, seed) >> np.uint64(63)).astype(np.uint8).reshape(WALKS, STEPS, 256)
        spots = (seeded(TABLES * PLACES, seed + 1) >> np.uint64(11)).astype(float) / (1 << 53)
        # Each table looks at one walk; the first steps show little but the gram.
        self.spots = (GRAM + spots * (STEPS - GRAM)).astype(np.int64).reshape(TABLES, PLACES)
        self.factors = seeded(TABLES * PLACES, seed + 2).reshape(TABLES, PLACES) | np.uint64(1)

        flat, starts, ends = _laid(self.texts, ITEM_GAP)
        grams = _grams(flat)
        # Of each stretch the gram that the items have least often.
        inside = [np.arange(start, end) for start, end in zip(starts.tolist(), (ends - GRAM + 1).tolist(), strict=True)]
        counts = np.bincount(grams[np.concatenate(inside)] if inside else [], minlength=1 << 24)
        rank = counts[grams] << 24 | grams
        least = [np.minimum.reduceat(rank[own], np.arange(0, len(own), STRETCH)) for own in inside if len(own)]
        self.chosen = np.zeros(1 << 24, dtype=bool)
        self.chosen[np.concatenate(least) & (1 << 24) - 1 if least else []] = True
        places = self.anchors(grams, starts, ends)
        row = np.searchsorted(starts, places, side="right") - 1
        self.walks = np.empty((len(places), WALKS * STEPS), dtype=np.uint8)
        keys = np.empty((TABLES, len(places)), dtype=np.uint64)
        for k in range(0, len(places), ROOM):
            seen = self.walk(flat, places[k : k + ROOM])
            self.walks[k : k + ROOM] = seen.T
            keys[:, k : k + ROOM] = self.keys(seen)
        # Of windows of one item that look the same the first stands for all.
        window = np.tile(np.arange(len(places)), TABLES)
        order = np.lexsort((window, keys.ravel()))
        self.table, window = keys.ravel()[order], window[order]
        if len(window):
            again = (self.table[1:] == self.table[:-1]) & (row[window[1:]] == row[window[:-1]])
            first = np.concatenate([[True], ~again])
            self.table, window = self.table[first], window[first]
        self.window, self.item, self.offset = window, row, places - starts[row] if len(row) else places
        self.quick = np.zeros(1 << max(16, (32 * len(self.table)).bit_length()), dtype=bool)
        self.quick[(self.table & np.uint64(len(self.quick) - 1)).astype(np.int64)] = True

        longest = int(REACH * max(map(len, self.texts), default=1)) + 1
        self.long_turns = (seeded(LONG_WALKS * longest * 256, seed + 3) >> np.uint64(63)).astype(np.uint8).reshape(LONG_WALKS, longest, 256)
        self.shares = (seeded(LONG_WALKS * SAMPLED, seed + 4) >> np.uint64(11)).astype(float).reshape(LONG_WALKS, SAMPLED) / (1 << 53)
        size = ends[row] - starts[row]
        self.after, self.before = size - self.offset, self.offset
        self.shown_after = self.long_walk(flat, places, ends[row], self.after, 1)
        self.shown_before = self.long_walk(flat, places, starts[row] - 1, self.before, -1)

    def anchors(self, grams: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of the chosen grams that lie within a text, ascending."""
        places = np.flatnonzero(self.chosen[grams])
        row = np.searchsorted(starts, places, side="right") - 1
        return places[(row >= 0) & (places + GRAM <= ends[row])] if len(places) else places

    def walk(self, flat: np.ndarray, places: np.ndarray) -> np.ndarray:
        """What the walks from the places show: (walk and step, place)."""
        seen = np.empty((WALKS * STEPS, len(places)), dtype=np.uint8)
        for k in range(WALKS):
            at = places.copy()
            for step in range(STEPS):
                show = seen[k * STEPS + step]
                np.take(flat, at, out=show, mode="clip")
                at += self.turns[k, step].take(show, mode="clip")
        return seen

    def keys(self, seen: np.ndarray) -> np.ndarray:
        """The bucket of each window in each table: (table, window)."""
        found = np.empty((TABLES, seen.shape[1]), dtype=np.uint64)
        for table in range(TABLES):
            total = np.full(seen.shape[1], table, dtype=np.uint64)
            for spot, factor in zip(self.spots[table], self.factors[table], strict=True):
                total += seen[table % WALKS * STEPS + spot] * factor
            found[table] = total ^ (total >> np.uint64(32))
        return found

    def long_walk(self, flat: np.ndarray, places: np.ndarray, bounds: np.ndarray, sizes: np.ndarray, way: int) -> np.ndarray:
        """What walks from the places show that stay within the bounds, at places sampled from a walk of that size: (place, walk and sample).

        Walks of like sizes go together.
        """
        shown = np.empty((len(places), LONG_WALKS, SAMPLED), dtype=np.uint8)
        order = np.argsort(sizes, kind="stable")
        for k in range(0, len(order), CHECKED):
            some = order[k : k + CHECKED]
            bound, rows = bounds[some], np.arange(len(some))[:, None]
            seen = np.empty((int(REACH * sizes[some[-1]]) + 1, len(some)), dtype=np.uint8)
            for walk in range(LONG_WALKS):
                at = places[some]
                for step, show in enumerate(seen):
                    np.take(flat, at, out=show, mode="clip")
                    turn = self.long_turns[walk, step].take(show, mode="clip")
                    at = np.minimum(at + turn, bound) if way > 0 else np.maximum(at - turn.astype(np.int64), bound)
                spots = (REACH * self.shares[walk][None, :] * sizes[some][:, None]).astype(np.int64)
                shown[some, walk] = seen[spots, rows]
        return shown.reshape(len(places), LONG_WALKS * SAMPLED)

    def candidates(self, texts: list[bytes]) -> np.ndarray:
        """Rows ``text, item, start`` of the windows that meet a window of an item in a table, each once."""
        flat, starts, ends = _laid(texts, TEXT_GAP)
        places = self.anchors(_grams(flat), starts, ends) if len(flat) >= GRAM else np.empty(0, np.int64)
        found = []
        for k in range(0, len(places), ROOM):
            some = places[k : k + ROOM]
            seen = self.walk(flat, some)
            keys = self.keys(seen)
            keys = keys.ravel()
            own = np.flatnonzero(self.quick.take((keys & np.uint64(len(self.quick) - 1)).view(np.int64)))
            wanted = keys[own]
            low = np.searchsorted(self.table, wanted, side="left")
            count = np.searchsorted(self.table, wanted, side="right") - low
            own, low, count = own[count > 0] % len(some), low[count > 0], count[count > 0]
            spot = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            pairs = np.repeat(own, count), self.window[spot]
            seen = np.ascontiguousarray(seen.T)
            for j in range(0, len(spot), ROOM):
                own, window = pairs[0][j : j + ROOM], pairs[1][j : j + ROOM]
                near = np.count_nonzero(seen[own] == self.walks[window], axis=1) >= AGREE * WALKS * STEPS
                found.append(some[own[near]] * len(self.item) + window[near])
        place, window = np.divmod(np.unique(np.concatenate(found)) if found else np.empty(0, np.int64), max(1, len(self.item)))
        row = np.searchsorted(starts, place, side="right") - 1
        close = self.closeness(flat, place, starts[row], ends[row], window) >= CLOSE
        start = np.maximum(0, place - starts[row] - self.offset[window])
        return np.unique(np.stack([row, self.item[window], start], axis=1)[close], axis=0)

    def closeness(self, flat: np.ndarray, places: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Share of the places sampled over the item's size, before and after the anchor, at which text and item show the same."""
        after, before = self.after[window], self.before[window]
        right = (self.long_walk(flat, places, ends, after, 1) == self.shown_after[window]).mean(axis=1)
        left = (self.long_walk(flat, places, starts - 1, before, -1) == self.shown_before[window]).mean(axis=1)
        return (right * after + left * before) / np.maximum(1, after + before)

    def search(self, texts: list[str | None], similarity: float) -> list[dict[int, int]]:
        """Per text the items found in it, with the least edit distance seen."""
        results: list[dict[int, int]] = [{} for _ in texts]
        data = [plain(t) for t in texts]
        tried: set[tuple[int, int, int]] = set()
        for row, item, at in self.candidates(data).tolist():
            size = len(self.texts[item])
            most = int(size * (1 - similarity) + 1e-9)
            slot = (row, item, at // max(1, most))
            if slot in tried or results[row].get(item, most + 1) == 0:
                continue
            tried.add(slot)
            distance = edits(self.texts[item], data[row][max(0, at - 2 * most) : at + size + 2 * most])
            if distance <= min(most, results[row].get(item, most)):
                results[row][item] = distance
        return results


@lru_cache(maxsize=1)
def index_of(rows: tuple[tuple[int | None, bytes], ...]) -> Index:
    """The index of a block, built once per worker; only the items travel."""
    return Index(list(rows))


def blocks(items: DataFrame) -> Iterator[tuple[tuple[int | None, bytes], ...]]:
    """Items with enough characters, in blocks of bounded size; equal texts are searched once per id."""
    block, size = [], 0
    rows = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        text = plain(row.text)
        if len(text.decode("utf-8", "surrogatepass")) < LEAST:
            continue
        block.append((row.item_id, text))
        size += len(text)
        if size >= BLOCK:
            yield tuple(block)
            block, size = [], 0
    if block:
        yield tuple(block)


def _rows(block: tuple[tuple[int | None, bytes], ...], similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(block)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            out = []
            for doc_id, found in zip(doc_ids, index.search(batch.column("text").to_pylist(), similarity), strict=True):
                out += [(doc_id, index.ids[k], k, d, len(index.texts[k])) for k, d in found.items()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "piece", "distance", "item_bytes"])

    return run


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, distance, similarity``.

    ``docs(doc_id, text)`` against ``items(item_id, text)``. ``distance`` is the least
    edit distance, in bytes, between a piece of the item and a passage; ``similarity`` is one minus its
    share of the piece. Null, empty and very short items are found nowhere, and
    null and empty texts hold nothing. Rows that repeat are reported as one.
    Other columns are ignored; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, piece long, distance long, item_bytes long"
    found = spark.createDataFrame([], schema)
    for block in blocks(items):
        found = found.union(source.mapInArrow(_rows(block, similarity), schema))
    share = 1 - F.col("distance") / F.col("item_bytes")
    best = found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("distance", share.alias("s")), F.struct(share, -F.col("piece"))).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.distance").alias("distance"), F.col("b.s").alias("similarity"))


def _clean(block: tuple[tuple[int | None, bytes], ...], similarity: float) -> Callable:
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = index_of(block)
        for texts in batches:
            yield pd.Series([not found for found in index.search(list(texts), similarity)], dtype=bool)

    return clean


def decontaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their columns as they were.

    Null and empty texts hold nothing and stay; rows that repeat share their fate. Null, empty and very short items are found
    nowhere. Columns may have any names; an empty table on either side drops nothing.
    """
    ready_for_python(docs.sparkSession)
    for block in blocks(items):
        docs = docs.where(_clean(block, similarity)("text"))
    return docs
