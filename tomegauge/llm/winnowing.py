"""Document fingerprints by winnowing.

Every run of ``GRAM`` characters is hashed. Of each ``WINDOW`` hashes in a row the
least is kept, of equal ones the rightmost, with its position. Two texts that share a
passage of at least ``GRAM + WINDOW - 1`` characters share a kept hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.llm.common import partitions_for, range_splits, ready_for_python, with_range
from tomegauge.llm.hashing import _BASE, _INVERSE, mix, powers

GRAM = 20
WINDOW = 64
#: Windows worked on at once; a longer text is cut into overlapping pieces.
PIECE = 1 << 19
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of each run of ``gram`` characters, rolled with sums of powers, in the upper half."""
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes + np.uint64(1)) * powers(_BASE, len(codes)), out=sums[1:])
    n = len(codes) - gram + 1
    return mix((sums[gram:] - sums[:-gram]) * powers(_INVERSE, n)) & ~_LOW


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, in the order of the text.

    A text shorter than a gram is one gram at position 0; one with fewer grams
    than a window is one window; null and empty texts keep nothing.
    """
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    gram = min(gram, len(codes))
    grams = len(codes) - gram + 1
    window = min(window, grams)
    kept = []
    for at in range(0, grams - window + 1, PIECE):
        end = min(at + PIECE + window - 1, grams)
        places = np.arange(end - at, dtype=np.uint64)
        least = gram_hashes(codes[at : end + gram - 1], gram) | (_LOW - places)  # of equal hashes the later is less
        span = 1
        while span < window:
            step = min(span, window - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        least = least[np.append(True, least[1:] != least[:-1])]
        kept.append(((least >> np.uint64(32)).astype(np.uint32), (_LOW - (least & _LOW)).astype(np.int64) + at))
    hashes, places = (np.concatenate(x) for x in zip(*kept, strict=True))
    new = np.append(True, places[1:] != places[:-1])
    return hashes[new], places[new]


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    """Eight hex digits of each hash and eight of its position, one after the other."""
    return np.stack([hashes, places], axis=1).astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Distinct kept hashes in both over those in either; two empty fingerprints are alike."""
    one, two = np.unique(one), np.unique(two)
    both = len(np.intersect1d(one, two, assume_unique=True))
    either = len(one) + len(two) - both
    return both / either if either else 1.0


def with_fingerprint(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with a string column ``fingerprint`` of each whole text; equal texts have equal ones."""
    ready_for_python(docs.sparkSession)

    @F.pandas_udf("string")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([written(*winnow(t, gram, window)) for t in texts])

    return docs.withColumn("fingerprint", fingerprint("text"))


def _neighbours(gram: int, window: int):
    def row(last, text, kept) -> tuple:
        doc_id, own, mine = last[1:]
        half = len(own) // 2
        edited = own[: len(own) - half] + text[:half]
        other = winnow(edited, gram, window)
        return (doc_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(*mine),
                written(*other), likeness(mine[0], other[0]), likeness(mine[0], kept[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            rows = []
            for place, doc_id, text in zip(*(batch.column(c) for c in ("_place", "doc_id", "text")), strict=True):
                place, text = place.as_py(), text.as_py() or ""
                kept = winnow(text, gram, window)
                if last and last[0] == place:
                    rows.append(row(last, text, kept))
                last = (place, doc_id.as_py(), text, kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 7, _TYPES, strict=True)], _NAMES
            )

    return run


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def edited_and_next(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, ranges: int | None = None) -> DataFrame:
    """Each row of ``docs(doc_id, text)`` against its edited text and the next document.

    Rows are in order of doc_id (null last), then of a hash of the text; the row after
    the last is the first, so a lone row follows itself. The edited text has its last
    half replaced by as much of the start of the next text. Null texts count as
    empty. Rows are dealt out to ranges of ids; the first row of each range is
    also put at the end of the range before it, which takes one shuffle of the texts
    and a few rows more. Extra columns are ignored; an empty table gives no rows.
    """
    ready_for_python(docs.sparkSession)
    parts = ranges or partitions_for(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
    rows = with_range(rows, "doc_id", range_splits(docs, "doc_id", parts), "_place")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_tie"))
    heads = rows.groupBy("_place").agg(head.alias("head"))
    by_place = Window.orderBy("_place")  # one row per range
    follows = heads.select(
        F.col("_place").alias("_to"),
        F.coalesce(F.lead("head").over(by_place), F.first("head").over(Window.partitionBy().orderBy("_place"))).alias("h"),
    )
    follows = F.broadcast(follows.select("_to", F.col("h.doc_id").alias("_id"), F.col("h._tie").alias("_hash")))
    ends = rows.join(follows, rows["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_hash")))
    ends = ends.dropDuplicates(["_to"]).select("doc_id", "text", "_tie", F.col("_to").alias("_place"), F.lit(1).alias("_end"))
    every = rows.select("doc_id", "text", "_tie", "_place", F.lit(0).alias("_end")).union(ends)
    every = every.repartition(parts, "_place").sortWithinPartitions("_place", "_end", F.col("doc_id").asc_nulls_last(), "_tie")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return every.select("doc_id", "text", "_place").mapInArrow(_neighbours(gram, window), schema)
