"""Hard negatives of anchors by exact integer scores, with the tables of the Four Russians.

Components become whole numbers, and every vector is packed into bit-planes: one byte holds a bit of eight
components. For each group of eight dimensions an anchor has a table of the sums of all 256 subsets of
its components. The bytes of a candidate are indices of these tables, and the looked-up
sums, shifted plane by plane and added, give the full inner product without a multiplication.

All anchors meet all rows in the cells of a grid: rows go to one column each, anchors to one row of the grid each, and a cell
streams its rows past its anchors in batches of one label. Each anchor keeps its best few in a cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.llm.common import partitions_for, ready_for_python, stored

#: Components are multiplied by this before they are rounded down.
SCALE = 256
#: Anchors of a row of the grid; a cell holds their vectors and best rows, some hundred bytes each.
ANCHORS = 100_000
#: Rows whose scores a cell computes at once, and anchors whose tables it holds at once.
BATCH, TABLES = 4096, 64
#: Greatest component after scaling; beyond it a score might not fit 64 bits.
LARGEST = 1 << 28


def whole(vector: Column) -> Column:
    """Components as whole numbers; null for a null vector or one with a null or non-finite component."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(plain, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def planes(values: np.ndarray, count: int) -> np.ndarray:
    """Bit-planes of whole numbers in two's complement, the sign first: (rows, planes, groups of eight columns)."""
    packed = [np.packbits((values >> k & 1).astype(np.uint8), axis=1, bitorder="little") for k in reversed(range(count))]
    return np.stack(packed, axis=1)


def unpacked(packed: np.ndarray) -> np.ndarray:
    """The numbers again, in as many columns as the planes have bits."""
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    total = -bits[:, 0]
    for k in range(1, bits.shape[1]):
        total = 2 * total + bits[:, k]
    return total


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum of each subset of a group's eight components, bit k standing for component k."""
    parts = anchors.T.reshape(-1, 8, len(anchors)).astype(kind)
    sums = np.zeros((len(parts), 256, len(anchors)), dtype=kind)
    for k in range(8):
        sums[:, 1 << k : 2 << k] = sums[:, : 1 << k] + parts[:, k : k + 1]
    return sums


def scores(packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products (rows, anchors) of packed rows with the anchors of the tables."""
    total = np.zeros((len(packed), sums.shape[2]), dtype=sums.dtype)
    for plane in range(packed.shape[1]):
        if plane:
            total <<= 1
        for group in range(packed.shape[2]):
            found = sums[group].take(packed[:, plane, group], axis=0)
            if plane:
                total += found
            else:
                total -= found  # the sign
    return total


class Best:
    """The ``most`` best rows per place: higher scores first, ties by smaller id."""

    def __init__(self, places: int, most: int) -> None:
        self.most = most
        self.least = np.full(places, np.iinfo(np.int64).min)  # a row must reach this score to count
        self.place, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, place: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        if not len(place):
            return
        place, score, row_id = (np.concatenate(x) for x in ((self.place, place), (self.score, score), (self.id, row_id)))
        order = np.lexsort((row_id, -score, place))
        place, score, row_id = place[order], score[order], row_id[order]
        first = np.searchsorted(place, place, side="left")
        keep = np.arange(len(place)) - first < self.most
        self.place, self.score, self.id = place[keep], score[keep], row_id[keep]
        last = np.flatnonzero(np.arange(len(self.place)) - np.searchsorted(self.place, self.place, side="left") == self.most - 1)
        self.least[self.place[last]] = self.score[last]


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix, short vectors filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _pack(dims: int, count: int):
    names = ["vec_id", "label", "anchor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = planes(_vectors(batch.column("vector"), dims), count)
            rows = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), rows], [*names, "planes"])

    return run


class _Cell:
    """The anchors of a cell, in blocks of one label whose tables are made together."""

    def __init__(self, rows: list[tuple], shape: tuple[int, int], kind: type, most: int) -> None:
        rows = sorted(rows, key=lambda r: (r[1], r[0]))
        self.blocks, self.most, at = [], most, 0
        while at < len(rows):
            end = at + 1
            while end < min(at + TABLES, len(rows)) and rows[end][1] == rows[at][1]:
                end += 1
            part = rows[at:end]
            values = unpacked(np.frombuffer(b"".join(r[2] for r in part), np.uint8).reshape(len(part), *shape))
            bounds = [r[3] for r in part]  # scores of the positives, none while these are looked for
            slots = max((len(b) for b in bounds if b is not None), default=0)
            upper = np.full((len(part), max(1, slots)), np.iinfo(np.int64).max)
            lower = np.full((len(part), max(1, slots)), np.iinfo(np.int64).min)
            for k, found in enumerate(bounds):
                if found is not None:  # a place that is not used lets no score through
                    upper[k], lower[k] = np.iinfo(np.int64).min, np.iinfo(np.int64).max
                    upper[k, : len(found)] = found
                    lower[k, : len(found)] = [-(-80 * p // 100) for p in found]
            self.blocks.append((part[0][1], np.array([r[0] for r in part]), values.astype(kind), upper, lower, Best(upper.size, most)))
            at = end

    def meet(self, label: int, ids: np.ndarray, packed: np.ndarray, same: bool, kind: type) -> None:
        bounds = np.iinfo(kind)
        for own, anchors, values, upper, lower, best in self.blocks:
            if (own == label) != same:
                continue
            found, places, enough = scores(packed, subset_sums(values, kind)), upper.shape[1], self.most + same
            for k in range(places):
                most = np.clip(upper[:, k], bounds.min, bounds.max).astype(kind)
                least = np.clip(np.maximum(lower[:, k], best.least[k::places]), bounds.min, bounds.max).astype(kind)
                counts = (found <= most) & (found >= least)
                if len(ids) > enough and np.count_nonzero(counts) > 32 * len(anchors):
                    # A row with so many better ones in its own batch does not count; equal ones stay.
                    counts &= found >= np.partition(np.where(counts, found, bounds.min), -enough, axis=0)[-enough]
                row, anchor = np.nonzero(counts)
                if same:
                    other = ids[row] != anchors[anchor]
                    row, anchor = row[other], anchor[other]
                best.add(anchor * places + k, found[row, anchor].astype(np.int64), ids[row])

    def found(self) -> Iterator[tuple[np.ndarray, ...]]:
        for _, anchors, _, upper, _, best in self.blocks:
            yield anchors[best.place // upper.shape[1]], best.place % upper.shape[1], best.id, best.score


def _score(shape: tuple[int, int], kind: type, most: int, same: bool):
    names, kinds = ["anchor_id", "slot", "row_id", "score"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, at, anchors, waiting, label = None, None, [], [], None

        def meet() -> None:
            nonlocal waiting
            if waiting and anchors:
                packed = np.frombuffer(b"".join(w[1] for w in waiting), np.uint8).reshape(len(waiting), *shape)
                cell.meet(label, np.array([w[0] for w in waiting]), packed, same, kind)
            waiting = []

        def results() -> Iterator[pa.RecordBatch]:
            for columns in cell.found() if cell else ():
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for here, is_row, row_label, row_id, packed, bounds in zip(*(batch.column(c).to_pylist() for c in ("cell", "is_row", "label", "vec_id", "planes", "bounds")), strict=True):
                if here != at:
                    meet()
                    yield from results()
                    cell, at, anchors, label = None, here, [], None
                if not is_row:
                    anchors.append((row_id, row_label, packed, bounds))
                    continue
                if cell is None:
                    cell = _Cell(anchors, shape, kind, most)
                if row_label != label or len(waiting) == BATCH:
                    meet()
                    label = row_label
                waiting.append((row_id, packed))
        meet()
        yield from results()

    return run


def _in_cells(rows: DataFrame, anchors: DataFrame, grid: tuple[int, int]) -> DataFrame:
    """Rows and anchors in the cells of a grid of (rows, columns), cell by cell, the anchors first, then the rows by label."""
    down, across = grid
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    mine = rows.select(
        "vec_id", "label", "planes", F.lit(None).cast("array<bigint>").alias("bounds"), F.lit(1).alias("is_row"),
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"), place(across).alias("across"),
    )
    theirs = anchors.select(
        "vec_id", "label", "planes", "bounds", F.lit(0).alias("is_row"),
        place(down).alias("down"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"),
    )
    every = mine.union(theirs).withColumn("cell", F.col("down").cast("long") * across + F.col("across"))
    return every.repartition(min(partitions_for(rows), down * across), "cell").sortWithinPartitions("cell", "is_row", "label", "vec_id")


def grid_for(rows: int, anchors: int, parts: int, most: int = ANCHORS) -> tuple[int, int]:
    """A grid with some cells per task. Few of its rows keep the copies of the rows few; it has no more columns than batches."""
    down = max(1, math.ceil(anchors / most))
    across = max(1, min(math.ceil(3 * parts / down), math.ceil(rows / BATCH)))
    return down, across


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 5, grid: tuple[int, int] | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors(vec_id, embedding)``.

    ``anchor`` says whether a row is one, ``label`` is its class; both are column expressions over ``vectors``. Positives of an
    anchor are its best ``positives`` other rows of its label. Per anchor and positive come the best ``negatives``
    rows of other labels that score from 80 % to 100 % of the positive. Ties go to the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Of rows with one
    id the least by label and vector does, so repeated rows change nothing. Shorter vectors count as filled up with zeros.
    Components beyond 2^20 raise an error. Extra columns are ignored; without rows, anchors or positives the result is empty.
    """
    spark = vectors.sparkSession
    ready_for_python(spark)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"),
        whole(F.col("embedding")).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).dropna(subset=["vec_id", "label", "vector"])
    # Of all rows, repeated ones too: it takes one scan and no shuffle.
    facts = rows.agg(
        F.count("*").alias("rows"), F.count_if("anchor").alias("anchors"), F.max(F.size("vector")).alias("dims"),
        F.max(F.array_max("vector")).alias("high"), F.min(F.array_min("vector")).alias("low"),
    ).first()
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "anchor")).alias("r")).select("vec_id", "r.*")
    high, low, dims = facts.high or 0, facts.low or 0, max(1, facts.dims or 0)
    largest = max(high, -low)
    if largest > LARGEST or dims * largest * largest >= 1 << 63:
        raise ValueError("a component is too large for scores of 64 bits")
    kind = np.int32 if dims * largest * largest < 1 << 31 else np.int64
    count = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    shape = (count, -(-dims // 8))
    packed = stored(rows.mapInArrow(_pack(dims, count), "vec_id long, label int, anchor boolean, planes binary"), "planes")
    anchors = packed.where("anchor").select("vec_id", "label", "planes")
    grid = grid or grid_for(facts.rows, facts.anchors, partitions_for(vectors))
    schema = "anchor_id long, slot int, row_id long, score long"
    order = [F.desc("score"), F.asc("row_id")]

    cells = _in_cells(packed, anchors.withColumn("bounds", F.lit(None).cast("array<bigint>")), grid)
    best = cells.mapInArrow(_score(shape, kind, positives, True), schema)
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("anchor_id").orderBy(*order))).where(F.col("place") <= positives)
    best = stored(best.select("anchor_id", (F.col("place") - 1).alias("slot"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    bounds = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score")))["positive_score"].alias("bounds"))
    bounded = anchors.join(bounds, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "planes", "bounds")
    found = _in_cells(packed, bounded, grid).mapInArrow(_score(shape, kind, negatives, False), schema)
    by_positive = Window.partitionBy("anchor_id", "slot").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(by_positive)).where(F.col("rank") <= negatives)
    return found.join(best, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
