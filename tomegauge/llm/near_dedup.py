"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is its set of distinct word shingles. Equal sets are one node. For
the others the steps are:

1. The sketch of a node is its ``SKETCH`` least shingle hashes. Inverted lists of
   the first retained values tell how much of each sketch also lies in other sketches.
   Two sets with the similarity asked for share most of the sketch of their
   union, so a node of whose sketch too little is shared is linked with nothing.
2. For the nodes left, whole sets: the rarest shingles come first, and two
   similar sets meet in a list of the first few (prefix filter, exact).
3. In each list all members are compared with one hub, the member with the
   fewest shingles of its own, so a group of copies costs one pair per copy.
   Links found make components.
4. Members of a list still in different components are paired if size,
   position and the estimate from the union of both sketches allow a link.
5. Each pair is confirmed on the full sets, and the components are drawn anew.

Steps 1 and 4 miss a link with a chance below 1e-6, also where one set holds the
other and the similarity is 0.8; all else is exact. No list is cut and none is
gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomegauge.llm import hashing
from tomegauge.llm.common import nested, ready_for_python, stored, unnested
from tomegauge.llm.components import components

SKETCH = 64
#: Of the first values of a sketch, the number looked up, and the share that a linked node has in common at least.
PROBED = 32
SHARED = 0.4
#: An estimate from the union sketch below this much under the threshold excludes a link.
SLACK = 0.3


def _signed(found: np.ndarray) -> np.ndarray:
    """Unsigned hashes as signed ones in the same order, as Spark sorts them."""
    return (found ^ np.uint64(1 << 63)).view(np.int64)


def _features(width: int, sketch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for text in batch.column("_text"):
                found = hashing.shingle_set(text.as_py(), width)
                sizes.append(len(found))
                digests.append(hashing.set_digest(found))
                sketches.append(_signed(found[:sketch]))
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                       pa.array(digests, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "sketch"])

    return run


def features(docs: DataFrame, width: int = 3, sketch: int = PROBED) -> DataFrame:
    """Per row: ``doc_id, text_hash, n_shingles, node`` (digest of the set) and the first values of its ``sketch``."""
    ready_for_python(docs.sparkSession)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("_text")
    )
    schema = "doc_id long, text_hash long, n_shingles long, node long, sketch array<long>"
    return source.mapInArrow(_features(width, sketch), schema)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(hashing.shingle_set(x.as_py(), width)) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "items"])

    return run


def _active(nodes: DataFrame) -> DataFrame:
    """Nodes of whose sketch enough values lie in other sketches too."""
    probes = nodes.select("node", F.explode("sketch").alias("value"))
    common = probes.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    seen = probes.join(common, "value").groupBy("node").agg(F.count("*").alias("seen"))
    enough = F.col("seen") >= F.lit(SHARED) * F.least(F.lit(PROBED), F.col("n_shingles"))
    return nodes.join(seen, "node").where(enough).drop("seen")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Per set its ``first`` shingles in ascending order of frequency, as far as the prefix filter needs them.

    ``own`` counts the shingles that no other set has; they come first and need no list.
    """
    items = sets.select("node", F.explode("items").alias("item"))
    common = items.groupBy("item").agg(F.count("*").alias("df")).where("df > 1")
    shared = items.join(common, "item").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "item"))).alias("shared")
    ).join(sets.select("node", "n_shingles"), "node")
    own = F.col("n_shingles") - F.size("shared")
    prefix = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    shared = shared.withColumn("own", own).withColumn("prefix", F.greatest(F.lit(0), prefix - own).cast("int"))
    shared = shared.where("prefix > 0").withColumn("first", F.slice("shared", F.lit(1), F.col("prefix"))["item"])
    return shared.select("node", "n_shingles", "own", "first")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Size and position allow a link: what is left after the places of a common item suffices for the overlap."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    left = F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place"))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (left * (100 + percent) >= (n + m) * percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(one, "a").join(two, "b")
        .select("a", "b", both.alias("both"), (F.size("x") + F.size("y") - both).alias("either"))
        .where(F.col("both") * 100 >= F.col("either") * percent)
        .select("a", "b")
    )


def _estimated(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Drop pairs whose union sketch shows clearly less in common than asked for."""
    one = sets.select(F.col("node").alias("a"), F.slice("items", 1, SKETCH).alias("x"))
    two = sets.select(F.col("node").alias("b"), F.slice("items", 1, SKETCH).alias("y"))
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect(union, F.col("x")), F.col("y")))
    return (
        pairs.join(one, "a").join(two, "b")
        .where(common >= F.size(union) * (percent / 100 - SLACK))
        .select("a", "b")
    )


def links(docs: DataFrame, rows: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """Pairs ``a, b`` of nodes that hold every component together; ``rows`` is the stored result of features()."""
    nodes = rows.where("n_shingles > 0").groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("i"), "text_hash", "doc_id")).alias("row"),
        F.first("sketch").alias("sketch"),
    )
    active = stored(_active(stored(nodes, "nodes")), "active")
    wanted = active.select("node", "n_shingles", F.col("row.doc_id").alias("i"), F.col("row.text_hash").alias("h"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text", F.xxhash64("text").alias("_hash"))
    texts = texts.join(wanted, texts["_id"].eqNullSafe(wanted["i"]) & (texts["_hash"] == wanted["h"]))
    once = texts.select("node", "text").dropDuplicates(["node"])  # rows that repeat in full
    sets = once.mapInArrow(_sets(width), "node long, items array<long>")
    sets = stored(sets.withColumn("n_shingles", F.size("items").cast("long")), "sets")
    prefixes = stored(_prefixes(sets, percent), "prefixes")
    lists = prefixes.select("node", "n_shingles", "own", F.posexplode("first").alias("place", "item"))
    lists = lists.withColumn("place", F.col("place") + F.col("own"))

    centre = F.min(F.struct("own", "node", "n_shingles", "place"))
    hubs = lists.groupBy("item").agg(centre.alias("hub"), F.count("*").alias("m")).where("m > 1")
    hubs = hubs.select("item", F.col("hub.*")).alias("h")
    star = lists.alias("l").join(hubs, "item").where(F.col("l.node") != F.col("h.node"))
    star = star.where(_may_link("l", "h", percent)).select(F.col("h.node").alias("a"), F.col("l.node").alias("b")).distinct()
    first = stored(_verified(star, sets, percent), "star")
    parts = components(first).withColumnRenamed("component", "part")
    known = lists.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    open_lists = known.groupBy("item").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("item")
    known = known.join(open_lists, "item", "left_semi").drop("own").join(prefixes.select("node", "first"), "node")
    one, two = known.alias("x"), known.alias("y")
    rest = one.join(two, (F.col("x.item") == F.col("y.item")) & (F.col("x.node") < F.col("y.node"))
                    & (F.col("x.part") != F.col("y.part")) & _may_link("x", "y", percent)
                    & (F.array_intersect("x.first", "y.first")[0] == F.col("x.item")))
    rest = rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    second = _verified(_estimated(rest, sets, percent), sets, percent)
    return stored(first.union(second), "links")


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id, kept, text_hash, group``.

    ``component_id`` is the least doc_id linked, directly or through others.
    Texts without words (null, empty, white space) are linked with nothing; their ``group`` is null.
    Rows with equal texts are one group, also if they repeat a doc_id. A null
    doc_id counts as larger than all others; its row is kept only if no row
    with an id is in its group. Other columns are ignored; no rows give no rows.
    """
    rows = stored(features(docs, width), "sketches")
    parts = components(links(docs, rows, width, percent))
    own = rows.drop("sketch").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    blank = F.col("n_shingles") == 0
    least = own.where(~blank).groupBy("part").agg(F.min("doc_id").alias("least"))
    result = own.drop("component").join(least, "part", "left")
    component = F.when(blank, F.col("doc_id")).otherwise(F.col("least"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash", F.when(blank, None).otherwise(F.col("part")).alias("group"),
    )


def dedup(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` with one document of each group kept, all columns as they were.

    Of rows that repeat a kept document exactly one stays, too. Texts that are null, empty or without words are in no
    group: such a row stays, and so does the row of a null doc_id in a group without ids. Columns may have any names; an
    empty table gives no rows.
    """
    found = near_duplicates(docs, width, percent)
    kept = found.where("kept").groupBy("doc_id", "text_hash").agg(F.count("*").alias("_rows"), F.min("group").alias("_group"))
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_rows", "_group")
    rows = nested(docs, F.col("doc_id").cast("long").alias("_own"), F.xxhash64("text").alias("_mine"))
    chosen = rows.join(kept, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_mine") == F.col("_hash")))
    busy = found.where("kept").where("group is not null").groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    busy = busy.select(F.col("group").alias("_busy"))
    chosen = chosen.join(busy, F.col("_group") == F.col("_busy"), "left")
    single = chosen.where("_busy is null")
    several = chosen.where("_busy is not null").dropDuplicates(["_busy"])
    return single.union(several).select(*unnested(docs))
