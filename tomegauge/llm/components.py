"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomegauge.llm.common import stored


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    around = _both(links)
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Columns ``node, component`` (the least node reachable) for every node of ``links(a, b)``.

    Alternates the two star steps until nothing changes; the steps grow with
    the logarithm of the number of nodes. A node with very many neighbours is
    handled by a grouped minimum and a join, so no task holds its neighbours.
    Self links and repeated links do no harm; an empty table gives an empty one.
    """
    now = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    last = None
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last = mark
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
