"""Connected components of a link table by alternating large-star and small-star steps.

Each step replaces links by links to the smallest neighbour; every step is written to the shared folder, so neither
lineage nor any one task grows with a component. The count of steps grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (a, b), a > b: each node's neighbours are tied to the smallest node around it."""
    if large:
        around = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    tied = around.join(least, around["a"] == least["u"])
    if large:
        out = tied.where(F.col("b") > F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of a link between different nodes; component is the smallest node reachable."""
    x = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct()
    x = written(x, "links")
    state = _state(x)
    while True:
        x = written(_star(x, large=True), "large-star")
        x = written(_star(x, large=False), "small-star")
        now = _state(x)
        if now == state:
            break
        state = now
    roots = x.select("b").distinct()
    return x.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
