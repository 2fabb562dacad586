"""Connected components of a table of links by alternating star steps.

Every step keeps, for each node, one link to its least neighbour, so the work is a few
groupings and equi-joins of the links per step and no component is ever gathered in one
task or on the driver. Each step's links are a written table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import table


def _stars(links: DataFrame, above: bool) -> DataFrame:
    """Links (a, b), a > b: of each node, its greater (or lesser) neighbours are linked
    to the least node among itself and its neighbours."""
    if above:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
        # a > b: node b hands its greater neighbour a to b's least
        moved = links.join(least, "b").select("a", F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b")
    return moved.filter("a > b").distinct()


def component_roots(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; the root is the component's least node.

    ``links`` holds long columns a and b, in any order, repeated or not.
    """
    now = table(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state or not mark[0]:
            break
        state = mark
        now = table(spark, _stars(_stars(now, True), False), "links")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
