"""Connected components of a link table, by alternating star steps.

Each step is an aggregation and a join on the node: a node with very many
links needs no task that holds them all.  The links are stored in the shared
folder after every round, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import released, stored


def _large(e: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of its neighbours and itself."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node but the least of its component, and that least node.

    ``links`` has two integer columns u and v in any order.
    """
    e = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    mark = _mark(e)
    while mark[0]:
        e = stored(_small(_large(e)), "links")
        new = _mark(e)
        released(e.sparkSession)
        if new == mark:
            break
        mark = new
    return e
