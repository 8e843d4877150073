"""Connected components of links, by alternating stars (Kiveris et al., 2014).

Links stay in Spark tables. In a large star every node hands its larger neighbours to the
smallest node it sees, in a small star its smaller ones; after a few rounds each node hangs on the
smallest node of its component. Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import stored


def _hung(pairs: DataFrame) -> DataFrame:
    """(node, near) pairs with the smallest node seen from ``node``, itself included."""
    least = pairs.groupBy("node").agg(F.min("near").alias("least"))
    return pairs.join(least, "node").withColumn("least", F.least("node", "least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("near").alias("node"), F.col("node").alias("near")))
    hung = _hung(both)
    return hung.where("near > node").select(F.col("near").alias("node"), F.col("least").alias("near"))


def _small_star(links: DataFrame) -> DataFrame:
    hung = _hung(links)
    own = hung.select("node", F.col("least").alias("near"))
    others = hung.where("near <> least").select(
        F.col("near").alias("node"), F.col("least").alias("near")
    )
    return own.union(others).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("node", "near") % F.lit(1 << 31)),
    ).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of a link; component is its smallest node.

    Nodes are bigints; a link to itself only names its node, links with a null say nothing, and
    repeated or reversed links count once. No links give no rows.
    """
    links = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where(
        "x IS NOT NULL AND y IS NOT NULL"
    )
    current = stored(
        links.select(F.greatest("x", "y").alias("node"), F.least("x", "y").alias("near")).distinct(),
        "links",
    )
    alone = current.where("node = near").select("node", F.col("node").alias("component"))
    links, before = current.where("node > near"), None
    while (now := _state(links)) != before and now[0]:
        before = now
        links = stored(_small_star(_large_star(links)), "links")
    tops = links.select(F.col("near").alias("node"), F.col("near").alias("component"))
    found = links.select("node", F.col("near").alias("component")).union(tops).union(alone)
    return found.groupBy("node").agg(F.min("component").alias("component"))
