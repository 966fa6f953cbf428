"""Connected components of a link table by alternating large-star / small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.common import materialize


def hot_join(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with an aggregate that has one row per key, where a key may hold a large
    share of ``rows``.  Both sides are shuffled by an expression of the (long) key: joined by the key
    itself, the aggregate would keep its own partitioning, and AQE could not split the hot partition."""
    other = per_key.withColumnRenamed(key, f"_{key}")
    return rows.join(other, F.bitwise_not(F.col(key)) == F.bitwise_not(F.col(f"_{key}"))).drop(f"_{key}")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (hot_join(both.where("v > u"), low, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = hot_join(links, low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node of the component.

    Minima are taken by partial aggregation, so a hub adds one value per task;
    the joins back are inner joins whose hot partitions AQE splits.  Every round is
    checkpointed in the shared folder; the driver sees two numbers per round.
    A node linked only to itself is its own root; nulls are no nodes.
    """
    own = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    now = materialize(own.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct())
    alone = own.where("a = b").select(F.col("a").alias("node"))

    def mark(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    last = mark(now)
    while last[0]:
        now = materialize(_small_star(_large_star(now)))
        state = mark(now)
        if state == last:
            break
        last = state
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    nodes = stars.select("node").unionAll(stars.select("root")).unionAll(alone).distinct()
    return (nodes.join(stars, "node", "left")
            .select("node", F.coalesce("root", "node").alias("root")))
