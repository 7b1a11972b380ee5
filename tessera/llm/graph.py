"""Connected components of a graph too large for the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import drop_stored, stored

#: A key is hot if it has more rows than this, and than this part of all rows; so there are fewer hot keys than this.
HOT = 1000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def looked_up(rows: DataFrame, key: str, values: DataFrame, total: int) -> DataFrame:
    """``rows`` with the value of their key, from ``values`` (key, value, n: how many of the ``total`` rows have the key).

    Rows of the hot keys, fewer than HOT, meet their values by broadcast and are dealt by all their columns; the others
    meet theirs by key.
    """
    hot = values.where(F.col("n") > max(HOT, total // HOT)).select(key, F.col("value").alias("hot"))
    salt = F.when(F.col("hot").isNotNull(), F.xxhash64(*rows.columns).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("salt", salt)
    # Not a literal: the planner would take that out of the join's keys.
    cold = values.select(key, "value", (F.col("n") < 0).cast("bigint").alias("salt"))
    return rows.join(cold, [key, "salt"], "left").withColumn("value", F.coalesce("hot", "value")).drop("hot", "salt")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node for every node of ``edges`` (a, b): node, component.

    Alternates large-star and small-star steps; every node's links are reduced by a minimum, no task holds the
    links of a hot node, and each round is written to the shared folder.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), compact=True)
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("value"), F.count("*").alias("n"))
        large = looked_up(both.where("b > a"), "a", low, 2 * mark[0]).select(F.col("value").alias("a"), "b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("value"), F.count("*").alias("n"))
        small = looked_up(large, "b", low, mark[0]).where("a <> value").select(F.col("value").alias("a"), F.col("a").alias("b"))
        new = stored(small.unionByName(low.select(F.col("value").alias("a"), "b")).distinct(), compact=True)
        before, mark, old, edges = mark, _mark(new), edges, new
        drop_stored(old)
        if mark == before:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
