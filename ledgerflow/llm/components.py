"""Connected components of a graph given by links, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of a link; component is the smallest node it can reach.

    Alternating star operations (large star, small star): every round hangs each node's neighbours on its smallest one,
    by a grouped minimum and a join, so no task gathers a component; a graph of diameter d takes about log(d) rounds.
    Each round's links go to the shared folder, so lost executors repeat one round at most. Links to oneself and repeats
    don't matter; nulls link nothing; no links give no rows."""
    spark = links.sparkSession
    links = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo"))).distinct()
    links, last, n = stored(links, "links"), None, 0
    for _ in range(most_rounds):
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        n = n or state[0]  # a round makes no more links than there were, and one for each node
        # large star: every neighbour larger than u goes to the smallest of u and its neighbours
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = links.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = stored(large.filter("hi != lo").distinct(), "links", 2 * n)
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.col("lo").alias("x"), "m").union(least.select("hi", "m"))
        before, links = links, stored(small.filter("x != m").select(F.col("x").alias("hi"), F.col("m").alias("lo")).distinct(), "links", 2 * n)
        discard(before, large)
    else:
        raise RuntimeError("components didn't settle")
    tops = links.select(F.col("lo").alias("node")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(tops.select("node", F.col("node").alias("component")))
