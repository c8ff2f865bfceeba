"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept


def linked_groups(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, group) for every node in links (a, b); group is the smallest node reachable.

    Alternating star contraction: each round hangs every neighbour on the smallest one seen, first among larger nodes,
    then among smaller ones, until the links are a set of stars. The minimum is a partial aggregate, so a node with
    very many links doesn't gather in one task. Null ends are left out; no links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = kept(edges, "links")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        # large star: larger neighbours of u go to the smallest one around u
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = kept(large, "large-star")
        # small star: u and its smaller neighbours go to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = kept(small.filter("u <> v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the links did not settle")
    stars = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("group"))
    return kept(stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("group")).distinct()), "groups")
