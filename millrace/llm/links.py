"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: More rounds than the logarithm squared of any number of links that fits a cluster.
ROUNDS = 60


def _least(pairs: DataFrame) -> DataFrame:
    """Per node, the least of itself and its neighbours; pairs come in both directions."""
    return pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for links (a, b) of longs: the smallest node reachable.

    Large-star and small-star rounds in turn: each hooks a node's neighbours to the
    least node that it knows of, until every node hangs on its component's least
    one. Neighbour lists are never gathered: minima are pre-aggregated before they
    are shuffled and joined back, so a hub of millions of links is split as any skewed
    join is. Each round is written to the shared folder, and so is the result. Null
    ends and links of a node with itself are ignored. Rounds that don't settle are an error.
    """
    links = common.keep(pairs.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct(), "links")
    before = None
    for _ in range(ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = common.keep(both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        common.discard(links)
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(small, "a")
        links = common.keep(hooked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(hooked.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "links")
        common.discard(large)
        state = links.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components are still changing after {ROUNDS} rounds")
    found = common.keep(links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "components")
    common.discard(links)
    return found
