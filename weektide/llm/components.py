"""Connected components of a graph given as pairs, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm.store import shuffle_width, stored


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` of every node in the pairs ``a, b``; a component's name is
    its smallest node.

    Two kinds of rounds alternate until the pairs stand still: every node ties its
    larger neighbours, then its smaller ones, to the smallest node around it.  The
    pairs turn into stars after about the logarithm of the number of nodes.  A round
    groups by node and joins the minimum back, so a hub's neighbours stay spread out,
    and each round is stored in the shared folder.
    """
    # Two numbers a row: few files hold what many shuffle tasks give.
    files = max(1, shuffle_width(pairs.sparkSession) // 8)
    pairs = stored(
        pairs.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        .coalesce(files), "pairs",
    )
    previous = None
    for _ in range(rounds):
        # Larger neighbours go to the smallest node of the neighbourhood.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Smaller neighbours, and the node itself, go to the smallest of them.
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(
                F.struct(F.col("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            )).alias("p")).select("p.*")
            .where("a <> b").distinct()
        )
        pairs = stored(small.coalesce(files), "pairs")
        state = pairs.agg(
            F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("h")
        ).first()
        if previous == state:
            break
        previous = state
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
