"""Connected components by alternating large and small stars.

Each step hangs nodes on the smallest node they know; a step is one
pre-aggregated minimum and one join, so a node with any number of neighbours
is never gathered in one task.  Every round is written to the shared folder
and read again; only the number of changed links reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sources.stage import stage


def star(edges: DataFrame) -> DataFrame:
    """Links (node, to) with ``to`` the smallest neighbour, of the given (node, other) links."""
    least = edges.groupBy("node").agg(F.min("other").alias("to"))
    return edges.join(least, "node")


def fingerprint(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(
        links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "other"))).first()
    )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node."""
    now = stage(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
        .distinct(),
        "links",
    )
    last = fingerprint(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("other").alias("node"), F.col("node").alias("other")))
        # Large star: larger neighbours of a node hang on its smallest neighbour or itself.
        large = (
            star(both)
            .where("other > node")
            .select(F.col("other").alias("node"), F.least("node", "to").alias("other"))
        )
        large = stage(large, "large-star")
        # Small star: a node and its smaller neighbours hang on the smallest of them.
        small = star(large)
        after = stage(
            small.select("node", F.col("to").alias("other"))
            .unionByName(
                small.where("other != to").select(F.col("other").alias("node"), F.col("to").alias("other"))
            )
            .distinct(),
            "small-star",
        )
        mark = fingerprint(after)
        now, settled, last = after, mark == last, mark
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("other").alias("node")).distinct()
    return now.select("node", F.col("other").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
