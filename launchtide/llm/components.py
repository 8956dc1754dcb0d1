"""Connected components of links, by alternating large and small stars.

Each round ties the neighbours of every node to the least of them: first the greater
ones, then the others. Links stay at most as many as they were, and the rounds needed
grow with the logarithm of the longest path. Every round is a grouped minimum, combined
before its shuffle, and a join whose hot side adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchtide.llm.shared import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links``: (low, high). The links of one star operation, low < high."""
    if large:
        sides = links.select(F.col("low").alias("node"), F.col("high").alias("other")).union(
            links.select("high", "low")
        )
    else:
        sides = links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    least = sides.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    near = sides.join(least, "node")
    if large:
        made = near.filter("other > node").select(
            F.col("least").alias("low"), F.col("other").alias("high")
        )
    else:
        made = near.select(F.col("least").alias("low"), F.col("other").alias("high")).union(
            least.select("least", "node")
        )
    return made.filter("low < high")


def _settled(links: DataFrame) -> bool:
    """Whether every greater end has one link and is nobody's lesser end."""
    ends = links.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("low", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with a link: the least node reachable.

    ``links`` has two integer columns, in any order, with repeats or loops. Nodes without
    links are absent. Null ends link with nothing.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns[:2])
    links = (
        links.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"), a.alias("a"), b.alias("b"))
        .filter("low < high and a is not null and b is not null")
        .select("low", "high")
        .distinct()
    )
    links = stored(links, "links")
    for _ in range(rounds):
        if _settled(links):
            break
        links = stored(_star(_star(links, True), False).distinct(), "stars")
    else:
        raise RuntimeError("links have not settled")
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
