"""Connected components of an edge table by alternating stars; every round is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.session import materialise


def _rewired(pairs: DataFrame, upwards: bool) -> DataFrame:
    """Ties the neighbours ``v`` of each ``u`` to the least node among them and ``u``.

    The minimum is combined before the shuffle, and a node with very many neighbours is split in the join.
    """
    least = materialise(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    joined = pairs.join(least, "u")
    if upwards:
        return joined.where("v > u").selectExpr("v as u", "m as v")
    return joined.selectExpr("v as u", "m as v").union(least.selectExpr("u", "m as v"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for every node of ``edges`` (``a``, ``b``).

    Each double round at least halves long paths, so their number grows with the logarithm of the longest.
    """
    links = edges.where("a != b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct()
    links, state = materialise(links, "links"), None
    while True:
        both = links.union(links.selectExpr("v as u", "u as v"))
        wide = materialise(_rewired(both, upwards=True).where("u != v").distinct(), "links")
        links = materialise(_rewired(wide, upwards=False).where("u != v").distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    return links.selectExpr("u as node", "v as root").union(links.selectExpr("v as node", "v as root").distinct())
