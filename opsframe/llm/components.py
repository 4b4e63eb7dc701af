"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import stored


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each node ``u`` with the lowest of itself and its partners."""
    return pairs.groupBy("u").agg(F.least(F.min("u"), F.min("v")).alias("m"))


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v"), F.col("u")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the lowest node of its component.

    ``links`` has ``u`` and ``v`` of one ordered type; order, direction and
    repetition don't matter. Nodes without a link are not in the result.

    Rounds of two steps make every component a star: first each node hands its
    higher partners to its lowest partner, then each node hands its lower
    partners to the lowest of them. Every round is written to the shared
    folder, and the rounds end when one changes nothing. Minima are combined
    before they move, and no node's partners are ever collected.
    """
    links = stored(
        _both(links).where("u > v").distinct(), "links"
    )
    state = None
    while True:
        both = _both(links)
        large = (
            both.join(_lowest(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # The second step sees pairs from the higher to the lower node only.
        lower = _lowest(large)
        small = (
            large.join(lower, "u")
            .where("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lower.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = stored(small, "links")
        found = links.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
        if found == state:
            break
        state = found
    members = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return members.union(roots.distinct())
