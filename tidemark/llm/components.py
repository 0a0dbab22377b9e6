"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _lowest(links: DataFrame) -> DataFrame:
    """Links joined with the lowest neighbour of their start. The lowest neighbours are a written table,
    so that the join may split a start with very many links."""
    low = staged(links.groupBy("u").agg(F.min("v").alias("m")), "lowest")
    return links.join(low, "u")


def connected(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node with a link; the component is its smallest node.

    ``links`` has the columns u and v of one ordered type. Loops and repeated links do no harm, links with a
    null are ignored, no links give no rows. Every round shortens the paths to the smallest node by a
    constant factor; a round is a shuffle of as many rows as there are links, never of pairs in a group.
    """
    links = links.select("u", "v").where(F.col("u") != F.col("v"))
    links = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = _lowest(both).where(F.col("v") > F.col("u"))
        large = staged(joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large-star")
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        links = _lowest(large).select(F.inline(ends)).where(F.col("u") != F.col("v")).distinct()
        links = staged(links, "small-star")
        # a checksum of the set of links: equal sets mean that nothing moves any more
        now = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(hash(u, v))")).first()
        if now == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select("v", "v").distinct()
            )
        before = now
