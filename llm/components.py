"""Connected components of a graph of links, by star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.sources.shared import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node it is linked with, for every node of (a, b).

    In turn, all larger neighbours and all smaller neighbours of a node are hung on the smallest of
    them, which at least halves paths. Each round works on rows of two values, is combined before it is
    shuffled, and is written to the shared folder; the links of a hot node are rows to be joined and split,
    never one group. Null ends and links of a node with itself are left out.
    """
    proper = links.where(F.col("a") != F.col("b"))
    stars = materialize(
        proper.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while (now := _state(stars)) != before:
        stars, before = materialize(_contract(stars), "links"), now
    members = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    hubs = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionAll(hubs)


def _state(stars: DataFrame) -> tuple:
    """Count and digests of the links: one row, equal when nothing has changed."""
    digest = F.xxhash64("a", "b")
    row = stars.agg(F.count(F.lit(1)), F.bit_xor(digest), F.sum(F.pmod(digest, F.lit(1_000_003)))).first()
    return tuple(row)


def _hang(links: DataFrame) -> DataFrame:
    """Each link (a, b) with the smallest of a and its neighbours."""
    lowest = links.groupBy("a").agg(F.min("b").alias("_low"))
    return links.join(lowest, "a").withColumn("_low", F.least("a", "_low"))


def _contract(stars: DataFrame) -> DataFrame:
    both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _hang(both).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_low").alias("b"))
    small = _hang(large.distinct())
    moved = small.select(F.col("b").alias("a"), F.col("_low").alias("b")).where(F.col("a") != F.col("b"))
    return moved.unionAll(small.select("a", F.col("_low").alias("b"))).distinct()
