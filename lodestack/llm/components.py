"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.session import discard, materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked with its smallest neighbour (or itself)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b")


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked with the smallest of these. Rows have a < b."""
    down = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    rest = down.join(least, "u").where("v > m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return own.unionByName(rest).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node but the centres has one link, and no centre is anybody's leaf."""
    ends = links.select(F.col("a").alias("node"), F.lit(0).alias("leaf")).unionByName(links.select(F.col("b").alias("node"), F.lit(1).alias("leaf")))
    return ends.groupBy("node").agg(F.sum("leaf").alias("above"), F.min("leaf").alias("least")).where("above > 1 OR (above = 1 AND least = 0)").isEmpty()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node and root (the smallest node it can reach) for each node with a link, from rows (a, b) of links.

    Rounds go on until the links are stars, each written so that a lost executor costs one round.
    Smallest neighbours are summed before they are shuffled; nothing is collected.
    """
    now = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), name)
    while not _are_stars(now):
        before, now = now, materialize(_small_star(_large_star(now)), name)
        discard(before)
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
