"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.scratch import stage


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it is connected with, for each node with a link.

    ``links`` has columns a and b, of any type that can be ordered. Rounds of two steps
    hang neighbours onto smaller ones: all larger neighbours of a node onto the smallest of
    its surroundings, then all smaller ones. The number of rounds grows with the logarithm
    of the longest chain. Each round is a written table, so a lost executor costs a task.
    Nodes with very many links are aggregated before their rows meet.
    """
    links = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    seen = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        hung = _hang(both.where("b > a"), least)
        links = stage(hung, "links")
        # Now b < a in all rows: smaller neighbours, and the node itself, onto the smallest.
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        hung = _hang(links, least).unionByName(least.select("a", F.col("m").alias("b")))
        links = stage(hung.where("a <> b").distinct(), "links")
        now = _state(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _hang(rows: DataFrame, least: DataFrame) -> DataFrame:
    """b of each row onto the smallest around its a; a as the larger of the two."""
    met = rows.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    return met.where("x <> y").select(
        F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")
    ).distinct()


def _state(links: DataFrame):
    """Tells one set of links from another: their number and the sum of their hashes."""
    return links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
