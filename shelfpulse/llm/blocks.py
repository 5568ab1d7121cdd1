"""Comparing the members of groups in blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(members: DataFrame, group: str, member: str) -> DataFrame:
    """Deal each group's members into sides; each pair of sides is a block.

    ``members`` has a column ``sides``, the number of sides of its group. The result has
    low, high and side instead: a row for each block in which the member takes part, with
    the side it is on. Any two members of a group meet in exactly one block, unless they
    are on one side, where they meet in all of its blocks; that pair belongs to the block
    with low = high.
    """
    dealt = members.withColumn(
        "side", F.pmod(F.xxhash64(F.col(member), F.col(group)), F.col("sides")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("other")
    keep = [c for c in members.columns if c != "sides"]
    return dealt.select(*keep, "side", other).select(
        *keep,
        F.least("side", "other").alias("low"),
        F.greatest("side", "other").alias("high"),
        "side",
    )
