"""Shards of nearly equal bytes: a minimax contiguous partition of groups of equal texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import numbered, spread, utf8_bytes
from shelfpulse.scratch import stage

#: Capacities tried in one round of the search.
FAN_OUT = 48
#: Groups per block of the running sum, and the most blocks.
BLOCK_ROWS, MOST_BLOCKS = 50_000, 65_536


def shard(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Deal all rows into ``shards`` shards, equal texts together, by the law ``bytes``.

    A row's size is its UTF-8 bytes plus one. Groups of equal texts are ordered by the
    SHA-256 of the text. A group larger than an even share gets a shard of its own; the
    others are cut, in order, where greedy filling to the smallest feasible capacity cuts.

    Returns doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard) and
    grown_shard (null, as this law has none). Null texts are one group of rows of size 1
    with a null checksum; empty texts are another. Repeated rows all stay, with a slot
    each. A null id is kept. An empty table gives an empty result. Other columns of
    ``docs`` are not read, whatever their names.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (utf8_bytes(text) + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        # Null sorts before all digests as the empty string.
        F.coalesce(F.sha2(text, 256), F.lit("")).alias("digest"),
    )
    # Repeated rows travel as a count, so that no number of them meets in one window.
    rows = stage(
        rows.groupBy("doc_id", "digest").agg(
            F.first("size").alias("size"),
            F.first("text_crc32").alias("text_crc32"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "shard-rows",
    )
    place, n_rows = _placement(rows, shards)
    slices = spread(n_rows, 20_000 * shards, 16_384)
    placed = rows.withColumn("shard", place).withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(slices)).cast("int")
    )
    # Slots run through slices; only one count per shard and slice is summed in order.
    starts = (
        placed.groupBy("shard", "slice")
        .agg(F.sum("copies").alias("n"))
        .withColumn(
            "start",
            F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n"),
        )
        .select("shard", "slice", "start")
    )
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "digest")
    slots = placed.withColumn("before", F.sum("copies").over(within) - F.col("copies")).join(
        starts, ["shard", "slice"]
    )
    slots = numbered(slots, "copies", F.col("start") + F.col("before"), "slot")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _placement(rows: DataFrame, shards: int) -> tuple[Column, int]:
    """The shard of a row as an expression over its digest, and the number of rows."""
    groups = rows.groupBy("digest").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("n")
    )
    groups = stage(groups, "shard-groups")
    total, n_groups, n_rows = groups.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)),
        F.count(F.lit(1)),
        F.coalesce(F.sum("n"), F.lit(0)),
    ).first()
    if not n_groups:
        return F.lit(0), 0

    # At most one group fewer than shards can exceed an even share of what is left.
    largest = groups.orderBy(F.desc("bytes"), "digest").limit(shards).collect()
    alone = []
    for row in largest:
        left = shards - len(alone)
        if left == 1 or row["bytes"] * left <= total:
            break
        alone.append(row["digest"])
        total -= row["bytes"]
    open_shards = shards - len(alone)
    rest = groups.where(~F.col("digest").isin(alone)) if alone else groups
    biggest = largest[len(alone)]["bytes"] if len(alone) < len(largest) else 0
    cuts = _cuts(rest, n_groups, total, biggest, open_shards)

    place = F.lit(0)
    for cut in cuts:
        place = place + F.when(F.col("digest") > cut, 1).otherwise(0)
    for i, digest in enumerate(alone):
        place = F.when(F.col("digest") == digest, F.lit(open_shards + i)).otherwise(place)
    return place.cast("int"), n_rows


def _cuts(groups: DataFrame, n_groups: int, total: int, biggest: int, shards: int) -> list[str]:
    """The last digest of each shard but the last, for the smallest feasible capacity."""
    if shards == 1 or not total:
        return []
    ends = stage(_running(groups, n_groups), "shard-ends")

    def reach(targets: list[int]) -> list[int]:
        """The largest running sum within each target."""
        found = ends.where(f"end between {min(targets) - biggest} and {max(targets)}").selectExpr(
            *[f"max(if(end <= {t}, end, null))" for t in targets]
        )
        return list(found.first())

    def greedy(capacities: list[int]) -> list[list[int]]:
        """Where filling up to each capacity cuts, for all of them at once."""
        at = [[0] for _ in capacities]
        for _ in range(shards):
            steps = reach([path[-1] + c for path, c in zip(at, capacities, strict=True)])
            for path, step in zip(at, steps, strict=True):
                path.append(path[-1] if step is None else step)
        return at

    # The even share is a lower bound, one group more than it an upper one.
    low = max(-(-total // shards), biggest)
    high = -(-total // shards) + biggest
    best = None
    while best is None or low < high:
        span = high - low
        tries = sorted({low + span * i // FAN_OUT for i in range(FAN_OUT + 1)})
        paths = greedy(tries)
        first = next(i for i, path in enumerate(paths) if path[-1] >= total)
        best, high = paths[first], tries[first]
        low = tries[first - 1] + 1 if first else high
    inner = sorted({x for x in best[1:-1] if 0 < x < total})
    found = ends.where(F.col("end").isin(inner)).select("digest").collect() if inner else []
    return sorted(row["digest"] for row in found)


def _running(groups: DataFrame, n_groups: int) -> DataFrame:
    """Each group with the bytes of all groups up to it, in the order of the digests.

    Digests are uniform, so their leading bits make even blocks: block totals are summed
    up first, then the groups within each block.
    """
    blocks = spread(n_groups, BLOCK_ROWS, MOST_BLOCKS)
    width = 65_536 // blocks
    lead = F.conv(F.substring("digest", 1, 4), 16, 10).cast("int")
    groups = groups.withColumn("block", F.floor(F.coalesce(lead, F.lit(0)) / width).cast("int"))
    before = groups.groupBy("block").agg(F.sum("bytes").alias("of_block"))
    before = before.select(
        "block",
        (F.sum("of_block").over(Window.orderBy("block")) - F.col("of_block")).alias("before"),
    )
    within = Window.partitionBy("block").orderBy("digest")
    return groups.withColumn("within", F.sum("bytes").over(within)).join(
        before, "block"
    ).select("digest", (F.col("before") + F.col("within")).alias("end"))
