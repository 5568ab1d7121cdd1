from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfpulse.llm.sharding import shard


def smallest_capacity(sizes, shards):
    """Brute force: the least capacity that greedy filling gets by with."""
    def fits(capacity):
        used, left = 1, capacity
        for size in sizes:
            if size > capacity:
                return False
            if size > left:
                used, left = used + 1, capacity
            left -= size
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def checked(docs, shards):
    rows = shard(docs, shards).collect()
    slots = defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(slots) <= set(range(shards))
    return rows


def test_smallest_capacity_in_digest_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = checked(docs, 8)
    assert len(rows) == docs.count()
    loads = defaultdict(int)
    for row in rows:
        loads[row["shard"]] += row["size"]
    groups = (
        docs.groupBy(F.sha2("text", 256).alias("d"))
        .agg(F.sum(F.octet_length("text") + 1).alias("s"))
        .orderBy("d")
        .collect()
    )
    assert max(loads.values()) == smallest_capacity([g["s"] for g in groups], 8)


def test_equal_texts_stay_together_and_a_large_group_is_alone(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 200, F.lit("copy " * 9)).otherwise(F.col("id").cast("string")).alias("text"),
    )
    rows = checked(docs, 4)
    copies = {row["shard"] for row in rows if row["size"] == 46}
    assert len(copies) == 1
    others = [row for row in rows if row["size"] != 46]
    assert not copies & {row["shard"] for row in others}
    counts = defaultdict(int)
    for row in others:
        counts[row["shard"]] += row["size"]
    assert len(counts) == 3 and max(counts.values()) - min(counts.values()) <= 8


def test_odd_rows(odd_docs, no_docs):
    rows = checked(odd_docs, 3)
    assert len(rows) == odd_docs.count()
    assert sorted(r["size"] for r in rows if r["doc_id"] == 4) == [1, 1]
    assert {r["text_crc32"] for r in rows if r["doc_id"] == 4} == {None}
    assert {r["text_crc32"] for r in rows if r["doc_id"] == 5} == {0}
    assert shard(no_docs, 3).count() == 0


@pytest.mark.parametrize("shards", [1, 20])
def test_one_shard_and_more_shards_than_groups(odd_docs, shards):
    assert len(checked(odd_docs, shards)) == odd_docs.count()
