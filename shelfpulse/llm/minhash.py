"""Near-duplicate documents by min-max hashing, every link confirmed on full sets.

A signature keeps the smallest and the largest value of a document's shingles under each
permutation, two values for one evaluation; both agree between two documents with a
probability of their Jaccard similarity. Bands of four values (two permutations) make the
buckets in which documents meet.

Documents of equal sets are one class and travel as one. In a bucket, classes are compared
with a few pivots only, not with each other, and what that links becomes one component. Only
buckets that still hold several components are compared in full, block by block and without
giving out pairs: a block gives out the links that join components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.blocks import in_blocks
from shelfpulse.llm.common import ship
from shelfpulse.llm.components import components
from shelfpulse.llm.words import mix, numbers, shingle_sets
from shelfpulse.scratch import stage

#: A band is two permutations, four values. At a similarity of 0.8 a pair shares none of 28
#: bands with a probability of 4e-7, at 0.85 of 1e-9.
BANDS = 28
#: Classes that each bucket is compared with at first.
PIVOTS = 4
#: Shingles that a side of a block holds, and the most and fewest sets of a side.
BLOCK_SHINGLES, MOST_SETS, LEAST_SETS = 2_000_000, 1024, 16


def signatures(sets: list[np.ndarray], bands: int) -> np.ndarray:
    """Band hashes of each set, a row per set; sets must not be empty."""
    sizes = np.array([len(s) for s in sets])
    whole = np.concatenate(sets)
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    factors, spread = numbers(2 * bands, 11), numbers(4, 13)
    out = np.zeros((len(sets), bands), np.uint64)
    for i, factor in enumerate(factors):
        values = whole * factor
        k = 2 * (i % 2)
        out[:, i // 2] += np.minimum.reduceat(values, heads) * spread[k]
        out[:, i // 2] += np.maximum.reduceat(values, heads) * spread[k + 1]
    return mix(out + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def set_id(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart: two sums of differently mixed members."""
    a = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b ^ np.uint64(len(shingles))).to_bytes(8, "big")


def _with_signatures(docs: DataFrame, width: int, bands: int) -> DataFrame:
    def signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, ids = frame["t"].tolist(), frame["doc_id"].to_numpy(object)
            hashes = frame["text_hash"].to_numpy()
            for held, sets in shingle_sets(texts, width):
                full = [j for j, s in enumerate(sets) if len(s)]
                rows = np.zeros((0, bands), np.uint64)
                if full:
                    rows = signatures([sets[j] for j in full], bands)
                by_set: list = [None] * len(sets)
                for j, row in zip(full, rows.view(np.int64), strict=True):
                    by_set[j] = row
                yield pd.DataFrame(
                    {
                        "doc_id": ids[held],
                        "text_hash": hashes[held],
                        "n_shingles": [len(s) for s in sets],
                        "set_id": [set_id(s) if len(s) else None for s in sets],
                        "bands": by_set,
                    }
                )

    schema = "doc_id string, text_hash long, n_shingles long, set_id binary, bands array<long>"
    return docs.mapInPandas(signed, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def _with_sets(docs: DataFrame, width: int) -> DataFrame:
    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, sets in shingle_sets(frame["t"].tolist(), width):
                full = [s for s in sets if len(s)]
                yield pd.DataFrame(
                    {"set_id": [set_id(s) for s in full], "shingles": [s.view(np.int64) for s in full]}
                )

    return docs.select("t").mapInPandas(made, "set_id binary, shingles array<long>")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    least: int = 80,
    bands: int = BANDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_hash for each row.

    Texts are lower-cased in A-Z; a document's set holds its distinct shingles of ``width``
    words, or its whole sequence if it has fewer. Two documents are linked if the
    intersection is at least ``least`` hundredths of the union. component_id is the smallest
    doc_id that links lead to, and kept tells whether it is the row's own.

    Null, empty and blank texts have no shingles and are linked with nothing: each keeps its
    own id. Rows that repeat an id and text are kept or not alike. A null id never names a
    component that has another id. An empty table gives no row. Other columns are not read.
    """
    ship(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
    )
    sent = texts.withColumn("doc_id", F.col("doc_id").cast("string"))
    rows = stage(_with_signatures(sent, width, bands), "minhash-rows")
    classes = stage(
        rows.where("set_id is not null")
        .groupBy("set_id")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        ),
        "minhash-classes",
    )
    members = _members(classes)
    sets = _candidate_sets(texts, classes, members, width)
    links = stage(_pivot_links(members, sets, least), "minhash-links")
    near = components(links)
    rest = _block_links(members, sets, near, least)
    roots = components(links.unionByName(rest))

    labels = classes.join(roots, classes["set_id"] == roots["node"], "left").select(
        "set_id", "first_id", F.coalesce("root", "set_id").alias("root")
    )
    labels = stage(labels, "minhash-labels")
    # From files, so that the join may deal the labels of a very large component anew.
    named = stage(labels.groupBy("root").agg(F.min("first_id").alias("component_id")), "minhash-least")
    named = stage(labels.join(named, "root").select("set_id", "component_id"), "minhash-named")
    out = rows.select("doc_id", "n_shingles", "set_id", "text_hash").join(named, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash",
    )


def without_near_duplicates(
    docs: DataFrame,
    width: int = 5,
    least: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each component of ``near_duplicates``, with all columns of ``docs``.

    It is the row whose id names the component. Texts without words are linked with nothing
    and all stay; rows that repeat id and text give one row, that with the smallest hash of all
    its columns, so reruns agree. Of a component whose rows all lack an id, the rows of each
    different text give one. Columns may have any names.
    """
    found = near_duplicates(docs, width, least, BANDS, id_col, text_col)
    kept = found.where("kept").select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(
        F.struct(*columns).alias("own"),
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col)).alias("hash"),
        F.xxhash64(*columns).alias("whole"),
    )
    first = Window.partitionBy("id", "hash").orderBy("whole")
    return (
        keyed.join(kept.distinct(), F.col("id").eqNullSafe(F.col("k_id")) & (F.col("hash") == F.col("k_hash")))
        .withColumn("copy", F.row_number().over(first))
        .where("copy = 1")
        .select(*[F.col(f"own.`{c}`").alias(c) for c in docs.columns])
    )


def _members(classes: DataFrame) -> DataFrame:
    """bucket, set_id and n of all classes that share a bucket with another class."""
    dealt = stage(
        classes.select("set_id", "n", F.explode("bands").alias("bucket")), "minhash-dealt"
    )
    shared = stage(
        dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket"),
        "minhash-shared",
    )
    return stage(dealt.join(shared, "bucket"), "minhash-members")


def _candidate_sets(
    texts: DataFrame, classes: DataFrame, members: DataFrame, width: int
) -> DataFrame:
    """Full sets of the classes that have a partner in some bucket, from one text each."""
    wanted = members.select("set_id").distinct()
    ids = classes.join(wanted, "set_id", "left_semi").select(
        F.col("first_id").alias("wanted_id")
    )
    # A class without any id is found among the texts without one.
    read = texts.join(ids.distinct(), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    made = _with_sets(read, width).dropDuplicates(["set_id"])
    return stage(made.withColumn("n", F.size("shingles").cast("long")), "minhash-sets")


def _alike(common: Column, n: Column, m: Column, least: int) -> Column:
    return common * 100 >= (n + m - common) * least


def _pivot_links(members: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links of each class to the pivots of its buckets.

    Pivots come first in an order that all buckets share, so that a class meets the same
    few pivots in all of them.
    """
    order = [F.struct(F.xxhash64("set_id", F.lit(i)).alias("h"), "set_id") for i in range(PIVOTS)]
    pivots = members.groupBy("bucket").agg(
        *[F.min(x)["set_id"].alias(f"p{i}") for i, x in enumerate(order)]
    )
    pivots = stage(
        pivots.select("bucket", F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)])).alias("pivots")),
        "minhash-pivots",
    )
    pairs = (
        members.join(pivots, "bucket")
        .select(F.col("set_id").alias("a"), F.explode("pivots").alias("b"))
        .where("a <> b")
        .distinct()
    )
    pairs = stage(pairs, "minhash-pairs")
    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("s"), F.col("n"))
    right = sets.select(
        F.col("set_id").alias("b"), F.col("shingles").alias("t"), F.col("n").alias("m")
    )
    met = pairs.join(right.select("b", "m"), "b").join(left.select("a", "n"), "a")
    met = met.where(
        F.least("n", "m") * 100 >= F.greatest("n", "m") * least
    ).select("a", "b")
    met = stage(met, "minhash-met")
    common = F.size(F.array_intersect("s", "t"))
    return (
        met.join(left, "a")
        .join(right, "b")
        .where(_alike(common, F.col("n"), F.col("m"), least))
        .select("a", "b")
    )


def _block_links(
    members: DataFrame, sets: DataFrame, near: DataFrame, least: int
) -> DataFrame:
    """Links between components that are left in one bucket, compared in full.

    A bucket's classes are dealt into sides of bounded size, and each pair of sides is one
    block. Buckets of two are settled by their pivot.
    """
    rooted = stage(
        members.join(near, members["set_id"] == near["node"], "left").select(
            "bucket", "set_id", "n", F.coalesce("root", "set_id").alias("root")
        ),
        "minhash-rooted",
    )
    per_side = F.greatest(
        F.lit(LEAST_SETS),
        F.least(F.lit(MOST_SETS), F.floor(F.lit(BLOCK_SHINGLES) / F.max("n"))),
    )
    open_buckets = stage(
        rooted.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("c"),
            (F.min("root") != F.max("root")).alias("several"),
            F.ceil(F.count(F.lit(1)) / per_side).cast("int").alias("sides"),
        )
        .where("c > 2 and several")
        .select("bucket", "sides"),
        "minhash-open",
    )
    blocks = in_blocks(rooted.join(open_buckets, "bucket"), "bucket", "set_id")
    blocks = stage(blocks.drop("n"), "minhash-blocks")
    full = blocks.join(sets, "set_id")

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_bridges(frame, least), columns=["a", "b"])

    return stage(
        full.groupBy("bucket", "low", "high").applyInPandas(joined, "a binary, b binary").distinct(),
        "minhash-rest",
    )


def _bridges(frame: pd.DataFrame, least: int) -> list[tuple[bytes, bytes]]:
    """Links of a block that join components: a forest, not all pairs.

    Sets are taken by size; each is compared at once with all larger ones near enough in
    size that lie in another component as known so far.
    """
    frame = frame.sort_values("n", kind="stable")
    ids, sides = frame["set_id"].tolist(), frame["side"].to_numpy()
    sizes, sets = frame["n"].to_numpy(), frame["shingles"].tolist()
    _, root = np.unique([bytes(x) for x in frame["root"]], return_inverse=True)
    within = frame["low"].iat[0] == frame["high"].iat[0]
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    heads = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(values), np.int32)
    out = []
    for i in range(len(ids) - 1):
        upto = int(np.searchsorted(sizes * least, sizes[i] * 100, side="right"))
        if upto <= i + 1:
            continue
        ask = root[i + 1 : upto] != root[i]
        if not within:
            ask &= sides[i + 1 : upto] != sides[i]
        near = np.flatnonzero(ask) + i + 1
        if not len(near):
            continue
        own = where[heads[i] : heads[i + 1]]
        marked[own] = 1
        first, last = near[0], near[-1]
        part = marked[where[heads[first] : heads[last + 1]]]
        common = np.add.reduceat(part, heads[first : last + 1] - heads[first])[near - first]
        marked[own] = 0
        linked = common * 100 >= (sizes[i] + sizes[near] - common) * least
        for j in near[linked]:
            if root[j] != root[i]:
                out.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return out
