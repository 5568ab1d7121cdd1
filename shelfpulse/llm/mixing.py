"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import numbered, word_count
from shelfpulse.scratch import stage

#: A document is taken at most so many times.
MOST_COPIES = 3
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: Parts of the random ranks whose words are summed before the cut is looked for.
RANK_PARTS = 4096
SEED = "mix"


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """How often the mix takes each document, so that sources come near their targets.

    Sizes are words. Sources by code point, null last, weigh ``weights`` in turn and share
    all words; no target exceeds ``most_copies`` times its source, and what that cuts off
    goes to the others by weight. Of a source with target t and size s, every document is
    taken floor(t/s) times for certain. The rest is a Pareto sample with unequal odds: a
    document's inclusion odds are those of a word of its source, P/(1-P) for the share P of
    its words that is open, times the root of the document's size over the mean one. Each
    document gets a random u, ranks by its odds u/(1-u) over its inclusion odds, and documents
    are taken in rank order until their words reach what the target leaves; the one on the
    edge goes in if that brings the words nearer to the target.

    Returns doc_id, size, source, repeat, source_size, target, copies and taken, a row for
    each input row; repeat numbers the rows of one id, source and size. u depends on the
    seed, the id and this number, so reruns agree. Null and empty texts have size 0 and are
    taken 0 words. A null source is a source of its own. An empty table gives an empty
    result. Other columns are not read, whatever their names.
    """
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.lit(0).cast("long").alias("digest"),
    )
    return _mix(sized, weights, most_copies, seed).drop("digest")


def _mix(sized: DataFrame, weights: tuple[int, ...], most_copies: int, seed: str) -> DataFrame:
    """``mix`` of rows that are told apart by doc_id, source, size and digest."""
    # Equal rows travel as a count, so that no number of them meets in one window.
    sized = stage(
        sized.groupBy("doc_id", "source", "size", "digest").agg(F.count(F.lit(1)).alias("rows")),
        "mix-sized",
    )
    # From files, whose size Spark knows: it broadcasts the targets if they are below its
    # threshold, and only then, and shuffles no documents before it finds out.
    targets = stage(_targets(sized, weights, most_copies), "mix-targets")
    targets = targets.withColumnRenamed("source", "t_source")
    rows = numbered(sized, "rows", F.lit(1).cast("long"), "repeat").drop("rows")
    met = rows.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
    return _taken(stage(_ranked(met, seed), "mix-ranked"))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: none, once or several times.

    All columns stay as they are, whatever their names. Rows of one id, source and size are
    told apart by a hash of all their columns, which also goes into their random numbers, so
    reruns agree. Rows that are equal in all columns are drawn together, as often as all of
    them are taken. Otherwise as ``mix``.
    """
    names = docs.columns
    own = F.struct(*[F.col(f"`{c}`") for c in names])
    keyed = docs.select(
        own.alias("own"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("digest"),
    )
    key = ["doc_id", "source", "size", "digest"]
    plan = (
        _mix(keyed.select(*key), weights, most_copies, seed)
        .groupBy(*key)
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
        .where("copies > 0")
    )
    plan = stage(plan.select(*[F.col(c).alias(f"p_{c}") for c in [*key, "copies", "rows"]]), "mix-plan")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in key])
    once = keyed.join(plan.where("p_rows = 1"), same).select("own", "p_copies")
    once = once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "p_copies")))
    out = once.select("own")
    repeated = plan.where("p_rows > 1")
    if not repeated.isEmpty():
        # One row stands for all that are equal to it.
        equal = keyed.join(repeated, same).groupBy("own").agg(F.max("p_copies").alias("p_copies"))
        equal = stage(equal, "mix-repeated")
        copies = numbered(equal, "p_copies", F.lit(1).cast("long"), "copy")
        out = out.unionByName(copies.select("own"))
    return out.select(*[F.col(f"own.`{c}`").alias(c) for c in names])


def _targets(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """A row per source: its size and its target in words.

    One row per source meets in a window; documents do not.
    """
    words = F.col("size") * F.col("rows")
    full = F.when(F.col("size") > 0, F.col("rows"))
    sizes = sized.groupBy("source").agg(
        F.sum(words).alias("source_size"), F.coalesce(F.sum(full), F.lit(0)).alias("source_docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    # A source is held at its ceiling if its ceiling per weight lies below the level at
    # which the others share the rest; in that order the held ones come first.
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    shares = (
        sizes.withColumn("weight", weight)
        .withColumn("ceiling", F.col("source_size").cast("double") * most)
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("held_before", F.sum("ceiling").over(by_ratio) - F.col("ceiling"))
        .withColumn(
            "weight_left",
            F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"),
        )
        .withColumn("level", (F.col("total") - F.col("held_before")) / F.col("weight_left"))
        # The first source that stays below its ceiling sets the level for all after it.
        .withColumn(
            "common",
            F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(
                everything
            )["level"],
        )
    )
    return shares.select(
        "source",
        "source_size",
        "source_docs",
        F.least(
            F.col("ceiling"),
            F.coalesce(F.col("common") * F.col("weight"), F.col("ceiling")),
        ).alias("target"),
    )


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on ``parts`` only: 52 bits of their MD5."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(16**13))


def _ranked(joined: DataFrame, seed: str) -> DataFrame:
    share = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(share + 1e-12)).otherwise(0).cast("long")
    p = F.col("open") / F.col("source_size")
    parts = [F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("repeat").cast("string")]
    told_apart = F.when(F.col("digest") != 0, F.col("digest").cast("string"))
    mean = F.col("source_size") / F.col("source_docs")
    odds = p / (1 - p) * F.sqrt(F.col("size") / mean)
    sampled = (F.col("open") > 0.5) & (F.col("size") > 0)
    return (
        joined.withColumn("whole", whole)
        .withColumn("open", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("u", uniform(*parts, told_apart))
        .withColumn("rank", F.when(sampled, (F.col("u") / (1 - F.col("u"))) / odds))
        # Ranks in units of the source's odds lie around one: their share is spread evenly.
        .withColumn("even", F.col("rank") * (p / (1 - p)))
        .withColumn("part", F.floor(F.col("even") / (1 + F.col("even")) * RANK_PARTS).cast("int"))
        .select(
            "doc_id", "source", "size", "digest", "source_size", "target", "whole", "open",
            "repeat", "rank", "part",
        )
    )


def _taken(ranked: DataFrame) -> DataFrame:
    """Cut each source's ranking where its words reach what is open.

    Words are summed by spans of ranks; only the span in which the cut lies is sorted, about
    a 4096th of the source.
    """
    sums = ranked.where(F.col("rank").isNotNull()).groupBy("source", "part").agg(
        F.sum("size").alias("words"), F.first("open").alias("left_open")
    )
    order = Window.partitionBy("source").orderBy("part")
    edges = (
        sums.withColumn("upto", F.sum("words").over(order))
        .where((F.col("upto") >= F.col("left_open")) & (F.col("upto") - F.col("words") < F.col("left_open")))
        .select(
            F.col("source").alias("e_source"),
            F.col("part").alias("edge"),
            (F.col("upto") - F.col("words")).alias("before"),
        )
    )
    edges = stage(edges, "mix-edges")
    with_edge = ranked.join(edges, F.col("source").eqNullSafe(F.col("e_source")), "left")
    on_edge = F.col("rank").isNotNull() & (F.col("part") == F.col("edge"))
    inside = F.col("rank").isNotNull() & (F.col("edge").isNull() | (F.col("part") < F.col("edge")))
    sure = with_edge.where(F.coalesce(~on_edge, F.lit(True))).withColumn(
        "extra", F.when(F.coalesce(inside, F.lit(False)), 1).otherwise(0)
    )
    running = Window.partitionBy("source").orderBy("rank", "doc_id", "digest", "repeat")
    edge_rows = with_edge.where(F.coalesce(on_edge, F.lit(False))).withColumn(
        "upto", F.col("before") + F.sum("size").over(running)
    )
    # The document on the edge goes in if more than half of it is still open.
    edge_rows = edge_rows.withColumn(
        "extra", F.when(F.col("upto") - F.col("size") / 2 < F.col("open"), 1).otherwise(0)
    ).drop("upto")
    return (
        sure.unionByName(edge_rows)
        .withColumn("copies", F.col("whole") + F.col("extra"))
        .select(
            "doc_id",
            "size",
            "source",
            "digest",
            "repeat",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )
