"""Row rules and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.operators.bloom import MOST_WORDS, bloom_filter, may_hold, words_for
from shelfpulse.operators.joins import join_same
from shelfpulse.scratch import stage


@dataclass(frozen=True)
class Checked:
    """Rows that pass, rows that fail with the names of the broken rules, and counts."""

    good: DataFrame
    quarantine: DataFrame
    report: DataFrame


def rule_report(
    df: DataFrame, rules: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Per rule: rows checked and rows failed, in one pass; for each group of ``by``.

    Like a CHECK constraint, a rule that evaluates to null is not broken.
    """
    counts = df.groupBy(*by).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~passed).alias(name) for name, passed in rules.items()],
    )
    return _unpivot(
        counts,
        [
            F.struct(
                *by,
                F.lit(name).alias("rule"),
                F.col("_rows").alias("checked_rows"),
                F.col(name).alias("failed_rows"),
            )
            for name in rules
        ],
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often; keys with a null part do not count."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )


def check(
    df: DataFrame,
    rules: Mapping[str, Column],
    unique: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> Checked:
    """Split rows by the rules; ``unique`` adds a rule that a key occurs once.

    The report has a row for each rule, or for each rule and group of ``by``; uniqueness is a
    matter of all rows and has no groups.

    All copies of a repeated key fail. The copies are counted by a partial aggregate and
    joined back, not gathered in a window; the report needs only the counts.
    """
    if unique and by:
        raise ValueError("uniqueness cannot be reported by group")
    rules = dict(rules)
    reports = [rule_report(df, rules, by)] if rules else []
    if unique:
        reports.append(_unique_report(df, unique))
        copies = repeated_keys(df, unique).withColumnRenamed("copies", "_copies")
        df = df.join(copies, list(unique), "left")
        rules[_unique_rule(unique)] = F.col("_copies").isNull()
    broken = F.filter(
        F.array(*[F.when(~passed, F.lit(name)) for name, passed in rules.items()]),
        lambda name: name.isNotNull(),
    )
    marked = df.withColumn("broken_rules", broken)
    extra = ["_copies"] if unique else []
    return Checked(
        good=marked.where(F.size("broken_rules") == 0).drop("broken_rules", *extra),
        quarantine=marked.where(F.size("broken_rules") > 0).drop(*extra),
        report=reduce(DataFrame.unionByName, reports),
    )


def missing_keys(fact: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``fact`` that the dimension does not have, each once; null parts are no fault.

    Both sides meet as distinct keys, so a hot key costs a row of each task.
    """
    asked = fact.select(*keys).dropna().distinct()
    return asked.join(dimension.select(*keys).distinct(), list(keys), "left_anti")


def check_references(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    rule: str,
    by: Sequence[str] = (),
    most_words: int = MOST_WORDS,
) -> Checked:
    """Split rows by whether the dimension has their key, like a foreign key constraint.

    The keys that are missing make a Bloom filter of at most ``most_words`` words, which
    every row is tested against where it is. Rows of known keys go straight through; only
    rows that may be orphans are compared with the missing keys themselves. Orphans go to
    quarantine under the name of the rule; a key with a null part breaks no rule.

    ``fact`` is read for its keys and for the rows of either side; pass a table.
    """
    keys = list(keys)
    hashed = F.xxhash64(*keys)
    missing = stage(missing_keys(fact, dimension, keys).withColumn("_hash", hashed), "missing")
    words = words_for(missing.count(), most_words)
    suspect = may_hold(bloom_filter(missing.select("_hash"), words), hashed, words)
    maybe, names = fact.where(suspect), missing.select(*keys)
    orphans = maybe.join(names, keys, "left_semi").select(*fact.columns)
    cleared = maybe.join(names, keys, "left_anti").select(*fact.columns)
    if by:
        failed = orphans.groupBy(*by).agg(F.count("*").alias("_failed"))
        counts = join_same(fact.groupBy(*by).agg(F.count("*").alias("_rows")), failed, by, "left")
    else:
        counts = fact.agg(F.count("*").alias("_rows"))
        counts = counts.withColumn("_failed", orphans.agg(F.count("*")).scalar())
    return Checked(
        good=fact.where(~suspect).unionByName(cleared),
        quarantine=orphans.withColumn("broken_rules", F.array(F.lit(rule))),
        report=counts.select(
            *by,
            F.lit(rule).alias("rule"),
            F.col("_rows").alias("checked_rows"),
            F.coalesce("_failed", F.lit(0)).alias("failed_rows"),
        ),
    )


def _unique_rule(keys: Sequence[str]) -> str:
    return "unique_" + "_".join(keys)


def _unique_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    whole = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    repeated = F.when(whole & (F.col("copies") > 1), F.col("copies"))
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .agg(
            F.lit(_unique_rule(keys)).alias("rule"),
            F.coalesce(F.sum("copies"), F.lit(0)).alias("checked_rows"),
            F.coalesce(F.sum(repeated), F.lit(0)).alias("failed_rows"),
        )
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows and nulls, in one pass."""
    names = {f"c{i}": field for i, field in enumerate(df.schema.fields)}
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{field.name}`").isNull()).alias(c) for c, field in names.items()],
    )
    return _unpivot(
        counts,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col("_rows").alias("row_count"),
                F.col(c).alias("null_count"),
            )
            for i, (c, field) in enumerate(names.items())
        ],
    )


def _unpivot(rows: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return rows.select(F.inline(F.array(*structs)))
