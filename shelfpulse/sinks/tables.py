"""Catalog tables: create, replace, append, and refresh by day.

``fmt="parquet"`` works on the session catalog. ``fmt="iceberg"`` takes the same calls
to a catalog with row-level commits, where replace and refresh are one commit each.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.functions.dates import Days, DayWindow
from shelfpulse.operators.joins import join_same
from shelfpulse.scratch import delete_folder, stage
from shelfpulse.sinks.export import write_csv_backup

log = logging.getLogger(__name__)

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
ICEBERG = "iceberg"


@contextmanager
def overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """Set the partition overwrite mode of the session for a while.

    Threads that share the session must run inside one such block.
    """
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    partition_by: str | None = None,
    comments: Mapping[str, str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Create the table if it is not there."""
    comments = comments or {}

    def column(field: T.StructField) -> str:
        text = comments.get(field.name, "").replace("'", "\\'")
        note = f" COMMENT '{text}'" if text else ""
        return f"`{field.name}` {field.dataType.simpleString()}{note}"

    columns = ", ".join(column(field) for field in schema.fields)
    layout = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{layout}")


def spread_by_day(df: DataFrame, day: str = "dt") -> DataFrame:
    """Bring the rows of a day together for writing.

    REBALANCE lets AQE split a large day over several tasks and merge small days, so that
    neither one task writes a whole day nor every task writes a file for every day.
    """
    return df.hint("rebalance", F.col(day))


def replace_table(
    df: DataFrame,
    name: str,
    *,
    partition_by: str | None = None,
    skip_empty: bool = False,
    fmt: str = "parquet",
) -> int:
    """Swap the whole table; returns the rows written.

    A failed job leaves the old table, and ``df`` may read the table it replaces. With
    ``skip_empty``, a result without rows leaves the old table too. A table without partitions
    gets its rows in a folder of their own, to which one call to the catalog then points it:
    it can be read at all times. The folder before stays for those who are reading it, until
    the next replacement. Other columns than before need a new table: its rows are complete
    before the old one is dropped.
    """
    spark = df.sparkSession
    if fmt == ICEBERG:
        if skip_empty and df.isEmpty():
            return 0
        writer = df.writeTo(name).using(fmt)
        if partition_by:
            writer = writer.partitionedBy(F.col(partition_by))
        writer.createOrReplace()
        return verify_count(spark, name)
    if partition_by:
        return _replace_days(df, name, partition_by, skip_empty)
    if spark.catalog.tableExists(name):
        stored = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
        if stored == [(f.name, f.dataType) for f in df.schema.fields]:
            return _replace_files(df, name, fmt, skip_empty)
    incoming = f"{name}__incoming"
    spark.sql(f"DROP TABLE IF EXISTS {incoming}")
    df.write.format(fmt).saveAsTable(incoming)
    rows = verify_count(spark, incoming)
    if skip_empty and rows == 0:
        spark.sql(f"DROP TABLE {incoming}")
        return 0
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {incoming} RENAME TO {name}")
    return rows


VERSION = "__v_"


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def table_bytes(spark: SparkSession, name: str) -> int:
    """Size of the files below a table's folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_location(spark, name))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength()


def _replace_files(df: DataFrame, name: str, fmt: str, skip_empty: bool) -> int:
    spark = df.sparkSession
    current = _location(spark, name)
    _sweep(spark, name, current)
    folder, table = current.rsplit("/", 1)[0], name.rsplit(".", 1)[-1]
    path = f"{folder}/{table}{VERSION}{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).save(path)
    rows = spark.read.schema(df.schema).format(fmt).load(path).count()
    if skip_empty and rows == 0:
        delete_folder(spark, path)
        return 0
    point_to(spark, name, path)
    return rows


def point_to(spark: SparkSession, name: str, path: str) -> None:
    """Make a complete folder the files of a table, in one call to the catalog."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def _sweep(spark: SparkSession, name: str, current: str) -> None:
    """Delete folders of a table that it does not point to: old ones, and those of broken runs."""
    folder, table = current.rsplit("/", 1)[0], name.rsplit(".", 1)[-1]
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        found = status.getPath().getName()
        own = found == table or found.startswith(table + VERSION)
        if own and found != current.rsplit("/", 1)[-1]:
            files.delete(status.getPath(), True)


def _replace_days(df: DataFrame, name: str, day: str, skip_empty: bool) -> int:
    spark = df.sparkSession
    rows = df.select(*[c for c in df.columns if c != day], day)
    shape = [(field.name, field.dataType) for field in rows.schema.fields]
    if spark.catalog.tableExists(name):
        stored = [(field.name, field.dataType) for field in spark.table(name).schema.fields]
        if stored != shape:
            # Other columns than before: keep the rows safe, then start over.
            rows = stage(rows, "replacement")
            if skip_empty and rows.isEmpty():
                return 0
            spark.sql(f"DROP TABLE {name}")
    ensure_table(spark, name, rows.schema, partition_by=day)
    return _overwrite_days(rows, name, None, day, skip_empty=skip_empty)


def append_table(df: DataFrame, name: str, *, fmt: str = "parquet") -> None:
    """Add rows; columns are matched by name."""
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    if fmt == ICEBERG:
        rows.writeTo(name).append()
    else:
        rows.write.mode("append").insertInto(name)


def overwrite_from_sql(spark: SparkSession, sql: str, *, partitioned: bool = True) -> None:
    """Run an ``INSERT OVERWRITE TABLE ... WITH ... SELECT ...`` that replaces everything.

    ``partitioned=False`` says that the target has no partitions; the overwrite mode of the
    session does not matter then and is left alone.
    """
    with overwriting(spark, "static") if partitioned else nullcontext():
        spark.sql(sql)


UNDATED = "__HIVE_DEFAULT_PARTITION__"


def _partition_values(spark: SparkSession, name: str, day: str) -> list[str]:
    """Metadata only: one value per day the table holds."""
    specs = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [row[0].removeprefix(f"{day}=") for row in specs]


def table_days(spark: SparkSession, name: str, day: str = "dt") -> list[dt.date]:
    """The days a parquet table has partitions for, undated rows excluded."""
    values = _partition_values(spark, name, day)
    return sorted(dt.date.fromisoformat(v) for v in values if v not in (UNDATED, "null"))


def _drop_days(spark: SparkSession, name: str, days: Sequence[dt.date], day: str) -> None:
    if days:
        parts = ", ".join(f"PARTITION (`{day}`='{value.isoformat()}')" for value in days)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


def delete_window(
    spark: SparkSession, name: str, window: DayWindow, *, day: str = "dt", fmt: str = "parquet"
) -> None:
    """Remove the days of the window; undated rows stay."""
    if fmt == ICEBERG:
        upper = f" AND {day} <= DATE'{window.last}'" if window.last else ""
        spark.sql(f"DELETE FROM {name} WHERE {day} >= DATE'{window.first}'{upper}")
        return
    _drop_days(spark, name, [d for d in table_days(spark, name, day) if window.includes(d)], day)


def refresh_window(
    new: DataFrame,
    name: str,
    window: DayWindow | Days,
    *,
    keys: Sequence[str] | None = None,
    settled: DataFrame | None = None,
    row_key: Sequence[str] = ("appid", "recommendationid"),
    day: str = "dt",
    keep_undated: bool = True,
    fmt: str = "parquet",
) -> None:
    """Replace the window by ``new``; running it twice changes nothing.

    With ``keys``, only the rows of keys that ``new`` mentions are replaced, so that a
    game without new rows keeps its history; without, the whole window is. ``settled`` has
    more ``keys`` to replace, which may be without new rows. Rows of ``new``
    on a day outside the window belong to another refresh and are not written. Undated
    rows are added unless their ``row_key`` is already stored without a day;
    ``keep_undated=False`` says that there are none.

    ``new`` is read more than once: pass staged rows.
    """
    spark = new.sparkSession
    stored = spark.table(name)
    inside = new.where(window.holds(day)).select(*stored.columns)
    replacement = inside
    if keys:
        refreshed = inside.select(*keys)
        if settled is not None:
            refreshed = refreshed.unionByName(settled.select(*keys))
        refreshed = refreshed.distinct()
        kept = join_same(stored.where(window.holds(day)), refreshed, keys, "left_anti")
        replacement = kept.select(*stored.columns).unionByName(inside)

    if fmt == ICEBERG:
        spread_by_day(replacement, day).writeTo(name).overwrite(window.holds(day))
    else:
        _overwrite_days(replacement, name, window, day)

    if not keep_undated:
        return
    undated = new.where(F.col(day).isNull()).select(*stored.columns)
    if not undated.isEmpty():
        known = stored.where(F.col(day).isNull()).select(*row_key)
        append_table(join_same(undated, known, row_key, "left_anti"), name, fmt=fmt)


def _overwrite_days(
    rows: DataFrame, name: str, window: DayWindow | Days | None, day: str, *, skip_empty: bool = False
) -> int:
    """Dynamic partition overwrite, then drop the days that got no rows.

    ``window=None`` stands for the whole table, undated rows included. Until the job
    commits, the old files stay, so lost tasks are simply run again. The days written are
    noted on the way; there are no more of them than days in the calendar.
    """
    spark = rows.sparkSession
    before = [d for d in table_days(spark, name, day) if window is None or window.includes(d)]
    had_undated = bool({UNDATED, "null"} & set(_partition_values(spark, name, day)))
    noted = [
        F.collect_set(day).alias("days"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(day).isNull()).alias("undated"),
    ]
    written = Observation()
    with overwriting(spark, "dynamic"):
        observed = rows.observe(written, *noted)
        spread_by_day(observed, day).write.mode("overwrite").insertInto(name)
    try:
        seen = written.get
    except Py4JError:
        # A plan that turns out to be empty can lose its metrics; never guess here, since
        # the days that were not written are dropped.
        seen = rows.agg(*noted).first().asDict()
    if skip_empty and not seen["rows"]:
        return 0
    filled = set(seen["days"])
    _drop_days(spark, name, [d for d in before if d not in filled], day)
    if window is None and had_undated and not seen["undated"]:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{day}` = null)")
    return seen["rows"]


def replace_or_backup(
    df: DataFrame,
    name: str,
    csv_path: str,
    *,
    partition_by: str | None = None,
    fmt: str = "parquet",
) -> str:
    """Replace the table; if that fails, leave the rows as CSV. Tells which was written."""
    try:
        replace_table(df, name, partition_by=partition_by, fmt=fmt)
    except Exception:  # any failure of the table write leads to the backup
        log.exception("%s could not be written; its rows go to %s", name, csv_path)
        write_csv_backup(df, csv_path)
        return "csv"
    return "table"


def verify_count(spark: SparkSession, name: str) -> int:
    """Rows in the table after a write."""
    return spark.table(name).count()
