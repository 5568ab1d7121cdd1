"""Small helpers shared by the operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the tasks this package, as ``--py-files`` does, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # The driver serves the file to executors from here for as long as it runs.
    folder = tempfile.mkdtemp(prefix="ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/{os.path.basename(package)}.zip"
    with zipfile.ZipFile(name, "w") as out:
        for place, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(place, file)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def spread(rows: int, per_part: int, most: int) -> int:
    """A power of two: parts of about ``per_part`` rows, at most ``most`` of them."""
    parts = 1
    while parts < most and rows > parts * per_part:
        parts *= 2
    return parts


#: Copies that one row becomes within a task, and copies of a task.
PIECE, TASK_COPIES = 4096, 1 << 18


def numbered(rows: DataFrame, count: str, first: Column, name: str) -> DataFrame:
    """Each row as often as its ``count`` says, with a running number from ``first`` on.

    A row with many copies becomes pieces that are dealt to tasks before they are drawn out, so
    that no number of equal rows meets in one array or one task. ``rows`` are looked at for
    such rows first; pass a staged table or what follows from one without a shuffle.
    """
    many = F.col(count) > PIECE
    hot = rows.where(many).agg(F.sum(count)).first()[0]

    def drawn(part: DataFrame, begin: Column, size: Column) -> DataFrame:
        return part.withColumn(name, F.explode(F.sequence(begin, begin + size - 1)))

    if not hot:
        return drawn(rows, first, F.col(count))
    pieces = rows.where(many).withColumn(
        "piece__", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / PIECE)))
    )
    pieces = pieces.repartition(min(4096, -(-hot // TASK_COPIES)), "piece__")
    done = F.col("piece__") * PIECE
    rest = F.least(F.col(count) - done, F.lit(PIECE).cast("long"))
    few = drawn(rows.where(~many), first, F.col(count))
    return few.unionByName(drawn(pieces, first + done, rest).drop("piece__"))
