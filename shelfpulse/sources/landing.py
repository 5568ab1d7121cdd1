"""Readers for landed API responses and the seed list."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.schemas import CORRUPT, GAME_DETAIL, review_page

PAGE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_review_pages(
    spark: SparkSession,
    path: str,
    keys: Mapping[str, str] | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """One row per landed response, JSON lines, declared schema.

    Folders named ``crawl_dt=``, ``appid=`` or ``page=`` fill the columns of that name, and
    a filter on them prunes files. A line that does not match keeps its text in the
    corrupt column; what could be read of it stays. ``keys`` names keys of the payload that
    are not our column names. With ``files`` only these files below ``path`` are opened.
    """
    reader = spark.read.schema(review_page(keys)).options(**PAGE_OPTIONS)
    if files is None:
        return reader.json(path)
    if not files:
        return spark.createDataFrame([], review_page(keys))
    return reader.option("basePath", path).json([_literal(file) for file in files])


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _file() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]


def located(pages: DataFrame) -> DataFrame:
    """Scanned pages with the file that each comes from and its time of change."""
    return pages.select("*", *_file())


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """file, modified and path of each landed file; none is opened.

    ``file`` is the name that scanned rows carry, ``path`` the one to open it by.
    """
    return spark.read.format("binaryFile").load(path).select(*_file(), "path")


def readable_page(pages: DataFrame) -> Column:
    """Whether the review list of a line could be read.

    A column ``n_reviews``, null where there is no list, spares the reading of the lists.
    """
    listed = "n_reviews" if "n_reviews" in pages.columns else "reviews"
    return F.col(CORRUPT).isNull() | F.col(listed).isNotNull()


def intact_pages(pages: DataFrame) -> DataFrame:
    """Pages whose review list could be read; a failed read is not an empty page."""
    return pages.where(readable_page(pages)).drop(CORRUPT)


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """The lines to look at by hand."""
    return pages.where(~readable_page(pages)).select("crawl_dt", "appid", "page", CORRUPT)


def parse_game_details(lines: DataFrame, column: str = "value") -> DataFrame:
    """Objects keyed by app id, one row per key: appid, success, data."""
    details = F.explode(F.from_json(F.col(column), GAME_DETAIL)).alias("key", "detail")
    crawl = [c for c in lines.columns if c == "crawl_dt"]
    return lines.select(details, *crawl).select(
        F.col("key").try_cast("bigint").alias("appid"),
        F.col("detail.success").alias("success"),
        F.col("detail.data").alias("data"),
        *crawl,
    )


def read_game_details(spark: SparkSession, path: str) -> DataFrame:
    """Landed detail responses, one JSON object per line.

    If the landing zone has ``crawl_dt=`` folders, rows carry that column, and all crawls
    are read: a game that the last one missed is still a game.
    """
    return parse_game_details(spark.read.text(path))


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``name:appid``; a name may contain colons, malformed lines are left out."""
    line = F.trim("value")
    return (
        spark.read.text(path)
        .where(line.rlike(r"^.*:\s*\d+$"))
        .select(
            F.trim(F.regexp_extract(line, r"^(.*):\s*(\d+)$", 1)).alias("name"),
            F.regexp_extract(line, r"^(.*):\s*(\d+)$", 2).try_cast("bigint").alias("appid"),
        )
    )
