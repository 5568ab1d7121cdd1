"""Fill-in-the-middle: texts cut in three at line ends and put together in another order.

The ends of a text's lines form a compressed set (``boundaries``). Two hashes of the id choose
how many lines come before each cut, and the set tells where these lines end. Python sees the
texts to find the cuts only; hashes, pieces and outputs are expressions of Spark.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.boundaries import line_ends
from shelfpulse.llm.common import ship

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Infill:
    """The marks before prefix, suffix and middle, and how often texts are transformed.

    ``rate`` of 100 texts are cut, ``spm`` of 100 of these have the suffix first. ``seed``
    goes into the hashes.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    rate: int = 100
    spm: int = 50
    seed: int = 7


def _cuts(text: bytes, first: int, second: int) -> tuple[int, int, int]:
    """Lines of a text, and the bytes before each cut.

    A cut comes after ``first % (lines + 1)`` lines, the other after ``second % (lines + 1)``.
    """
    ends = line_ends(text)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends.select(low - 1) + 1 if low else 0, ends.select(high - 1) + 1 if high else 0


_FOUND = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "low", "high")])


@F.pandas_udf(_FOUND)
def _find_cuts(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    rows = [
        _cuts(text.encode(), int(a), int(b))
        for text, a, b in zip(texts, first, second, strict=True)
    ]
    return pd.DataFrame(rows, columns=["n", "low", "high"])


def _unsigned(digest: Column, group: int) -> Column:
    """One of the first four groups of eight hex digits as a number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def with_infill(
    docs: DataFrame, options: Infill = Infill(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` and n, form, prefix, middle, suffix, output.

    n is the number of lines. form is ``psm`` (marks and pieces in the order prefix, suffix,
    middle), ``spm`` (suffix, prefix, middle), or ``plain``, where the output is the text and
    the pieces are null: the text is empty, holds a mark, or is not among the ``rate`` of 100
    that are transformed. Cuts and form follow from id and seed, so reruns agree and repeated
    rows get equal outputs; a null id counts as an empty one. A null text counts as empty.
    Own columns of the names added are replaced, other columns stay. Texts of any length are
    cut whole. An empty table gives no row.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(
        F.concat(F.lit(f"{options.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256
    )
    marks = (options.prefix, options.suffix, options.middle)
    plain = (text == "") | (_unsigned(digest, 2) % 100 >= options.rate)
    for mark in marks:
        plain |= text.contains(mark)
    form = (
        F.when(plain, PLAIN)
        .when(_unsigned(digest, 3) % 100 < options.spm, SPM)
        .otherwise(PSM)
    )
    added = ["n", "form", "prefix", "middle", "suffix", "output"]
    found = _find_cuts(text, _unsigned(digest, 0), _unsigned(digest, 1))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    cut = docs.select(own.alias("own"), text.alias("t"), form.alias("f"), found.alias("c"))
    data = F.col("t").cast("binary")

    def piece(begin: Column, size: Column) -> Column:
        """Bytes of the text; cuts lie between characters."""
        return F.when(
            F.col("f") != PLAIN, F.substring(data, (begin + 1).cast("int"), size.cast("int")).cast("string")
        )

    low, high = F.col("c.low"), F.col("c.high")
    parts = cut.select(
        "own", "t", "f", F.col("c.n").alias("n"),
        piece(F.lit(0), low).alias("p"),
        piece(low, high - low).alias("m"),
        piece(high, F.octet_length("t") - high).alias("s"),
    )
    p, s, m = (F.lit(x) for x in marks)
    output = (
        F.when(F.col("f") == PLAIN, F.col("t"))
        .when(F.col("f") == PSM, F.concat(p, "p", s, "s", m, "m"))
        .otherwise(F.concat(s, "s", p, "p", m, "m"))
    )
    kept = [F.col(f"own.`{c}`").alias(c) for c in docs.columns if c not in added]
    return parts.select(
        *kept, "n", F.col("f").alias("form"), F.col("p").alias("prefix"),
        F.col("m").alias("middle"), F.col("s").alias("suffix"), output.alias("output"),
    )


def restored(output: Column, form: Column, options: Infill = Infill()) -> Column:
    """The text that an output of a form was made of, from these two alone."""
    marks = (options.prefix, options.suffix, options.middle)
    # Java's quoting; a text that holds a mark is plain, so each mark occurs once.
    pattern = "|".join("\\Q" + mark.replace("\\E", "\\E\\\\E\\Q") + "\\E" for mark in marks)
    part = F.split(output, pattern, -1)
    return (
        F.when(form == PLAIN, output)
        .when(form == PSM, F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )


def restored_text(output: str, form: str, options: Infill = Infill()) -> str:
    """``restored`` of one output."""
    if form == PLAIN:
        return output
    marks = (options.prefix, options.suffix, options.middle)
    _, one, two, three = re.split("|".join(map(re.escape, marks)), output)
    return one + three + two if form == PSM else two + three + one
