import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfpulse.llm.boundaries import (
    BLOCK,
    ArrayContainer,
    BitmapContainer,
    BoundarySet,
    RunContainer,
    container,
    line_ends,
)
from shelfpulse.llm.infill import Infill, restored, restored_text, with_infill


@pytest.mark.parametrize(
    "kind, low",
    [
        (ArrayContainer, np.array([0, 5, 9, 70, 65_535])),
        (ArrayContainer, np.array([3])),
        (RunContainer, np.r_[np.arange(10, 9_000), np.arange(20_000, 20_500), 65_535]),
        (RunContainer, np.arange(BLOCK)),
        (BitmapContainer, np.arange(0, BLOCK, 2)),
        (BitmapContainer, np.flatnonzero(np.random.default_rng(1).random(BLOCK) < 0.4)),
    ],
)
def test_containers_select_like_a_list(kind, low):
    held = container(low)
    assert type(held) is kind
    for k in {0, len(low) - 1, len(low) // 2, *np.random.default_rng(2).integers(0, len(low), 200)}:
        assert held.select(int(k)) == low[int(k)]


def test_select_over_containers():
    rng = np.random.default_rng(3)
    low = {0: np.array([7]), 2: np.arange(BLOCK), 3: np.flatnonzero(rng.random(BLOCK) < 0.5), 9: np.array([0, BLOCK - 1])}
    held = BoundarySet(low.items())
    everything = np.concatenate([key * BLOCK + x for key, x in low.items()])
    assert len(held) == len(everything)
    for k in [0, 1, BLOCK, BLOCK + 1, len(held) - 1, *rng.integers(0, len(held), 300)]:
        assert held.select(int(k)) == everything[int(k)]
    for k in (-1, len(held)):
        with pytest.raises(IndexError):
            held.select(k)


@pytest.mark.parametrize("text", ["", "a", "\n", "a\n", "a\nb", "\n\n\nx", "é\n日本\n" * 30_000, "\n" * 70_000, "x" * BLOCK, "x" * (BLOCK - 1) + "\n"])
def test_line_ends(text):
    lines = [x.encode() for x in re.findall(r"[^\n]*\n|[^\n]+", text)]
    ends = line_ends(text.encode())
    assert len(ends) == len(lines)
    at = np.cumsum([len(x) for x in lines]) - 1
    for k in {0, len(lines) // 2, len(lines) - 1} if lines else ():
        assert ends.select(k) == at[k]


def slow(doc_id, text, options):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"{options.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    marks = (options.prefix, options.suffix, options.middle)
    if not text or any(x in text for x in marks) or h[2] % 100 >= options.rate:
        return n, "plain", None, None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:low], lines[low:high], lines[high:]))
    if h[3] % 100 < options.spm:
        return n, "spm", p, m, s, marks[1] + s + marks[0] + p + marks[2] + m
    return n, "psm", p, m, s, marks[0] + p + marks[1] + s + marks[2] + m


@pytest.mark.parametrize("options", [Infill(), Infill("a.b", "\\E[", "|", rate=60, spm=20, seed=3)])
def test_against_plain_python(spark, odd_docs, options):
    more = [(i, "".join(f"line {j} é\n" * (j % 3) for j in range(i % 17)) + "end" * (i % 2)) for i in range(100, 200)]
    more += [(300, "has <S> inside\nand more"), (301, "x|y\nz"), (302, "ab\n" * 40_000), (303, "\n")]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.withColumn("output", F.lit(1)).withColumn("own", F.lit("mine")).withColumn("t", F.lit(2))
    out = with_infill(docs, options)
    assert set(out.columns) == {*docs.columns, "n", "form", "prefix", "middle", "suffix"}
    rows = out.withColumn("back", restored(F.col("output"), F.col("form"), options)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        expected = slow(r["doc_id"], r["text"], options)
        assert tuple(r[x] for x in ("n", "form", "prefix", "middle", "suffix", "output")) == expected
        assert r["back"] == restored_text(r["output"], r["form"], options) == (r["text"] or "")
        assert (r["own"], r["t"]) == ("mine", 2)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_no_rows(no_docs):
    assert with_infill(no_docs).count() == 0


def test_query_sees_whole_texts_once(spark, sf_dir):
    from shelfpulse.llm import LLM_QUERIES

    plan = LLM_QUERIES["op12_infill"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
