"""The registered queries and the pipeline."""

import re
from pathlib import Path

import pytest
from oracle import connect, differences

import corpus_pipeline
from shelfpulse.llm import LLM_ORACLES, LLM_QUERIES
from shelfpulse.scratch import scratch_path

ROOT = Path(corpus_pipeline.__file__).parent


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    problem = differences(LLM_QUERIES[name](spark, sf_dir), connection, LLM_ORACLES[name])
    assert problem is None, problem


def test_all_are_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert "pipeline" in names


def test_nothing_else_imports_the_package():
    outside = [p for p in (ROOT / "shelfpulse").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]
    assert all("shelfpulse.llm" not in p.read_text() for p in outside)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name != "shard_documents":
            assert docs.columns == corpus_pipeline.COLUMNS
            assert all(r == given[r["doc_id"]] for r in docs.collect())

    lettered = {i for i, r in given.items() if any(c.isalpha() for c in r["text"] or "")}
    assert set(kept["language_id"]) <= lettered
    assert len(kept["language_id"]) >= 0.99 * len(lettered)

    sets = {}
    for i in kept["language_id"]:
        w = words(given[i]["text"])
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))
    stays = sorted(kept["minhash_dedup"])
    assert len(stays) == len(set(stays))
    for k, i in enumerate(stays):
        for j in stays[:k]:
            assert len(sets[i] & sets[j]) * 100 < len(sets[i] | sets[j]) * 80
    for i in set(kept["language_id"]) - set(stays):
        near = [j for j in sets if j != i and len(sets[i] & sets[j]) * 100 >= len(sets[i] | sets[j]) * 80]
        assert near

    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    gone = set(stays) - set(kept["decontaminate"])
    for i in kept["decontaminate"]:
        text = " ".join(given[i]["text"].lower().split())
        assert not any(item in text for item in items)
    assert gone

    assert set(kept["mix_sources"]) <= set(kept["decontaminate"])
    assert max(kept["mix_sources"].count(i) for i in set(kept["mix_sources"])) <= 3
    assert sorted(kept["shard_documents"]) == sorted(kept["mix_sources"])


def test_odd_rows_go_through_the_pipeline(spark, sf_dir, odd_docs, no_docs):
    for table in (odd_docs, no_docs):
        docs = table
        for name, step in corpus_pipeline.STAGES:
            path = scratch_path(spark, name)
            step(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (table is odd_docs)


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "shard", "slot"} <= set(out.columns)
    assert out.count() > 0
