from collections import defaultdict

from pyspark.sql import functions as F

from shelfpulse.llm import common
from shelfpulse.llm.common import numbered
from shelfpulse.llm.mixing import mix, mixed
from shelfpulse.scratch import stage


def test_taken_words_meet_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    taken, sizes, target, largest = defaultdict(int), {}, {}, defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        sizes[r["source"]], target[r["source"]] = r["source_size"], r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    total = sum(sizes.values())
    assert abs(sum(target.values()) - min(total, 3 * total)) < 1e-6 * total
    for source in target:
        assert target[source] <= 3 * sizes[source]
        assert abs(taken[source] - target[source]) <= largest[source] / 2 + 1
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mix(docs).collect()), key=str)


def test_excess_is_shared_again(spark):
    rows = [(i, "w " * 10, "small") for i in range(2)] + [
        (i + 10, "w " * 10, s) for i in range(100) for s in ("big", "large")
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {r["source"]: r["target"] for r in mix(docs).collect()}
    # big weighs 1, large 2, small 3 of 2,020 words; small stops at 60, the rest is 1,960.
    assert target["small"] == 60.0
    assert abs(target["big"] - 1960 / 3) < 1e-6 and abs(target["large"] - 3920 / 3) < 1e-6


def test_odd_rows(odd_docs, no_docs):
    rows = mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert {r["source"] for r in rows} == {"a", "b", "c", None}
    assert mix(no_docs).count() == 0 and mixed(no_docs).count() == 0


def test_rows_repeat_as_planned(odd_docs):
    planned = sum(r["copies"] for r in mix(odd_docs).collect())
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == planned


def test_larger_documents_have_larger_odds(spark):
    """Of a source that gives some of its words, large documents are sampled more often."""
    rows = [(i, "w " * (4 if i % 2 else 64), "b" if i < 2000 else "a") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [r for r in mix(docs, weights=(1, 3)).collect() if r["source"] == "a"]
    assert 0 < sum(r["taken"] for r in taken) < 0.6 * sum(r["size"] for r in taken)
    rate = {n: sum(r["copies"] for r in taken if r["size"] == n) / 1000 for n in (4, 64)}
    # A half of the words is open; roots of 4 and 64 over the mean of 34 are 0.34 and 1.37.
    assert 0.1 < rate[4] < 0.45 and 0.45 < rate[64] < 0.7


def test_any_column_names_and_reruns(spark, odd_docs):
    clash = "copies m_id m_repeat repeat digest own doc_ids p_rows copy piece__ rows t_source u".split()
    docs = odd_docs.withColumns({c: odd_docs["size"] for c in clash})
    key = lambda df: sorted(map(str, df.collect()))
    assert mixed(docs).columns == docs.columns
    assert key(mixed(docs)) == key(mixed(docs.repartition(7)))
    assert mix(docs).count() == docs.count()


def test_a_third_of_rows_without_id_is_no_single_task(spark):
    """Equal rows are drawn in pieces, others are told apart by what they hold."""
    n = 60_000
    hot = spark.range(n).selectExpr("CAST(NULL AS LONG) AS doc_id", "'one two' AS text", "'a' AS source")
    rest = spark.range(2 * n).selectExpr("id AS doc_id", "'three four five' AS text", "concat('s', id % 3) AS source")
    docs = hot.unionByName(rest)
    out = mix(docs)
    assert out.count() == 3 * n
    sizes = numbered(stage(hot.groupBy("source").count(), "hot"), "count", F.lit(1).cast("long"), "nr")
    assert sizes.agg(F.count("*"), F.countDistinct("nr"), F.max("nr")).first() == (n, n, n)
    planned = out.agg(F.sum("copies")).first()[0]
    assert mixed(docs).count() == planned


def test_pieces_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(common, "TASK_COPIES", 20_000)
    rows = stage(spark.createDataFrame([("x", 200_000), ("y", 1), ("z", 4096)], "k string, n long"), "hot")
    out = numbered(rows, "n", F.lit(5).cast("long"), "nr")
    per_task = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert per_task[0] < 80_000 and per_task[1] > 4
    assert out.where("k = 'x'").agg(F.min("nr"), F.max("nr"), F.countDistinct("nr")).first() == (5, 200_004, 200_000)
