import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfpulse.llm import quality
from shelfpulse.llm.quality import Regression, features, with_quality, words_of


def slow_words(text):
    """(bytes, shape parts) of each word, byte by byte."""
    kind = {**{b: "sign" for b in range(128)}, **{b: "letter" for b in range(128, 256)}}
    kind.update({b: "space" for b in b"\t\n\x0b\x0c\r "})
    kind.update({b: "letter" for b in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    kind.update({b: "digit" for b in b"0123456789"})
    out = []
    for b in text:
        same = out and out[-1][0] == kind[b] and (kind[b] != "sign" or out[-1][1][-1] == b)
        if same:
            out[-1][1].append(b)
        else:
            out.append((kind[b], bytearray([b])))
    return [bytes(w) for k, w in out if k != "space"], [k for k, w in out if k != "space"]


def test_words():
    text = "The THE the12 a--b!!! ***é日x iOS é É The The\x00\x00\n..".encode()
    begin, hashes, shapes = words_of(np.frombuffer(text, np.uint8))
    words, _ = slow_words(text)
    assert [text[b : b + len(w)] for b, w in zip(begin, words, strict=True)] == words
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert (hashes[i] == hashes[j]) == (a == b)
    of = dict(zip(words, shapes.tolist(), strict=True))
    assert len({of[w] for w in (b"The", b"THE", b"the", b"12", b"!!!", b"--", b"iOS")}) == 7


def test_features_do_not_depend_on_the_company(monkeypatch):
    texts = [b"", b"one", b"  \n", "zwölf Wörter!! und ** mehr ".encode() * 300, b"a b a b a b", b"b a", b"a", b"x" * 60]
    whole = features(texts)
    for limit in (1 << 20, 64, 700):
        monkeypatch.setattr(quality, "SLICE", limit)
        together = features(texts)
        assert all(np.array_equal(a, b) for a, b in zip(whole, together, strict=True))
        for i, text in enumerate(texts):
            _, bucket, value = features([text])
            mine = whole[0] == i
            assert np.array_equal(bucket, whole[1][mine]) and np.allclose(value, whole[2][mine])
            assert math.isclose(float((value**2).sum()), 1)
    assert np.array_equal(whole[1][whole[0] == 0], whole[1][whole[0] == 2])


def slow_train(texts, labels, importance):
    """The updates one weight at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        sign = math.copysign(1, z[i])
        return -(z[i] - sign * quality.L1) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    rng = np.random.default_rng(quality.SEED)
    for _ in range(quality.EPOCHS):
        for i in rng.permutation(len(texts)).tolist():
            _, bucket, value = features([texts[i]])
            x = [*zip(bucket.tolist(), value.tolist(), strict=True), (quality.BUCKETS, 1.0)]
            p = 1 / (1 + math.exp(-sum(weight(b) * v for b, v in x)))
            for b, v, w in [(b, v, weight(b)) for b, v in x]:
                g = (p - labels[i]) * importance[i] * v
                old = n.get(b, 0.0)
                z[b] = z.get(b, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / quality.ALPHA * w
                n[b] = old + g * g
    return {b: weight(b) for b in z}


def test_updates_match_plain_loops():
    texts = [f"good words number {i} here".encode() for i in range(8)] + [b"BAD!! WORDS!! %d" % i for i in range(5)] + [b""]
    labels = np.array([1.0] * 8 + [0.0] * 6)
    importance = np.linspace(0.5, 1.5, 14)
    model = Regression()
    model.train(texts, labels, importance)
    expected = slow_train(texts, labels, importance)
    for bucket, w in expected.items():
        assert math.isclose(model.weights[bucket], w, abs_tol=1e-5)
    assert np.count_nonzero(model.weights) == sum(w != 0 for w in expected.values())
    for text, score in zip(texts, model.scores(texts), strict=True):
        _, bucket, value = features([text])
        dot = sum(expected.get(b, 0.0) * v for b, v in zip(bucket.tolist(), value.tolist(), strict=True))
        assert math.isclose(score, 1 / (1 + math.exp(-dot - expected[quality.BUCKETS])), abs_tol=1e-5)


def test_held_out_ranking(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{base}/{x}.parquet") for x in ("documents", "labels"))
    out = with_quality(docs, labels).select("doc_id", "held_out", "score", "predicted")
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    told = [(r["quality"], rows[r["doc_id"]]) for r in labels.collect() if r["doc_id"] in rows]
    unseen = [(y, r) for y, r in told if r["held_out"]]
    good = np.array([r["score"] for y, r in unseen if y == 1])
    bad = np.array([r["score"] for y, r in unseen if y == 0])
    assert np.mean(good[:, None] > bad) > 0.97
    assert np.mean([r["predicted"] == y for y, r in unseen]) > 0.93


def test_held_out_labels_teach_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    flipped = labels.withColumn(
        "quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = (
        {r["doc_id"]: r["score"] for r in with_quality(docs, x).collect()} for x in (labels, flipped)
    )
    assert one == two


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, "a"), (1, 1, "b"), (3, 0, "c"), (5, 0, "d"), (7, 1, "e"), (8, None, "f"), (None, 1, "g"), (99, 0, "h"), (11, 0, "i"), (11, 1, "j")],
        "doc_id long, quality int, text string",
    )
    docs = odd_docs.withColumn("y", F.lit(1)).withColumn("h", F.lit(2)).withColumn("own", F.lit(3))
    out = with_quality(docs, labels)
    assert set(out.columns) == {*docs.columns, "held_out", "predicted"}
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    scores = {}
    for r in rows:
        assert 0 <= r["score"] <= 1 and (r["y"], r["h"], r["own"]) == (1, 2, 3)
        text = r["text"] if (r["text"] or "").strip() else ""
        assert scores.setdefault(text, r["score"]) == r["score"]
    assert with_quality(no_docs, labels).count() == 0
    untaught = with_quality(odd_docs, labels.where("false")).collect()
    assert {r["score"] for r in untaught} == {0.5} and {r["predicted"] for r in untaught} == {0}


@pytest.mark.parametrize("copies", [4_000])
def test_a_hot_id_teaches_once(spark, copies):
    rows = [(1, f"copy {i}") for i in range(copies)] + [(i, "plain text") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert with_quality(docs, labels).count() == len(rows)
