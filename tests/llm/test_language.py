import zlib

import numpy as np

from shelfpulse.llm import language
from shelfpulse.llm.language import Network, in_known_language, with_language


def slow_probabilities(network, data):
    """The network in double precision, one unit and lane after the other."""
    k, p = language.UNITS, {n: x.astype(float) for n, x in network.p.items()}
    states = {}
    for d in "fb":
        h, out = np.zeros((k, data.shape[1])), [None] * len(data)
        for t in range(len(data)) if d == "f" else reversed(range(len(data))):
            fed, pushed = p["x" + d][:, data[t]], p["u" + d] @ h
            gates = np.clip(fed[: 2 * k] + pushed[: 2 * k], 0, 1)
            inner = np.clip(fed[2 * k :] + gates[k:] * (pushed[2 * k :] + p["r" + d]), -1, 1)
            h = out[t] = h + gates[:k] * (inner - h)
        states[d] = np.array(out)
    scores = p["o"][:, :k] @ states["f"] + p["o"][:, k:] @ states["b"] + p["c"]
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    network = Network(["a", "b", "c"], seed=5)
    data = rng.integers(32, 127, (9, 6)).astype(np.uint8)
    used, label = rng.random((9, 6)) < 0.8, rng.integers(0, 3, 6)
    assert np.allclose(network.probabilities(data), slow_probabilities(network, data), atol=1e-5)
    _, grads = network.gradients(data, used, label)
    network.p = {n: x.astype(float) for n, x in network.p.items()}

    def loss():
        p = slow_probabilities(network, data)
        return -np.log(p[:, label, np.arange(6)] + 1e-9)[used].mean()

    for name, weights in network.p.items():
        for _ in range(4):
            at = tuple(int(rng.integers(0, n)) for n in weights.shape)
            if name[0] == "x":
                at = (at[0], int(rng.choice(data.ravel())))
            kept = weights[at]
            weights[at] = kept + 1e-5
            high = loss()
            weights[at] = kept - 1e-5
            low = loss()
            weights[at] = kept
            assert abs((high - low) / 2e-5 - grads[name][at]) < 1e-4


def test_every_position_of_long_texts_is_labelled(monkeypatch):
    monkeypatch.setattr(language, "TOGETHER", 4)
    network = Network(["a", "b"], seed=2)
    texts = [b"", b"x", bytes(range(32, 127)) * 30, b"y" * 64]
    total = np.zeros((4, 2))
    seen = [0] * 4
    for i, begin, p in network.label_positions(texts):
        assert begin == seen[i]
        seen[i] += len(p)
        total[i] += p.sum(axis=0)
    assert seen == [len(x) for x in texts]
    pooled = network.pooled(texts)
    assert np.allclose(pooled, total / np.maximum(1, [[n] for n in seen]), atol=1e-5)
    assert pooled[0].tolist() == [0, 0] and np.allclose(pooled[1:].sum(axis=1), 1, atol=1e-4)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    rows = with_language(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    unseen = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([r["lang"] == r["lang_pred"] for r in unseen]) > 0.97


def test_odd_rows(odd_docs, no_docs):
    odd_docs = odd_docs.withColumns({"said__": odd_docs["size"], "own": odd_docs["size"], "said": odd_docs["size"]})
    out = with_language(odd_docs)
    assert set(out.columns) == {*odd_docs.columns, "held_out", "lang_pred"}
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered)
        assert lettered or r["score"] == 0
    assert with_language(no_docs).count() == 0 and in_known_language(no_docs).count() == 0
    kept = in_known_language(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({4, 5, 6, 10})


def test_nothing_to_learn_from(odd_docs):
    rows = with_language(odd_docs.withColumn("lang", odd_docs["lang"].substr(9, 0)).where("false"))
    assert rows.count() == 0
    from pyspark.sql import functions as F

    unlabelled = with_language(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_more_languages_than_a_few_dozen(spark, monkeypatch):
    monkeypatch.setattr(language, "STEP_LANGUAGES", 70)
    rows = [
        (1000 * n + i, chr(0x4E00 + 40 * n) * 3 + f" {chr(0x4E00 + 40 * n + i % 3)} " * 5, f"l{n:02d}")
        for n in range(70)
        for i in range(6)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language.learn(docs, "doc_id", "text", "lang")
    assert network.languages == sorted({r[2] for r in rows})
    told = with_language(docs).collect()
    assert {r["lang_pred"] for r in told} <= set(network.languages)
    assert np.mean([r["lang"] == r["lang_pred"] for r in told]) > 0.5
    # The last one by number of documents and by name is known as well.
    assert any(r["lang_pred"] == "l69" for r in told)
    monkeypatch.setattr(language, "DRIVER_CHARS", 60 * 400 * 512)
    import pytest

    with pytest.raises(ValueError, match="60 languages"):
        language.learn(docs, "doc_id", "text", "lang")
