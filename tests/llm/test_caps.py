import numpy as np
import pytest

from shelfpulse.llm import caps as caps_module
from shelfpulse.llm.caps import FILTERS, Caps, near_vectors, rotations

ROWS = "vec_id long, embedding array<float>, label int, key string, n_links string"


def brute_force(vectors, least=0.95):
    x = np.array([v for _, v in vectors], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    ids = [i for i, _ in vectors]
    root = np.arange(len(ids))
    for _ in range(len(ids)):
        new = np.array([min([root[i], *root[linked[i]]]) for i in range(len(ids))])
        if (new == root).all():
            break
        root = new
    return {i: (int(linked[k].sum()), ids[root[k]]) for k, i in enumerate(ids)}


def test_clusters_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(30, 64))
    x = [centers[i % 30] + rng.normal(size=64) * rng.choice([0.05, 0.12, 0.17, 0.3]) for i in range(600)]
    x += [x[0]] * 30 + [centers[3] * 2.5, centers[3] * 1e-20, centers[3] * 1e18]
    vectors = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0, "k", "n") for i, v in vectors], ROWS).repartition(5)
    expected = brute_force(vectors)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(df).collect()}
    assert got == expected
    assert max(n for n, _ in expected.values()) > 30


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    given = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]),
        (10, [1.0, 0.1]), (10, [1.0, 0.1]), (11, [-1.0, 0.0]), (12, [5.0]), (13, [7.0]), (14, None),
    ]
    df = spark.createDataFrame([(i, v, 0, "k", "n") for i, v in given], ROWS)
    rows = near_vectors(df).collect()
    assert len(rows) == len(given)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)
    alone = [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 11, 14, None)]
    assert got == sorted(
        [*alone, (1, 4, 1), (2, 4, 1), (None, 4, 1), (10, 4, 1), (10, 4, 1), (12, 1, 12), (13, 1, 12)],
        key=str,
    )
    assert near_vectors(df.limit(0)).count() == 0


def test_decoding_lists_all_filters_that_a_vector_exceeds():
    caps = Caps(16, 32)
    x = np.random.default_rng(1).normal(size=(20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for vector, found in zip(x, caps.decode(x), strict=True):
        expected = []
        for r, (turn, (first, second)) in enumerate(zip(caps.turns, caps.books, strict=True)):
            y = vector @ turn
            sums = (first @ y[:32])[:, None] + (second @ y[32:])[None, :]
            expected += [(r * 32 + i) * 32 + j for i, j in np.argwhere(sums >= caps.least)]
        assert found.tolist() == sorted(expected)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.normal(size=(1500, 64)))
    z = rng.normal(size=(1500, 64))
    z = unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.95 * x + (1 - 0.95**2) ** 0.5 * z
    caps = Caps(64, 32)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(caps.decode(x), caps.decode(y), strict=True)]
    assert np.mean(met) >= 0.997


@pytest.mark.parametrize("codewords", [128, 512, 2048])
def test_recall_at_the_threshold_holds_as_codebooks_grow(codewords):
    rng = np.random.default_rng(3)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.normal(size=(1500, 64)))
    z = rng.normal(size=(1500, 64))
    z = unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.95 * x + (1 - 0.95**2) ** 0.5 * z
    turns = rotations(64, codewords, 0.95)
    caps = Caps(64, codewords, turns)
    found = [caps.decode(x), caps.decode(y)]
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(*found, strict=True)]
    assert np.mean(met) >= 0.998
    each = np.mean([len(f) for own in found for f in own]) / turns
    assert abs(each - FILTERS) < 0.1 * FILTERS


def test_links_of_a_table_with_large_codebooks(spark, monkeypatch):
    monkeypatch.setattr(caps_module, "_codewords", lambda vectors: 2048)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 64))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.3])
    vectors = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0, "k", "n") for i, v in vectors], ROWS)
    expected = brute_force(vectors)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(df).collect()}
    assert got == expected and sum(n for n, _ in expected.values()) > 100
