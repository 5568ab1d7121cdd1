import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfpulse.llm.components import components
from shelfpulse.llm.minhash import BANDS, near_duplicates, signatures, without_near_duplicates
from shelfpulse.llm.words import shingle_sets, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOW))
    n = max(1, len(words) - width + 1) if words else 0
    return frozenset(tuple(words[i : i + width]) for i in range(n))


def brute_force(rows, width, least):
    """The smallest id that links lead to, for each row, from all pairs."""
    sets = [shingles(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * 100 >= len(sets[i] | sets[j]) * least:
                root[top(i)] = top(j)
    least_id = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least_id[top(i)] = min(doc_id, least_id.get(top(i), doc_id))
    return [
        (doc_id, len(s), least_id.get(top(i)) if s else doc_id)
        for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def same(df, rows, width, least):
    got = [tuple(r)[:3] for r in near_duplicates(df, width, least).collect()]
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(got, key=key) == sorted(brute_force(rows, width, least), key=key)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé \t\n\x0b\x00日"), max_size=30), max_size=8), st.integers(1, 4))
def test_shingles_are_those_of_words(texts, width):
    found = {}
    for held, sets in shingle_sets([t.encode() for t in texts], width):
        for i, s in zip(held, sets, strict=True):
            found[i] = s
    expected = [shingles(t, width) for t in texts]
    assert [len(found[i]) for i in range(len(texts))] == [len(s) for s in expected]
    for i, a in enumerate(expected):
        for j, b in enumerate(expected):
            assert len(np.intersect1d(found[i], found[j])) == len(a & b)


def test_long_texts_are_cut_between_words(monkeypatch):
    import shelfpulse.llm.words as words

    random.seed(1)
    text = " ".join("x" * random.randint(1, 90) + str(i) for i in range(3000)).encode()
    whole = next(word_hashes([text]))[1]
    monkeypatch.setattr(words, "SLICE", 64)
    assert np.array_equal(next(word_hashes([text]))[1], whole)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    b = np.concatenate([a[:3800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    same_bands = [
        (x == y).mean() for x, y in [signatures([np.unique(a), np.unique(b)], 400)]
    ]
    assert abs(same_bands[0] - (3800 / 4200) ** 4) < 0.07
    assert BANDS >= 20


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    same(odd_docs, rows, 3, 85)
    assert near_duplicates(no_docs, 3, 85).count() == 0
    assert without_near_duplicates(no_docs).count() == 0
    out = without_near_duplicates(odd_docs, 3, 85)
    assert out.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert ids == [1, 10, 11, 3, 4, 4, 5, 6, 7, 9, None] or ids.count(1) == 1
    assert ids.count(None) == 1 and 2 not in ids and 8 not in ids


def test_a_large_group_of_near_copies(spark):
    """Copies around the threshold of each other: pivots do not settle them all."""
    random.seed(7)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(random.randint(0, 4)):
            words[random.randrange(60)] = f"n{random.randrange(50)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"z{i}-{j}" for j in range(30))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    same(df, rows, 3, 85)


@pytest.mark.parametrize("width, least", [(5, 80), (3, 85)])
def test_documents(spark, sf_dir, width, least):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    same(docs, rows, width, least)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    links += [(205, 203), (203, 204), (204, 205), (205, 203), (300, 300)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(roots) == len(found)
    assert roots == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {
        203: 203, 204: 203, 205: 203
    }
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_any_column_names_and_reruns(odd_docs):
    clash = "k_id k_hash own id hash whole copy id__ hash__ copy__ root set_id".split()
    docs = odd_docs.withColumns({c: odd_docs["size"] for c in clash})
    docs = docs.unionByName(docs.where("doc_id = 1").selectExpr(*[c if c != "lang" else "'zz' AS lang" for c in docs.columns]))
    key = lambda df: sorted(map(str, df.collect()))
    out = without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert key(out) == key(without_near_duplicates(docs.repartition(5)))
