import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfpulse.llm.decontaminate import (
    contaminated,
    nearest,
    pieces,
    plain,
    without_contaminated,
)

ITEM = "item_id long, text string, distance int"


def table(item, text):
    """Least distance of an item to a part of a text, and its first end, cell by cell."""
    above = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (a != b)))
        above = row
    return min(above), above.index(min(above))


@settings(max_examples=300, deadline=None)
@given(st.text("abc ", min_size=1, max_size=70), st.text("abc ", max_size=90))
def test_distance(item, text):
    assert nearest(item, text) == table(item, text)


@given(st.integers(1, 500), st.integers(0, 60))
def test_pieces_cover_the_item(size, budget):
    parts = pieces(size, budget)
    assert len(parts) == budget + 1 and parts[0][0] == 0 and parts[-1][1] == size
    assert all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))


def brute_force(docs, items, rate=0.08, least=32):
    out = []
    for doc_id, text in docs:
        for item_id, item in items:
            if item is None or len(plain(item)) < least or not text:
                continue
            item = plain(item)
            distance, end = table(item, plain(text))
            if distance <= int(len(item) * rate):
                out.append((doc_id, item_id, distance, int(len(item) * rate), end))
    return sorted(out, key=str)


def test_edited_copies_against_brute_force(spark):
    random.seed(11)
    letters = "abcdefgh  "
    text = lambda n: "".join(random.choices(letters, k=n))
    items = [(i, text(random.randint(20, 130))) for i in range(12)] + [(12, None), (13, ""), (14, " a ")]
    items.append((0, items[0][1]))
    docs = []
    for i in range(60):
        body, (_, item) = text(150), items[i % 12]
        copy = list(item)
        for _ in range(random.randint(0, len(item) // 8)):
            at = random.randrange(len(copy) + 1)
            copy[at : at + random.randint(0, 1)] = random.choice(["", "x", "y"])
        copy = "".join(copy).upper().replace(" ", "\n ") if i % 3 else "".join(copy)
        docs.append((i, body + copy + text(150) if i % 4 else copy))
    docs += [(None, items[5][1]), (70, None), (71, ""), (72, items[6][1] + text(30_000) + items[7][1])]
    left = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    right = spark.createDataFrame([(*i, 1) for i in items], ITEM)
    expected = brute_force(docs, items)
    assert len(expected) > 25
    for block in (4_000_000, 300):
        got = contaminated(left, right, block_chars=block).collect()
        assert sorted(map(tuple, got), key=str) == expected
    hit = {x[0] for x in expected}
    clean = without_contaminated(left, right, block_chars=300)
    assert clean.columns == left.columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == sorted(
        (d[0] for d in docs if d[0] not in hit), key=str
    )


def test_items_in_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    texts = [(r["doc_id"], plain(r["text"])) for r in docs.collect()]
    whole = {(d, i["item_id"]) for i in items.collect() for d, t in texts if plain(i["text"]) in t}
    assert whole <= found and len(whole) > 0


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty_tables(spark, odd_docs, no_docs, empty):
    items = spark.createDataFrame([(1, "some item that is long enough to be looked for", 1)], ITEM)
    docs = odd_docs if empty == "items" else no_docs
    items = items.limit(0) if empty == "items" else items
    assert contaminated(docs, items).count() == 0
    assert without_contaminated(docs, items).count() == docs.count()


def test_short_items_are_found_as_whole_words(spark):
    items = spark.createDataFrame(
        [(1, "The answer is 42", 1), (2, "cat", 1), (3, " ", 1), (4, "", 1), (5, None, 1), (6, "(x)", 1)], ITEM
    )
    docs = spark.createDataFrame(
        [(1, "so the  ANSWER is 42."), (2, "the answer is 421"), (3, "the answer was 42"), (4, "concat cats"),
         (5, "concat cat"), (6, "f(x)"), (7, None), (8, "")],
        "doc_id long, text string",
    )
    got = sorted(tuple(r) for r in contaminated(docs, items, short=True).collect())
    assert got == [(1, 1, 0, 0, 19), (5, 2, 0, 0, 10), (6, 6, 0, 0, 4)]
    clean = without_contaminated(docs, items, short=True).collect()
    assert sorted(r["doc_id"] for r in clean) == [2, 3, 4, 7, 8]
    assert contaminated(docs, items).count() == 0
