"""Benchmark decontamination by pigeonhole edit matching.

A test item may differ from its copy in a document by an error budget of k edits. Of k + 1
pieces of the item at least one is then copied unchanged, so every copy is found at exact hits
of pieces. One automaton finds all pieces of all items in one pass over a text, and the places
where hits say an item may lie are verified with Myers' bit-parallel edit distance.
Short items are ordinary phrases under edits: if asked for, they are
found without a budget, and only between word boundaries.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship
from shelfpulse.scratch import stage

#: Edits allowed for each character of an item.
ERROR_RATE = 0.08
#: Items of fewer characters are found without edits, as whole words, and only if asked for.
LEAST_CHARS = 32
#: Characters of items that are searched for at once.
BLOCK_CHARS = 4_000_000


def plain(text: str) -> str:
    """Lower case, white space as single spaces."""
    return " ".join(text.lower().split())


class Matcher:
    """Finds a block of items in texts."""

    def __init__(
        self, items: list[tuple], rate: float = ERROR_RATE, least_chars: int = LEAST_CHARS
    ):
        self.items = [(item_id, plain(text)) for item_id, text in items]
        self.items = [x for x in self.items if x[1]]
        self.least_chars = least_chars
        self.budgets = [
            int(len(text) * rate) if len(text) >= least_chars else 0 for _, text in self.items
        ]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, text) in enumerate(self.items):
            for begin, end in pieces(len(text), self.budgets[number]):
                places[text[begin:end]].append((number, end))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str) -> list[tuple]:
        """(item_id, distance, budget, end) of each item in a text: its best place, the first
        of equal ones, as the end in the plain text."""
        if self.empty or not text:
            return []
        text = plain(text)
        begins: dict[int, set[int]] = defaultdict(set)
        short: dict[int, int] = {}
        for at, where in self.automaton.iter(text):
            for number, end in where:
                item = self.items[number][1]
                if len(item) >= self.least_chars:
                    begins[number].add(at + 1 - end)
                elif number not in short and _apart(text, at + 1 - end, at + 1):
                    short[number] = at + 1
        out = [(self.items[number][0], 0, 0, end) for number, end in short.items()]
        for number, found in begins.items():
            item_id, item = self.items[number]
            budget, best = self.budgets[number], None
            for low, high in _spans(sorted(found), budget):
                first = max(0, low - budget)
                distance, end = nearest(item, text[first : high + len(item) + budget])
                if distance <= budget and (best is None or distance < best[0]):
                    best = (distance, first + end)
            if best:
                out.append((item_id, best[0], budget, best[1]))
        return out


def _apart(text: str, begin: int, end: int) -> bool:
    """Whether no word goes on across the begin or the end of a part of a text."""
    within = lambda at: 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()
    return not within(begin) and not within(end)


def pieces(size: int, budget: int) -> list[tuple[int, int]]:
    """Begins and ends of budget + 1 pieces of nearly equal length."""
    n = budget + 1
    return [(i * size // n, (i + 1) * size // n) for i in range(n)]


def _spans(begins: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Likely begins that lie close together, as one span each."""
    low = high = begins[0]
    for x in begins[1:]:
        if x - high > 2 * budget + 1:
            yield low, high
            low = x
        high = x
    yield low, high


def nearest(item: str, text: str) -> tuple[int, int]:
    """The least edit distance of an item to any part of a text, and where that part ends.

    Myers' algorithm: the differences of a column of the distance matrix are bits of two
    numbers, and a character of the text takes a few operations on them.
    """
    masks: dict[str, int] = {}
    for i, letter in enumerate(item):
        masks[letter] = masks.get(letter, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, distance = full, 0, len(item)
    best, end = distance, 0
    for at, letter in enumerate(text, 1):
        same = masks.get(letter, 0)
        vertical = same | down
        diagonal = (((same & up) + up) ^ up) | same
        rises = (down | ~(diagonal | up)) & full
        falls = up & diagonal
        if rises & top:
            distance += 1
        elif falls & top:
            distance -= 1
        rises = rises << 1 & full
        falls = falls << 1 & full
        up = (falls | ~(vertical | rises)) & full
        down = rises & vertical
        if distance < best:
            best, end = distance, at
    return best, end


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    least_chars: int = LEAST_CHARS,
    block_chars: int = BLOCK_CHARS,
    short: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, distance, budget and end_at for each item found in a document.

    Both sides are compared in lower case with white space as single spaces. An item is
    found if some part of the text lies within ``rate`` edits for each of its characters;
    the row tells the least distance and where that part ends. Items are read in blocks of
    bounded size, each one pass over the texts; whole texts are searched.

    Null and empty texts hold no item. Items shorter than ``least_chars`` are searched for
    with ``short`` only: without edits, where neither end lies within a word. Items that are
    null or blank are not searched for. Repeated items and documents each give their rows; null ids stay.
    Empty tables give no row. Other columns of both tables are not read.
    """
    ship(docs.sparkSession)
    out = _search(docs.limit(0), [], rate, least_chars, id_col, text_col)
    for block, held in enumerate(_blocks(benchmark, 1 if short else least_chars, block_chars)):
        found = _search(docs, held, rate, least_chars, id_col, text_col)
        out = out.unionByName(found) if block else found
    return out


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    least_chars: int = LEAST_CHARS,
    block_chars: int = BLOCK_CHARS,
    short: bool = False,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns.

    Items are found as in ``contaminated``. Rows are judged where they are, by their text,
    so nothing is shuffled and rows without an id or with a repeated one are no special
    case. Null and empty texts stay.
    """
    ship(docs.sparkSession)
    for held in _blocks(benchmark, 1 if short else least_chars, block_chars):
        leaks = _judge(docs.sparkSession.sparkContext.broadcast(held), rate, least_chars)
        docs = docs.where(~leaks(F.col(text_col).cast("string")))
    return docs


def _judge(given, rate: float, least_chars: int):
    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(given.value, rate, least_chars)
        for texts in batches:
            yield pd.Series([bool(x) and bool(matcher.find(x)) for x in texts], dtype=bool)

    return leaks


def _blocks(benchmark: DataFrame, least_chars: int, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars``, a proven bound for what tasks are given."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("t")
    ).where(F.length("t") >= least_chars)
    items = stage(items, "benchmark-items")
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("t", "item_id"), F.lit(blocks)) == block)
        held = [(row["item_id"], row["t"]) for row in mine.collect()]
        yield [x for x in held if len(plain(x[1])) >= least_chars]


def _search(
    docs: DataFrame, items: list[tuple], rate: float, least_chars: int, id_col: str, text_col: str
):
    given = docs.sparkSession.sparkContext.broadcast(items)

    def matched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(given.value, rate, least_chars)
        for frame in frames:
            rows = [
                (doc_id, *hit)
                for doc_id, text in zip(frame["doc_id"].tolist(), frame["t"].tolist(), strict=True)
                for hit in matcher.find(text)
            ]
            if rows:
                out = pd.DataFrame(rows, columns=FIELDS)
                yield out.astype({"item_id": "Int64"})

    sent = docs.select(
        F.col(id_col).cast("string").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"),
    )
    schema = "doc_id string, item_id long, distance int, budget int, end_at long"
    return sent.mapInPandas(matched, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


FIELDS = "doc_id item_id distance budget end_at".split()
