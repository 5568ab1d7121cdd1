"""Ranked lexical search: short lists are summed first, long lists are skipped through.

Documents become postings of the searched terms only, in tables that Spark spreads. Each task
indexes its documents in blocks. For a query and a block, the short lists are read term at a time
into summed accumulators, which then act as one list with one upper bound. That list and the long
ones are read together in the order of documents, window by window: lists whose bounds together
cannot reach the k-th best score so far are only looked up for candidates of the others, and
windows whose bounds cannot are skipped. The best k of all tasks are merged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship
from shelfpulse.scratch import stage

#: A term: a run of ASCII letters and digits and of all characters beyond ASCII.
_TERM = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(128, 256)]
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in set(_TERM) else 0x20 for b in range(256)
)
#: Bytes of a text that are split at once.
SLICE = 4 << 20
#: Characters of the queries that are searched for in one pass over the documents.
BLOCK_CHARS = 4_000_000
#: A block of an index has about so many documents or postings.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1 << 22
#: Documents of a window. Lists with at most a posting for every so many documents are short.
WINDOW, SHORT_SHARE = 4096, 32
#: Slices in which the tasks' results of one query are merged first.
SALTS = 16

#: Scores in whole numbers, part of the definition of the ranking.
UNIT, SCALE, K1_TENTHS = 1_000_000_000, 1_000, 12


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists, slice by slice."""
    at = 0
    while at < len(text):
        part = text[at : at + SLICE].translate(_FOLD)
        if at + SLICE < len(text):
            # A term on the edge goes to the next slice, unless it fills this one.
            end = part.rfind(b" ") + 1
            while not end and at + len(part) < len(text):
                more = text[at + len(part) : at + len(part) + SLICE].translate(_FOLD)
                end = len(part) + more.find(b" ") + 1 if b" " in more else 0
                part += more
            part = part[:end] if end else part
        yield part.split()
        at += len(part)


@dataclass(frozen=True)
class Query:
    """Terms of a query by number, and how often each occurs in it."""

    item: object
    terms: tuple[int, ...]
    times: tuple[int, ...]


class Best:
    """The k best (score, document) of a query: largest score first, then smallest document."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple] = []

    @property
    def least(self) -> int:
        """A document needs this score at least."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, docs: Sequence, numbers: np.ndarray) -> None:
        """Scores of documents, given by their places in ``docs`` in ascending order."""
        keep = np.flatnonzero(scores >= self.least)
        if len(keep) > self.k:
            order = np.lexsort((numbers[keep], -scores[keep]))[: self.k]
            keep = keep[order]
        rows = [(-int(scores[i]), docs[int(numbers[i])]) for i in keep]
        ranked = sorted([*self.rows, *rows], key=lambda r: (r[0], r[1] is None, r[1]))
        self.rows = ranked[: self.k]


class Block:
    """Postings of some documents by term: documents ascending, with their impacts.

    ``impact`` is what a posting adds to a score for each unit of its term's weight.
    """

    def __init__(self, ids: Sequence, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, term))
        self.ids = ids
        self.doc, self.impact = doc[order], impact[order]
        ordered = term[order]
        terms, heads = np.unique(ordered, return_index=True)
        ends = np.append(heads, len(ordered))[1:]
        spans = zip(heads.tolist(), ends.tolist(), strict=True)
        self.place = dict(zip(terms.tolist(), spans, strict=True))
        self.windows = -(-len(ids) // WINDOW)
        self._bounds: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def bounds(self, term: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Of a list: its largest impact, the largest in each window, where windows begin."""
        if term not in self._bounds:
            a, b = self.place[term]
            self._bounds[term] = _bounds(self.doc[a:b], self.impact[a:b], self.windows)
        return self._bounds[term]

    def search(self, query: Query, weights: np.ndarray, best: Best) -> None:
        """Add the documents of this block that belong to the best of a query."""
        held = [
            (self.place[t], t, int(weights[t]) * times)
            for t, times in zip(query.terms, query.times, strict=True)
            if t in self.place and weights[t] > 0
        ]
        limit = len(self.ids) // SHORT_SHARE
        lists = [
            List(self.doc[a:b], self.impact[a:b], w, *self.bounds(t))
            for (a, b), t, w in held
            if b - a > limit
        ]
        short = [(self.doc[a:b], self.impact[a:b] * w) for (a, b), t, w in held if b - a <= limit]
        if short:
            lists.append(self._accumulated(short))
        if lists:
            self._together(lists, best)

    def _accumulated(self, short: list[tuple[np.ndarray, np.ndarray]]) -> List:
        """Term at a time: the sums of the short lists as one list."""
        docs = np.concatenate([d for d, _ in short])
        places, at = np.unique(docs, return_inverse=True)
        sums = np.zeros(len(places), np.int64)
        np.add.at(sums, at, np.concatenate([x for _, x in short]))
        return List(places, sums, 1, *_bounds(places, sums, self.windows))

    def _together(self, lists: list[List], best: Best) -> None:
        """Document at a time over all lists, a window of documents after the other."""
        lists.sort(key=lambda x: x.bound)
        reach = np.cumsum([x.bound for x in lists])
        # In each window the lists together reach at most the sum of their bounds there.
        ceiling = sum(x.in_windows * x.weight for x in lists)
        for window in np.flatnonzero(ceiling >= best.least).tolist():
            least = best.least
            if ceiling[window] < least:
                continue
            # The first lists cannot lift a document over the least score without the others.
            first = int(np.searchsorted(reach, least, side="left"))
            base, size = window * WINDOW, min(WINDOW, len(self.ids) - window * WINDOW)
            sums = np.zeros(size, np.int64)
            for x in lists[first:]:
                a, b = x.heads[window], x.heads[window + 1]
                sums[x.docs[a:b] - base] += x.impacts[a:b] * x.weight
            open_ = reach[first - 1] if first else 0
            candidates = np.flatnonzero(sums + open_ >= max(least, open_ + 1))
            for i in range(first - 1, -1, -1):
                if not len(candidates):
                    break
                x = lists[i]
                sums[candidates] += x.lookup(window, candidates + base)
                open_ = reach[i - 1] if i else 0
                candidates = candidates[sums[candidates] + open_ >= least]
            if len(candidates):
                best.add(sums[candidates], self.ids, candidates + base)


@dataclass(frozen=True)
class List:
    """Documents with impacts, a weight, and upper bounds as a whole and by window."""

    docs: np.ndarray
    impacts: np.ndarray
    weight: int
    most: int
    in_windows: np.ndarray
    heads: np.ndarray

    @property
    def bound(self) -> int:
        return self.most * self.weight

    def lookup(self, window: int, docs: np.ndarray) -> np.ndarray:
        """What this list adds to each of some documents of a window."""
        a, b = self.heads[window], self.heads[window + 1]
        if a == b:
            return np.zeros(len(docs), np.int64)
        at = np.minimum(np.searchsorted(self.docs[a:b], docs), b - a - 1) + a
        return np.where(self.docs[at] == docs, self.impacts[at] * self.weight, 0)


def _bounds(docs: np.ndarray, impacts: np.ndarray, windows: int) -> tuple[int, np.ndarray, np.ndarray]:
    heads = np.searchsorted(docs, np.arange(windows + 1) * WINDOW)
    most = np.zeros(windows, np.int64)
    some = np.flatnonzero(np.diff(heads))
    if len(some):
        most[some] = np.maximum.reduceat(impacts, heads[some])
    return int(most.max(initial=0)), most, heads


def _postings(docs: DataFrame, vocabulary: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """id, n (all terms with repeats) and the searched terms with their times, by document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.value
        for batch in batches:
            n, terms, times, edge = [], [], [], [0]
            for text in batch.column("t"):
                data = text.as_py()
                counts: Counter = Counter()
                length = 0
                for part in terms_of(data):
                    length += len(part)
                    counts.update(map(numbers.get, part))
                counts.pop(None, None)
                n.append(length)
                terms += counts.keys()
                times += counts.values()
                edge.append(len(terms))
            offsets = pa.array(edge, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                ],
                names=["id", "n", "terms", "times"],
            )

    sent = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("t"),
    )
    kind = sent.schema["id"].dataType.simpleString()
    return sent.mapInArrow(read, f"id {kind}, n long, terms array<int>, times array<long>")


def _best_of_tasks(postings: DataFrame, searched: Broadcast, total: int, length: int, k: int) -> DataFrame:
    """query, id and score: of each query the best k of each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = searched.value
        best = [Best(k) for _ in queries]
        kind = None
        for ids, block in _indexed(batches, total, length):
            kind = ids
            for query, mine in zip(queries, best, strict=True):
                block.search(query, weights, mine)
        if kind is None:
            return
        for at in range(0, len(queries), 1000):
            rows = [
                (at + i, doc, -less)
                for i, mine in enumerate(best[at : at + 1000])
                for less, doc in mine.rows
            ]
            query, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int32()), pa.array(doc, kind), pa.array(score, pa.int64())],
                names=["query", "id", "score"],
            )

    kind = postings.schema["id"].dataType.simpleString()
    return postings.mapInArrow(search, f"query int, id {kind}, score long")


def _indexed(
    batches: Iterator[pa.RecordBatch], total: int, length: int
) -> Iterator[tuple[pa.DataType, Block]]:
    """The documents of a task in blocks of bounded size, and the type of their ids."""
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for batch in batches:
        held.append(batch)
        docs += batch.num_rows
        postings += len(batch.column("terms").flatten())
        if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
            yield held[0].column("id").type, _block(held, total, length)
            held, docs, postings = [], 0, 0
    if docs:
        yield held[0].column("id").type, _block(held, total, length)


def _block(held: list[pa.RecordBatch], total: int, length: int) -> Block:
    """Documents are numbered in the order of their ids, null ones last."""
    table = pa.Table.from_batches(held).combine_chunks()
    ids = table.column("id").combine_chunks()
    order = pc.sort_indices(ids).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    terms = table.column("terms").combine_chunks()
    n = table.column("n").to_numpy()
    doc = np.repeat(np.arange(len(n)), pc.list_value_length(terms).to_numpy())
    times = table.column("times").combine_chunks().flatten().to_numpy()
    # Longer documents need more occurrences; a quarter of this does not depend on length.
    m = 75 + (25 * n * total) // max(1, length)
    impact = (UNIT * times) // (SCALE * times + K1_TENTHS * m[doc])
    return Block(ids.take(pa.array(order)).to_pylist(), number[doc], terms.flatten().to_numpy(), impact)


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The queries in blocks of about ``BLOCK_CHARS``, a proven bound for what tasks are given."""
    held = stage(
        items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("t")).where(
            "t IS NOT NULL"
        ),
        "search-items",
    )
    chars = held.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for block in range(blocks):
        mine = held.where(F.pmod(F.xxhash64("t", "item"), F.lit(blocks)) == block)
        yield [(row["item"], row["t"]) for row in mine.collect()]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score: the ``k`` best documents for each item.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; only
    A-Z is lower-cased. A term that is in df of the N documents with a term has the weight
    ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``; a document in which it occurs tf times
    among n terms gets ``weight * (1e9 * tf div (1000 * tf + 12 * m))`` for each time the item
    has the term, with ``m = 75 + 25 * n * N div L`` and L the terms of all documents. Only
    scores above 0 are ranked; of equal ones the smaller id is first, null ids last.

    Whole texts are read, once for each block of ``BLOCK_CHARS`` characters of items. Null and
    empty texts have no term. Repeated documents and items are ranked as rows of their own:
    equal rows of one id come with ranks of their own, an item that is there twice with a
    ranking for each row. Empty tables give no row. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    item_kind = items.schema[item_col].dataType.simpleString()
    kind = docs.schema[id_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    for block, held in enumerate(_blocks(items, item_col, item_text_col)):
        found = _search(docs, held, item_kind, k, id_col, text_col)
        out = out.unionByName(found) if block else found
    return out


def _search(
    docs: DataFrame, held: list[tuple], item_kind: str, k: int, id_col: str, text_col: str
) -> DataFrame:
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    queries = []
    for item, text in held:
        counts = Counter(t for part in terms_of(text.encode()) for t in part)
        terms = tuple(numbers.setdefault(t, len(numbers)) for t in counts)
        queries.append(Query(item, terms, tuple(counts.values())))
    vocabulary = spark.sparkContext.broadcast(numbers)
    postings = stage(_postings(docs, vocabulary, id_col, text_col), "postings")
    total, length = postings.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").count()
    # One row for each searched term at most.
    weighed = df.select(
        "term",
        F.floor(1000 * F.log((2 * F.lit(total).cast("double") + 2) / (2 * F.col("count") + 1))).alias("w"),
    ).toPandas()
    weights = np.zeros(len(numbers) + 1, np.int64)
    weights[weighed["term"].to_numpy(np.int64)] = weighed["w"].to_numpy(np.int64)
    searched = spark.sparkContext.broadcast((queries, weights))
    best = _best_of_tasks(postings, searched, total, length, k)
    order = (F.desc("score"), F.col("id").asc_nulls_last())
    salted = Window.partitionBy("query", "salt").orderBy(*order)
    merged = (
        best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        .withColumn("rank", F.row_number().over(salted))
        .where(F.col("rank") <= k)
    )
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    names = spark.createDataFrame(
        [(i, query.item) for i, query in enumerate(queries)],
        f"query int, item_id {item_kind}",
    )
    return (
        ranked.where(F.col("rank") <= k)
        .join(F.broadcast(names), "query")
        .select("item_id", "rank", F.col("id").alias("doc_id"), "score")
    )
