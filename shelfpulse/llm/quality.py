"""Text quality by a hashed word n-gram logistic regression, learned by FTRL updates.

A text is split into words: runs of letters, of digits, or of one other sign. Each word has a
hash of its bytes and a shape (kind, case, a class of its length, whether it repeats the word
before). One to three neighbouring words or shapes make a feature, hashed into a fixed number of
buckets. The value of a feature is the root of its share in the text's features, so long and
short texts have vectors of one length. Weights are learned by follow-the-regularised-leader
updates, and a score is the logistic function of a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship
from shelfpulse.llm.words import mix, numbers

BITS = 18
BUCKETS = 1 << BITS
#: The bound of the training sample: documents of each label, characters of each document.
DOCS_PER_LABEL, SAMPLE_CHARS = 2_000, 4_096
ALPHA, BETA, L1, L2, EPOCHS, SEED = 0.5, 1.0, 0.002, 0.002, 6, 1
THRESHOLD = 0.7
#: Bytes whose features are made together.
SLICE = 1 << 20

SPACE, LETTER, DIGIT, SIGN = 0, 1, 2, 3
#: Shapes: kind, case and length class of letters; length class of digits; sign and length class.
LENGTHS = 5


def _kinds() -> np.ndarray:
    kinds = np.full(256, SIGN, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = SPACE
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[ord("A") : ord("Z") + 1] = kinds[ord("a") : ord("z") + 1] = kinds[128:] = LETTER
    return kinds


_KINDS = _kinds()
#: Neighbouring bytes of one class are one word: letters, digits, or equal signs.
_CLASSES = np.where(_KINDS == SIGN, np.arange(256) + 4, _KINDS).astype(np.int16)
_UPPER = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_LOWER = np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))


def _cut(text: bytes) -> Iterator[bytes]:
    """A text in slices that end at white space; a longer run without any is cut."""
    at = 0
    while len(text) - at > SLICE:
        end = at + SLICE
        last = np.flatnonzero(_KINDS[np.frombuffer(text, np.uint8, SLICE, at)] == SPACE)
        if len(last):
            end = at + int(last[-1]) + 1
        yield text[at:end]
        at = end
    yield text[at:]


def _together(texts: Sequence[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Slices of texts put together: their texts, the bytes, and where each slice begins."""
    owners: list[int] = []
    held: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        for part in _cut(text):
            owners.append(i)
            held.append(part)
            size += len(part) + 1
            if size >= SLICE:
                yield owners, *_joined(held)
                owners, held, size = [], [], 0
    if held:
        yield owners, *_joined(held)


def _joined(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join([*held, b""]), np.uint8)
    return data, np.cumsum([0, *(len(x) + 1 for x in held)])


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes, hashes and shapes of the words of some bytes."""
    classes = _CLASSES[data]
    heads = np.flatnonzero(np.diff(classes, prepend=np.int16(-1)))
    ends = np.append(heads[1:], len(data))
    inside = classes[heads] != SPACE
    begin, end = heads[inside], ends[inside]
    if not len(begin):
        return begin, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = end - begin
    # A word's hash is the sum of its bytes' numbers times powers of an odd number.
    power = np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    owner = np.repeat(np.arange(len(begin)), size)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(begin, size) + inner
    letters = data[at]
    hashed = np.add.reduceat(numbers(256, 3)[letters] * power[inner], np.cumsum(size) - size)
    hashed = mix(hashed + size.astype(np.uint64))
    length = np.minimum(np.log2(size).astype(np.int64), LENGTHS - 1)
    edges = np.cumsum(size) - size
    uppers = np.add.reduceat(_UPPER[letters].astype(np.int64), edges)
    lowers = np.add.reduceat(_LOWER[letters].astype(np.int64), edges)
    first_upper = _UPPER[data[begin]]
    case = np.select([(lowers == 0) & (uppers > 0), first_upper & (uppers == 1), uppers > 0], [1, 2, 3], 0)
    kind = _KINDS[data[begin]].astype(np.int64)
    sign = np.where(kind == SIGN, data[begin].astype(np.int64), case)
    return begin, hashed, (kind * 256 + sign) * LENGTHS + length


def _grams(values: np.ndarray, widths: Sequence[int], salt: int) -> Iterator[tuple[int, np.ndarray]]:
    """Widths, and hashes of as many neighbouring values from each value on."""
    for width in widths:
        factors = numbers(width, salt + width)
        total = np.zeros(max(0, len(values) - width + 1), np.uint64)
        for j in range(width):
            total += (values[j : j + len(total)] + np.uint64(j)) * factors[j]
        yield width, mix(total)


def features(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the texts, buckets and values of their features, by text and bucket.

    A text without words has one feature of its own.
    """
    hashes, shapes, counts = [], [], []
    owners: list[int] = []
    for held, data, edge in _together(texts):
        begin, hashed, shape = words_of(data)
        owners += held
        counts.append(np.diff(np.searchsorted(begin, edge)))
        hashes.append(hashed)
        shapes.append(shape)
    n = len(texts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    per_text = np.zeros(n, np.int64)
    np.add.at(per_text, np.array(owners), np.concatenate(counts))
    owner = np.repeat(np.arange(n, dtype=np.int64), per_text)
    hashed, shape = np.concatenate(hashes), np.concatenate(shapes)
    again = np.append(False, (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1]))[: len(hashed)]
    shape = (shape * 2 + again).astype(np.uint64)
    keys = [np.flatnonzero(per_text == 0).astype(np.int64) << BITS]
    for values, widths, salt in ((hashed, (1, 2), 100), (shape, (1, 2, 3), 200)):
        for width, gram in _grams(values, widths, salt):
            bucket = (gram >> np.uint64(64 - BITS)).astype(np.int64)
            last = owner[width - 1 :]
            within = owner[: len(bucket)] == last
            keys.append((owner[: len(bucket)][within] << BITS) | bucket[within])
    distinct, times = np.unique(np.concatenate(keys), return_counts=True)
    text = distinct >> BITS
    total = np.bincount(text, weights=times, minlength=n)
    return text, distinct & (BUCKETS - 1), np.sqrt(times / total[text])


class Regression:
    """Logistic regression; the last weight is that of the constant."""

    def __init__(self) -> None:
        self.weights = np.zeros(BUCKETS + 1)

    def train(self, texts: Sequence[bytes], labels: np.ndarray, importance: np.ndarray) -> None:
        """FTRL-proximal updates, example by example, in a fixed random order each round.

        For each weight, z sums the gradients less what they have moved, n their squares. The
        weight follows from both: zero while z is within L1, else towards the other side.
        """
        examples = [x for at in range(0, len(texts), 100) for x in _examples(texts[at : at + 100])]
        z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        rng = np.random.default_rng(SEED)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(texts)).tolist():
                at, x = examples[i]
                w = _leader(z[at], n[at])
                p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
                g = (p - labels[i]) * importance[i] * x
                after = n[at] + g * g
                z[at] += g - (np.sqrt(after) - np.sqrt(n[at])) / ALPHA * w
                n[at] = after
        self.weights = _leader(z, n)

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        text, bucket, value = features(texts)
        dots = np.bincount(text, weights=value * self.weights[bucket], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(dots + self.weights[-1], -30, 30)))


def _examples(texts: Sequence[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and values of each text's weights, the constant among them."""
    text, bucket, value = features(texts)
    edge = np.searchsorted(text, np.arange(len(texts) + 1))
    return [
        (
            np.append(bucket[a:b], BUCKETS).astype(np.int32),
            np.append(value[a:b], 1.0).astype(np.float32),
        )
        for a, b in zip(edge[:-1], edge[1:], strict=True)
    ]


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that regularised past gradients favour."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(4)) == 2


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str
) -> Regression | None:
    """A model of labelled documents that are not held out; none without a label.

    Of each label, the ``DOCS_PER_LABEL`` documents with the smallest hashes of their ids are
    taken, of each of them ``SAMPLE_CHARS`` characters at a place that the hash decides.
    An example counts as many times as it stands for documents with its label, so that scores
    keep to the labels' shares. Only ids are shuffled before the sample is known.
    """
    # Plain names: both tables may have others of the same name.
    ids = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id")
    )
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
        .where("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
        .join(ids.distinct(), "id", "left_semi")
        .withColumn("h", F.xxhash64("id"))
    )
    counts = {row["y"]: row["count"] for row in known.groupBy("y").count().collect()}
    if not counts:
        return None
    # A few times the wanted number passes by its hash, so the ranking sees a bounded number.
    share = F.create_map(*[F.lit(x) for y, n in counts.items() for x in (y, 4 * DOCS_PER_LABEL / n)])
    unit = F.pmod("h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    few = known.where(unit < share[F.col("y")])
    chosen = reduce(
        DataFrame.unionByName,
        [few.where(F.col("y") == y).orderBy("h", "id").limit(DOCS_PER_LABEL) for y in counts],
    )
    # At most DOCS_PER_LABEL rows of each label, a proven bound.
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("t")).join(F.broadcast(chosen), "id")
    begin = F.pmod("h", F.greatest(F.lit(1), F.length("t") - SAMPLE_CHARS + 1)) + 1
    cut = texts.select("id", "y", "h", F.substring("t", begin.cast("int"), F.lit(SAMPLE_CHARS)).alias("t"))
    once = Window.partitionBy("id").orderBy("t")
    sample = (
        cut.withColumn("copy", F.row_number().over(once))
        .where("copy = 1")
        .orderBy("h", "id")
        .select("t", "y")
        .collect()
    )
    y = np.array([row["y"] for row in sample], float)
    taken = {1: max(1.0, float(y.sum())), 0: max(1.0, float(len(y) - y.sum()))}
    whole = sum(counts.values())
    importance = np.array([counts[int(v)] / taken[int(v)] * len(y) / whole for v in y])
    model = Regression()
    model.train([row["t"].encode() for row in sample], y, importance)
    return model


def with_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """All columns of ``docs`` and held_out, score and predicted; own columns of these names
    are replaced.

    score is the probability of label 1 by whole texts and nothing else, predicted is 1 from
    ``threshold`` on. Null texts count as empty; texts without words share one feature and
    so one score. Several labels of an id count by their mean (a tie is 1); null ids and null
    labels teach nothing, and of repeated rows of an id one teaches. The sample is bounded by
    ``DOCS_PER_LABEL`` and ``SAMPLE_CHARS``. Without any label all scores are 0.5; equal
    texts get equal scores; an empty table gives no row.
    """
    ship(docs.sparkSession)
    model = learn(docs, labels, id_col, text_col, label_col) or Regression()
    given = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            held = batch.tolist()
            # Arrow batches hold up to 10,000 texts; a few hundred at a time keep memory small.
            parts = [
                given.value.scores([x.encode() for x in held[at : at + 200]])
                for at in range(0, len(held), 200)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    added = ["held_out", "score", "predicted"]
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    told = docs.select(own, held_out(id_col).alias("h"), scored(text).alias("s"))
    kept = [F.col(f"own.`{c}`").alias(c) for c in docs.columns if c not in added]
    return told.select(
        *kept,
        F.col("h").alias("held_out"),
        F.col("s").alias("score"),
        (F.col("s") >= threshold).cast("int").alias("predicted"),
    )
