"""Scores of a hashed maximum-entropy language model beside a counted base.

A word's probability is that of its class after the words before it, times that of its cell in
the class, times that of the word in its cell. Class and cell come from softmaxes over sums of
weights, one row of weights for each feature of the context: the word before and the hashed pair
before (n-grams), and the two words before that (skips). Words are hashed whole into tables that
grow with the vocabulary. The frequent words of a class have cells of their own; others share
hashed cells, in which they go by their counts.

Weights are trained by distributed gradient updates: in each round a task follows the gradient
over its part of the training text, and for each row the changes of the tasks that used it are
averaged. All training text is used once. Counts cover all training text and are a table. A head
of frequent words, bounded in number, is given to every task; all other words meet their counts
in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship
from shelfpulse.llm.words import mix, numbers, word_hashes
from shelfpulse.scratch import stage

#: The end of a text, a token like a word.
END_HASH, END_SUFFIX = np.uint64(0x452821E638D01377), 0
#: Frequent words whose counts tasks hold.
HEAD = 1 << 17
#: Classes by the last two bytes of words: for frequent endings, and for hashes of the rarer ones.
SUFFIX_CLASSES, HASH_CLASSES = 22, 10
CLASSES = SUFFIX_CLASSES + HASH_CLASSES
#: Cells of a class: of its frequent words, and of hashes of the others.
OWN, HASHED = 24, 8
CELLS = OWN + HASHED
#: Two-byte endings.
SUFFIXES = 1 << 16
#: Rows of each table of weights: one for so many words of the vocabulary, at most 16 MB.
WORDS_PER_ROW, LEAST_ROWS, MOST_ROWS = 8, 1 << 12, 1 << 17
#: Words before a token that are features of their own; the pair of the first two is one more.
BEFORE = 3
#: Training: rounds, tokens of an update, step size, what a row's sum of squares starts with,
#: tokens of a task in a round.
ROUNDS, BATCH, RATE, DAMPING, TASK_TOKENS = 2, 8192, 0.15, 0.2, 4_000_000
#: Bytes of text that are worked on together, next to the weights.
HASHED_BYTES = 1 << 19
#: Uses of a row in an update that are added one by one.
FEW = 6
#: Rows of weights that are summed together.
PART_ROWS = 2048


@dataclass
class Lexicon:
    """What tasks hold of the words; hashes are sorted.

    ``log_count`` belongs to the head. Own words have a class and a cell each; other words
    have the class of their suffix and a hashed cell. ``log_cell`` is the logarithm of the
    mass of a cell: its words' counts and a half each, and a half for its unknown words.
    """

    hashes: np.ndarray
    log_count: np.ndarray
    own: np.ndarray
    own_kind: np.ndarray
    own_cell: np.ndarray
    by_suffix: np.ndarray
    log_cell: np.ndarray

    def counts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether tokens are in the head, and the logarithms of their counts."""
        known, at = _found(self.hashes, hashes)
        log_count = np.zeros(len(hashes))
        log_count[known] = self.log_count[at[known]]
        return known, log_count

    def places(self, hashes: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes and cells of tokens."""
        kind = self.by_suffix[suffixes].astype(np.int64)
        cell = hashed_cell(hashes)
        known, at = _found(self.own, hashes)
        kind[known], cell[known] = self.own_kind[at[known]], self.own_cell[at[known]]
        return kind, cell


def _found(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[at] == hashes, at


def hashed_cell(hashes: np.ndarray) -> np.ndarray:
    """The cell of a word that has none of its own."""
    return OWN + (hashes >> np.uint64(40)).astype(np.int64) % HASHED


@dataclass
class Weights:
    """Rows of the class softmax and of the cell softmax, and their constants."""

    kind: np.ndarray
    cell: np.ndarray
    kind_bias: np.ndarray
    cell_bias: np.ndarray

    def copy(self) -> Weights:
        return Weights(*(x.copy() for x in vars(self).values()))


def _with_ends(hashes: np.ndarray, offsets: np.ndarray, suffixes: np.ndarray):
    """The words of a group of texts with an end after each text, and the new offsets."""
    hashes = np.insert(hashes, offsets[1:], END_HASH)
    suffixes = np.insert(suffixes, offsets[1:], END_SUFFIX)
    return hashes, offsets + np.arange(len(offsets)), suffixes


def _features(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashes of each token's context: each of the words before it, and the pair before."""
    n = len(hashes)
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    salts = numbers(BEFORE + 1, 17)
    out = np.empty((BEFORE + 1, n), np.uint64)
    for k in range(1, BEFORE + 1):
        before = np.zeros(n, np.uint64)
        before[k:] = np.where(place[k:] >= k, hashes[: n - k] if k < n else 0, np.uint64(0))
        out[k - 1] = mix(before * salts[k - 1] + np.uint64(k))
    out[BEFORE] = mix(out[0] * salts[BEFORE] + out[1])
    return out


def _rows(features: np.ndarray, kind: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the class weights, and of the cell weights within the class."""
    last = np.uint64(rows - 1)
    inside = mix(features + (kind.astype(np.uint64) + np.uint64(1)) * numbers(1, 29)[0])
    return (features & last).astype(np.int64), (inside & last).astype(np.int64)


def _softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Probabilities of outcomes by token."""
    out = np.take(weights, rows[0], axis=0)
    for more in rows[1:]:
        out += np.take(weights, more, axis=0)
    out += bias
    np.minimum(out, 80, out=out)
    np.exp(out, out=out)
    out /= (out @ np.ones(out.shape[1], np.float32))[:, None] + np.float32(1e-30)
    return out


def _descend(weights: np.ndarray, squares: np.ndarray, uses: np.ndarray, rows: np.ndarray, error: np.ndarray) -> None:
    """A step against the gradient for all rows in use, in place."""
    flat = rows.T.ravel()
    # Sorted by the low and the high half: short integers are sorted by their digits.
    order = np.argsort((flat & 0xFFFF).astype(np.uint16), kind="stable")
    order = order.take(np.argsort((flat.take(order) >> 16).astype(np.uint16), kind="stable"))
    values = flat.take(order)
    heads = np.flatnonzero(np.diff(values, prepend=-1))
    times = np.diff(heads, append=len(flat))
    values, tokens = values.take(heads), order // len(rows)
    # Most rows are used once or a few times; a sum over long stretches is for the others.
    slope = error.take(tokens.take(heads), axis=0)
    for k in range(1, FEW):
        more = np.flatnonzero((times > k) & (times <= FEW))
        if len(more):
            slope[more] += error.take(tokens.take(heads.take(more) + k), axis=0)
    several = np.flatnonzero(times > FEW)
    if len(several):
        size = times.take(several)
        begin = np.cumsum(size) - size
        at = np.repeat(heads.take(several) - begin, size) + np.arange(int(size.sum()))
        slope[several] = np.add.reduceat(error.take(tokens.take(at), axis=0), begin, axis=0)
    square = squares.take(values)
    square += np.einsum("ij,ij->i", slope, slope) / error.shape[1]
    squares[values] = square
    uses[values] += times
    slope *= (-RATE / np.sqrt(square))[:, None]
    slope += weights.take(values, axis=0)
    weights[values] = slope


class Trainer:
    """Follows the gradient over its part of the text."""

    def __init__(self, start: Weights):
        self.start, self.own = start, start.copy()
        rows = len(start.kind)
        self.squares = [np.full(rows, DAMPING, np.float32) for _ in range(2)]
        self.uses = [np.zeros(rows, np.float32) for _ in range(2)]
        self.bias_squares = [np.float32(DAMPING), np.full((CLASSES, 1), DAMPING, np.float32)]
        self.seen = 0

    def follow(self, features: np.ndarray, kinds: np.ndarray, cells: np.ndarray) -> None:
        for at in range(0, len(kinds), BATCH):
            part = slice(at, at + BATCH)
            self._update(features[:, part], kinds[part], cells[part])

    def _update(self, features: np.ndarray, kind: np.ndarray, cell: np.ndarray) -> None:
        own, each = self.own, np.arange(len(kind))
        by_kind, by_cell = _rows(features, kind, len(own.kind))
        error = _softmax(own.kind, own.kind_bias, by_kind)
        error[each, kind] -= 1
        _descend(own.kind, self.squares[0], self.uses[0], by_kind, error)
        slope = error.sum(axis=0)
        self.bias_squares[0] += slope @ slope / CLASSES
        own.kind_bias -= RATE / np.sqrt(self.bias_squares[0]) * slope
        error = _softmax(own.cell, own.cell_bias[kind], by_cell)
        error[each, cell] -= 1
        _descend(own.cell, self.squares[1], self.uses[1], by_cell, error)
        which = np.zeros((CLASSES, len(kind)), np.float32)
        which[kind, each] = 1
        slope = which @ error
        self.bias_squares[1] += (slope * slope).sum(axis=1, keepdims=True) / CELLS
        own.cell_bias -= RATE / np.sqrt(self.bias_squares[1]) * slope
        self.seen += len(kind)

    def changes(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Table, part, rows in use, their uses and changes; the constants are table 2."""
        pairs = ((self.own.kind, self.start.kind), (self.own.cell, self.start.cell))
        for table, (own, start) in enumerate(pairs):
            for at in range(0, len(own), PART_ROWS):
                used = np.flatnonzero(self.uses[table][at : at + PART_ROWS])
                if len(used):
                    change = own[at + used] - start[at + used]
                    yield table, at // PART_ROWS, used, self.uses[table][at + used], change
        change = np.vstack(
            [self.own.kind_bias - self.start.kind_bias, self.own.cell_bias - self.start.cell_bias]
        )
        yield 2, 0, np.arange(CLASSES + 1), np.full(CLASSES + 1, self.seen, np.float32), change


def learns(id_col: str = "doc_id"):
    """Rows that the model learns from; the others are held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(5)) != 1


def _counted(texts: DataFrame) -> DataFrame:
    """hash, suffix and c of every token of the texts."""

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def merged() -> pd.DataFrame:
            hashes = np.concatenate([x[0] for x in held])
            values, first, where = np.unique(hashes, return_index=True, return_inverse=True)
            counts = np.bincount(where, np.concatenate([x[1] for x in held])).astype(np.int64)
            suffixes = np.concatenate([x[2] for x in held])[first]
            return pd.DataFrame({"hash": values.view(np.int64), "suffix": suffixes, "c": counts})

        for frame in frames:
            for _, hashes, offsets, suffixes in word_hashes(frame["t"].tolist(), HASHED_BYTES):
                hashes, _, suffixes = _with_ends(hashes, offsets, suffixes)
                values, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                held.append((values, counts, suffixes[first]))
                size += len(values)
                # Fewer rows leave the task if counts are merged as far as memory allows.
                if size > 600_000:
                    yield merged()
                    held, size = [], 0
        if held:
            yield merged()

    words = texts.select("t").mapInPandas(made, "hash long, suffix long, c long")
    return words.groupBy("hash").agg(F.first("suffix").alias("suffix"), F.sum("c").alias("c"))


def _head(counts: DataFrame) -> pd.DataFrame:
    """The most frequent words, ``HEAD`` at most, in the order of their counts.

    A histogram of the counts' logarithms tells which words are too many, so that no more
    than the head leaves the executors, however many tasks hold counts. Of the words of the
    step that does not fit whole, those with the smallest hashes are taken.
    """
    step = F.floor(F.log2("c") * 64).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"))
    steps = sorted(((r["step"], r["words"]) for r in steps.collect()), reverse=True)
    words, taken = 0, F.lit(False)
    for number, more in steps:  # some four thousand at most, as counts have 64 bits
        if words + more > HEAD:
            room = HEAD - words
            # As many as will hardly be more than there is room for.
            share = max(0.0, room - 4 * room**0.5) / more
            part = F.pmod(F.xxhash64("hash"), F.lit(1 << 30)) < int(share * (1 << 30))
            taken = (step > number) | ((step == number) & part)
            break
        words += more
        taken = step >= number
    top = counts.where(taken).select("hash", "suffix", "c").toPandas()
    return top.sort_values(["c", "hash"], ascending=[False, True], ignore_index=True)


def _classes(counts: DataFrame) -> np.ndarray:
    """The class of each suffix: the heaviest have one each, the others share."""
    by_suffix = counts.groupBy("suffix").agg(F.sum("c").alias("c"))
    heaviest = by_suffix.orderBy(F.desc("c"), "suffix").limit(SUFFIX_CLASSES).collect()
    kinds = SUFFIX_CLASSES + (mix(np.arange(SUFFIXES, dtype=np.uint64)) % np.uint64(HASH_CLASSES)).astype(np.int64)
    for kind, row in enumerate(heaviest):
        kinds[row["suffix"]] = kind
    return kinds.astype(np.uint8)


def _lexicon(counts: DataFrame) -> Lexicon:
    """The head of the counts, classes and cells."""
    top = _head(counts)
    by_suffix = _classes(counts)
    hashes = top["hash"].to_numpy(np.int64).view(np.uint64)
    kind = by_suffix[top["suffix"].to_numpy(np.int64)].astype(np.int64)
    # The place of a word among those of its class, most frequent first.
    order = np.argsort(kind, kind="stable")
    heads = np.searchsorted(kind[order], kind[order])
    place = np.empty(len(kind), np.int64)
    place[order] = np.arange(len(kind)) - heads
    own = place < OWN
    # What hashed cells would weigh with the own words in them, CLASSES * HASHED rows.
    spark = counts.sparkSession
    kinds = spark.createDataFrame(
        pd.DataFrame({"suffix": np.arange(SUFFIXES), "kind": by_suffix.astype(np.int64)}),
        "suffix long, kind int",
    )
    shifted = F.pmod(F.shiftrightunsigned("hash", 40), F.lit(HASHED)).cast("int")
    sums = (
        counts.join(F.broadcast(kinds), "suffix")
        .groupBy("kind", shifted.alias("cell"))
        .agg((F.sum("c") + 0.5 * F.count(F.lit(1))).alias("mass"))
        .toPandas()
    )
    mass = np.zeros((CLASSES, CELLS))
    mass[:, OWN:] = 0.5
    np.add.at(mass, (sums["kind"].to_numpy(int), OWN + sums["cell"].to_numpy(int)), sums["mass"].to_numpy(float))
    weight = top["c"].to_numpy(float) + 0.5
    np.add.at(mass, (kind[own], hashed_cell(hashes[own])), -weight[own])
    mass[kind[own], place[own]] = weight[own]
    sorted_head, sorted_own = np.argsort(hashes), np.argsort(hashes[own])
    return Lexicon(
        hashes[sorted_head],
        np.log10(weight)[sorted_head],
        hashes[own][sorted_own],
        kind[own][sorted_own],
        place[own][sorted_own],
        by_suffix,
        np.log10(np.maximum(mass, 1e-30)),
    )


def _start(lexicon: Lexicon, words: int) -> Weights:
    """No weights; constants by the shares of classes and cells in the text."""
    rows = LEAST_ROWS
    while rows < MOST_ROWS and rows * WORDS_PER_ROW < words:
        rows *= 2
    mass = 10.0**lexicon.log_cell
    of_class = mass.sum(axis=1)
    return Weights(
        np.zeros((rows, CLASSES), np.float32),
        np.zeros((rows, CELLS), np.float32),
        np.log(of_class / of_class.sum()).astype(np.float32),
        np.log(np.maximum(mass / of_class[:, None], 1e-12)).astype(np.float32),
    )


CHANGE = "target int, part int, salt int, rows binary, uses binary, change binary"


def _round(texts: DataFrame, lexicon: Lexicon, weights: Weights, tokens: int) -> Weights:
    """One distributed update by the changes that the tasks' parts make.

    There are as many tasks as have ``TASK_TOKENS`` each, so that what they send stays a
    fraction of the text. Changes of a row are averaged by its uses, in two steps, so that no
    task holds more than the root of all changes of a part.
    """
    given = texts.sparkSession.sparkContext.broadcast((lexicon, weights))
    tasks = max(1, tokens // TASK_TOKENS)
    spread = max(1, int(tasks**0.5))

    def trained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, start = given.value
        trainer = Trainer(start)
        for frame in frames:
            for _, hashes, offsets, suffixes in word_hashes(frame["t"].tolist(), HASHED_BYTES):
                hashes, offsets, suffixes = _with_ends(hashes, offsets, suffixes)
                trainer.follow(_features(hashes, offsets), *words.places(hashes, suffixes))
        if trainer.seen:
            salt = TaskContext.get().partitionId() % spread
            for table, part, rows, uses, change in trainer.changes():
                yield _change(table, part, salt, rows, uses, change)

    changes = texts.select("t").coalesce(tasks).mapInPandas(trained, CHANGE)
    if tasks > 1:
        changes = stage(changes, "lm-changes")
        changes = changes.groupBy("target", "part", "salt").applyInPandas(_averaged, CHANGE)
        changes = changes.groupBy("target", "part").applyInPandas(_averaged, CHANGE)
    out = weights.copy()
    for row in changes.collect():
        rows = np.frombuffer(row["rows"], np.uint16).astype(np.int64)
        change = np.frombuffer(row["change"], np.float16).astype(np.float32).reshape(len(rows), -1)
        if row["target"] == 2:
            out.kind_bias += change[0]
            out.cell_bias += change[1:]
        else:
            table = out.cell if row["target"] else out.kind
            table[rows + row["part"] * PART_ROWS] += change
    given.destroy()
    return out


def _averaged(frame: pd.DataFrame) -> pd.DataFrame:
    """The mean change of each row, each weighed by its uses."""
    total = uses = None
    for rows, times, change in zip(frame["rows"], frame["uses"], frame["change"], strict=True):
        at = np.frombuffer(rows, np.uint16)
        n = np.frombuffer(times, np.float32)
        values = np.frombuffer(change, np.float16).reshape(len(at), -1)
        if total is None:
            uses = np.zeros(PART_ROWS, np.float32)
            total = np.zeros((PART_ROWS, values.shape[1]), np.float32)
        uses[at] += n
        total[at] += n[:, None] * values
    used = np.flatnonzero(uses)
    target, part, salt = (int(frame[c].iat[0]) for c in ("target", "part", "salt"))
    return _change(target, part, salt, used, uses[used], total[used] / uses[used][:, None])


def _change(target: int, part: int, salt: int, rows, uses, change) -> pd.DataFrame:
    """A part of a change of the weights; half precision is enough for a step."""
    return pd.DataFrame(
        {
            "target": [target],
            "part": [part],
            "salt": [salt],
            "rows": [rows.astype(np.uint16).tobytes()],
            "uses": [uses.astype(np.float32).tobytes()],
            "change": [change.astype(np.float16).tobytes()],
        }
    )


def trained_model(training: DataFrame, counts: DataFrame, n: int, v: int) -> tuple[Lexicon, Weights]:
    """The words and the weights that the training texts (column t) and their counts give."""
    lexicon = _lexicon(counts)
    weights = _start(lexicon, v)
    for r in range(ROUNDS):
        turn = training.where(F.pmod(F.xxhash64("t"), F.lit(ROUNDS)) == r)
        weights = _round(turn, lexicon, weights, n // ROUNDS)
    return lexicon, weights


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score.

    Tokens are words, lower-cased in A-Z, and one end. base_score sums the logarithms (base
    10) of (c + 0.5) / (N + 0.5 (V + 1)) with the counts of the rows that ``learns`` picks;
    score is the model's logarithm of the text's probability. A word that no training text
    has is one of its class's unknown words.

    Null, empty and blank texts have the end only. Null ids count as the empty text for the
    choice of held-out rows. Repeated rows count as often as they occur. If nothing is
    learned from, base_score is 0 and classes are alike. An empty table gives no row. Other
    columns are not read.
    """
    ship(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (~learns(id_col)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"),
    )
    training = texts.where(~F.col("held_out"))
    counts = stage(_counted(training), "lm-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    lexicon, weights = trained_model(training, counts, n, v)
    told = stage(
        _applied(texts, lexicon, weights).withColumn("row", F.monotonically_increasing_id()),
        "lm-told",
    )
    base = float(np.log10(n + 0.5 * (v + 1)))
    rare = told.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("hash"), F.col("x.times").alias("times")
    )
    met = rare.join(counts.select("hash", "c"), "hash", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("rare_known"),
    )
    out = told.drop("rare", "times").join(met, "row", "left")
    logs = F.col("head_log") + F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (logs + F.col("model")).alias("score"),
    )


#: Tokens scored together.
SCORED = 16_384


def log_probabilities(
    lexicon: Lexicon, weights: Weights, hashes: np.ndarray, offsets: np.ndarray, suffixes: np.ndarray
) -> np.ndarray:
    """Logarithms (base 10) of each token's class and cell, less that of its cell's mass."""
    kind, cell = lexicon.places(hashes, suffixes)
    features = _features(hashes, offsets)
    logs = np.empty(len(kind))
    for at in range(0, len(kind), SCORED):
        part = slice(at, at + SCORED)
        each = np.arange(len(kind[part]))
        by_kind, by_cell = _rows(features[:, part], kind[part], len(weights.kind))
        p = _softmax(weights.kind, weights.kind_bias, by_kind)[each, kind[part]].astype(float)
        own = weights.cell_bias[kind[part]]
        p *= _softmax(weights.cell, own, by_cell)[each, cell[part]]
        logs[part] = np.log10(p + 1e-30)
    return logs - lexicon.log_cell[kind, cell]


def _applied(texts: DataFrame, lexicon: Lexicon, weights: Weights) -> DataFrame:
    """For each text the parts of its scores that the head decides, and its rarer words."""
    given = texts.sparkSession.sparkContext.broadcast((lexicon, weights))

    def told(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, own = given.value
        for frame in frames:
            ids, held_out = frame["doc_id"].to_numpy(object), frame["held_out"].to_numpy()
            for held, hashes, offsets, suffixes in word_hashes(frame["t"].tolist(), HASHED_BYTES):
                hashes, offsets, suffixes = _with_ends(hashes, offsets, suffixes)
                known, log_count = words.counts(hashes)
                logs = log_probabilities(words, own, hashes, offsets, suffixes)
                heads = offsets[:-1]
                rare, times = [], []
                for a, b in zip(heads, offsets[1:], strict=True):
                    values, n = np.unique(hashes[a:b][~known[a:b]], return_counts=True)
                    rare.append(values.view(np.int64))
                    times.append(n)
                yield pd.DataFrame(
                    {
                        "doc_id": ids[held],
                        "held_out": held_out[held],
                        "n_tokens": np.diff(offsets),
                        "head_known": np.add.reduceat(known.astype(np.int64), heads),
                        "head_log": np.add.reduceat(log_count, heads),
                        "model": np.add.reduceat(logs, heads),
                        "rare": rare,
                        "times": times,
                    }
                )

    sent = texts.withColumn("doc_id", F.col("doc_id").cast("string"))
    return sent.mapInPandas(
        told,
        "doc_id string, held_out boolean, n_tokens long, head_known long, head_log double, "
        "model double, rare array<long>, times array<long>",
    )
