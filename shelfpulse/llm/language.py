"""Language identification by a bidirectional gated recurrent network over bytes.

Each byte is read by two recurrent layers, one from each side, and every position gets a
probability for each language; a document's probabilities are the means over its bytes. The
network is trained in numpy by backpropagation through time on a bounded sample of labelled
documents, and applied to whole texts in windows that run side by side.

The gates are piecewise linear (clipped to 0..1, the candidate to -1..1), which numpy computes
many times faster than exponentials.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship

#: Units of each direction; bytes of a window, which both directions enter with state zero.
UNITS, WINDOW = 8, 64
#: The bound of the training sample: documents of each language, characters of each.
DOCS_PER_LANGUAGE, SAMPLE_CHARS = 400, 512
#: Characters that the driver takes in all; more languages than that allows are an error.
DRIVER_CHARS = 1 << 28
#: Training steps for up to so many languages; as many again for each as many more.
STEPS, STEP_LANGUAGES, LANES, RATE, SEED = 300, 32, 256, 0.02, 1
UNKNOWN = "und"


class Network:
    """Weights, by direction d: x[d] of a byte, u[d] of the state, b[d]; o and c of the output.

    Rows of x and u are the update gate, the reset gate and the candidate.
    """

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        k, n = UNITS, len(languages)
        self.languages = languages
        self.p = {"o": rng.normal(0, 0.3, (n, 2 * k)), "c": np.zeros((n, 1))}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (3 * k, 256))
            self.p["x" + d][: 2 * k] += 0.5
            self.p["u" + d] = rng.normal(0, 0.3 / k**0.5, (3 * k, k))
            self.p["r" + d] = np.zeros((k, 1))
        self.p = {name: x.astype(np.float32) for name, x in self.p.items()}

    def states(self, data: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States after each byte in the order of reading; data is bytes by time and lane."""
        k, lanes = UNITS, data.shape[1]
        x, u, r = self.p["x" + d], self.p["u" + d], self.p["r" + d]
        h = np.zeros((k, lanes), np.float32)
        out = np.empty((len(data), k, lanes), np.float32)
        fed, pushed = np.empty((3 * k, lanes), np.float32), np.empty((3 * k, lanes), np.float32)
        times = range(len(data)) if d == "f" else range(len(data) - 1, -1, -1)
        for t in times:
            np.take(x, data[t], axis=1, out=fed, mode="clip")
            np.matmul(u, h, out=pushed)
            if keep is not None:
                keep.append((t, h.copy(), pushed[2 * k :] + r))
            gates = fed[: 2 * k]
            gates += pushed[: 2 * k]
            np.clip(gates, 0, 1, out=gates)
            inner = pushed[2 * k :]
            inner += r
            inner *= gates[k:]
            inner += fed[2 * k :]
            np.clip(inner, -1, 1, out=inner)
            if keep is not None:
                keep[-1] += (gates.copy(), inner.copy())
            inner -= h
            inner *= gates[:k]
            np.add(h, inner, out=out[t])
            h = out[t]
        return out

    def probabilities(self, data: np.ndarray, forward=None, backward=None) -> np.ndarray:
        """Probabilities by time, language and lane."""
        k = UNITS
        forward = self.states(data, "f") if forward is None else forward
        backward = self.states(data, "b") if backward is None else backward
        out = np.matmul(self.p["o"][:, :k], forward)
        out += np.matmul(self.p["o"][:, k:], backward)
        out += self.p["c"]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def gradients(self, data: np.ndarray, used: np.ndarray, label: np.ndarray):
        """Backpropagation through time of the mean cross-entropy of the used positions."""
        k = UNITS
        kept: dict[str, list] = {"f": [], "b": []}
        states = {d: self.states(data, d, kept[d]) for d in "fb"}
        p = self.probabilities(data, states["f"], states["b"])
        loss = -np.log(p[:, label, np.arange(len(label))] + 1e-9)[used].mean()
        p[:, label, np.arange(len(label))] -= 1
        p *= used[:, None, :] / np.float32(used.sum())
        grads = {name: np.zeros_like(x) for name, x in self.p.items()}
        grads["c"][:, 0] = p.sum(axis=(0, 2))
        for i, d in enumerate("fb"):
            side = slice(i * k, (i + 1) * k)
            grads["o"][:, side] = np.einsum("tnl,tkl->nk", p, states[d])
            into = np.matmul(self.p["o"][:, side].T, p)
            u, later = self.p["u" + d], np.zeros((k, data.shape[1]), np.float32)
            fed = np.empty((*data.shape, 3 * k), np.float32)
            for t, before, pushed, gates, candidate in reversed(kept[d]):
                dh = into[t] + later
                z, r = gates[:k], gates[k:]
                dc = dh * z * (np.abs(candidate) < 1)
                dz = dh * (candidate - before) * ((z > 0) & (z < 1))
                dr = dc * pushed * ((r > 0) & (r < 1))
                dx = np.concatenate([dz, dr, dc])
                grads["r" + d] += (dc * r).sum(axis=1, keepdims=True)
                du = np.concatenate([dz, dr, dc * r])
                grads["u" + d] += du @ before.T
                fed[t] = dx.T
                later = dh * (1 - z) + u.T @ du
            order = np.argsort(data, axis=None, kind="stable")
            values, heads = np.unique(data.ravel()[order], return_index=True)
            by_byte = np.add.reduceat(fed.reshape(-1, 3 * k)[order], heads, axis=0)
            grads["x" + d][:, values] = by_byte.T
        return loss, grads

    def train(self, texts: list[bytes], labels: np.ndarray, seed: int = SEED) -> float:
        """Adam on random windows, languages drawn alike; returns the last mean loss."""
        rng = np.random.default_rng(seed)
        by_label = [np.flatnonzero(labels == n) for n in range(len(self.languages))]
        first = {name: np.zeros_like(x) for name, x in self.p.items()}
        second = {name: np.zeros_like(x) for name, x in self.p.items()}
        recent: list[float] = []
        steps = STEPS * -(-len(self.languages) // STEP_LANGUAGES)
        for step in range(1, steps + 1):
            label = rng.integers(0, len(self.languages), LANES)
            chosen = [by_label[n][rng.integers(0, len(by_label[n]))] for n in label]
            data = np.zeros((WINDOW, LANES), np.uint8)
            used = np.zeros((WINDOW, LANES), bool)
            for lane, i in enumerate(chosen):
                text = texts[i]
                at = int(rng.integers(0, max(1, len(text) - WINDOW // 2)))
                part = np.frombuffer(text[at : at + WINDOW], np.uint8)
                data[: len(part), lane], used[: len(part), lane] = part, True
            loss, grads = self.gradients(data, used, label)
            recent = [*recent[-19:], float(loss)]
            norm = sum(float((g**2).sum()) for g in grads.values()) ** 0.5
            rate = RATE * min(1.0, 4 * (1 - step / (steps + 1))) / max(1.0, norm)
            for name, g in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                self.p[name] -= rate * m / (np.sqrt(v) + 1e-6)
        return float(np.mean(recent))

    def label_positions(self, texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, first byte, probabilities by byte and language) of each window, whole texts."""
        text = begin = 0
        for owner, sizes, data in _windows(texts):
            p = self.probabilities(data)
            for lane, (i, size) in enumerate(zip(owner.tolist(), sizes.tolist(), strict=True)):
                begin = begin if i == text else 0
                text = i
                yield i, begin, p[:size, :, lane]
                begin += size

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over the bytes of each text; none where a text is empty."""
        total = np.zeros((len(texts), len(self.languages)))
        for owner, sizes, data in _windows(texts):
            p = self.probabilities(data)
            short = np.flatnonzero(sizes < WINDOW)
            for lane in short:
                p[sizes[lane] :, :, lane] = 0
            np.add.at(total, owner, p.sum(axis=0).T)
        length = np.array([len(x) for x in texts], float)
        return total / np.maximum(length, 1)[:, None]


#: Windows that run side by side.
TOGETHER = 4096


def _windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of all texts: their texts, their lengths, and bytes by time and lane."""
    owner, sizes, parts, lanes = [], [], [], 0
    for i, text in enumerate(texts):
        for begin in range(0, len(text), WINDOW * TOGETHER):
            part = text[begin : begin + WINDOW * TOGETHER]
            full, rest = divmod(len(part), WINDOW)
            n = full + (rest > 0)
            owner.append(np.full(n, i))
            size = np.full(n, WINDOW)
            if rest:
                size[-1] = rest
            sizes.append(size)
            parts.append(part + b"\0" * (n * WINDOW - len(part)))
            lanes += n
            if lanes >= TOGETHER:
                yield _lanes(owner, sizes, parts)
                owner, sizes, parts, lanes = [], [], [], 0
    if lanes:
        yield _lanes(owner, sizes, parts)


def _lanes(owner: list, sizes: list, parts: list):
    data = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, WINDOW)
    return np.concatenate(owner), np.concatenate(sizes), np.ascontiguousarray(data.T)


def _id_text(id_col: str):
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(_id_text(id_col)), F.lit(4)) == 2


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> Network | None:
    """A network from labelled documents that are not held out, or none if there are none.

    Of each language the documents with the smallest hashes are taken, and of each of them a
    part at a place that the hash decides. Every labelled language is learned; more of them
    than the driver has room for are refused, not dropped.
    """
    text = F.col(text_col)
    labelled = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & text.rlike(r"\p{L}"))
    # Copies of a text get hashes of their own, so that no text can fill the sample.
    hashed = labelled.select(
        F.col(lang_col).cast("string").alias("lang"),
        text.alias("t"),
        F.xxhash64(text, F.col(id_col)).alias("h"),
    )
    most = DRIVER_CHARS // (DOCS_PER_LANGUAGE * SAMPLE_CHARS)
    counts = labelled.groupBy(F.col(lang_col).cast("string").alias("lang")).count()
    common = counts.limit(most + 1).collect()
    if not common:
        return None
    if len(common) > most:
        raise ValueError(f"more than {most} languages are labelled; raise DRIVER_CHARS")
    # A few times the wanted number passes by its hash, so that however many documents a
    # language has, the ranking sees a bounded number of them.
    share = F.create_map(
        *[F.lit(x) for row in common for x in (row["lang"], 4 * DOCS_PER_LANGUAGE / row["count"])]
    )
    unit = F.pmod("h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    hashed = hashed.where(unit < share[F.col("lang")])
    begin = F.pmod("h", F.greatest(F.lit(1), F.length("t") - SAMPLE_CHARS + 1)) + 1
    cut = hashed.select("lang", "h", F.substring("t", begin.cast("int"), F.lit(SAMPLE_CHARS)).alias("t"))
    by_hash = Window.partitionBy("lang").orderBy("h", "t")
    sample = (
        cut.withColumn("rank", F.row_number().over(by_hash))
        .where(F.col("rank") <= DOCS_PER_LANGUAGE)
        .orderBy("rank", "lang", "t")
        .select("lang", "t")
        .collect()
    )
    languages = sorted({row["lang"] for row in sample})
    network = Network(languages)
    labels = np.array([languages.index(row["lang"]) for row in sample])
    if len(languages) > 1:
        network.train([row["t"].encode() for row in sample], labels)
    return network


def with_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """All columns of ``docs`` and held_out, lang_pred and score; own columns of these names
    are replaced.

    lang_pred is the language with the largest mean probability over all bytes of the text
    (of equal ones the first by code point), score that probability. Texts that are null or
    without a letter are ``und`` with score 0, and so is every text if no document is
    labelled. Every labelled language is learned, from a sample bounded by
    ``DOCS_PER_LANGUAGE`` and ``SAMPLE_CHARS``; more languages than ``DRIVER_CHARS`` has room
    for raise an error. Only texts are read for predictions. Repeated rows get equal
    answers; an empty table gives no row.
    """
    ship(docs.sparkSession)
    network = learn(docs, id_col, text_col, lang_col)
    given = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        model = given.value
        # Arrow batches hold up to 10,000 texts; a few hundred at a time keep memory small.
        out: list[tuple[str, float]] = []
        texts = texts.tolist()
        for at in range(0, len(texts), 500):
            part = [x.encode() if x else b"" for x in texts[at : at + 500]]
            p = model.pooled(part)
            best = p.argmax(axis=1)
            out += [
                (model.languages[n], min(1.0, float(row[n]))) if text else (UNKNOWN, 0.0)
                for n, row, text in zip(best, p, part, strict=True)
            ]
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    text = F.col(text_col)
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if network is None:
        said = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        # An unlettered text goes in as null and comes back unknown.
        said = predicted(F.when(lettered, text))
    added = ["held_out", "lang_pred", "score"]
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    told = docs.select(own.alias("own"), held_out(id_col).alias("held_out"), said.alias("said"))
    kept = [F.col(f"own.`{c}`").alias(c) for c in docs.columns if c not in added]
    return told.select(*kept, "held_out", "said.lang_pred", "said.score")


#: A text whose best language has a smaller mean probability is in none that was learned.
LEAST_SCORE = 0.3


def in_known_language(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, with their columns only.

    Texts that are null or have no letter go, and those with a score below ``least_score``.
    If no row is labelled, no language is known and no row stays.
    """
    names = docs.columns
    told = with_language(docs)
    keep = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
    return told.where(keep).select(*names)
