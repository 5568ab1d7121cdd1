"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction, and a vector passes all filters whose inner product with it
exceeds a threshold: the filter's cap of the sphere. Directions are random product codes.
After a random rotation a vector is two halves, each half has a codebook of random unit
vectors, and every pair of codewords is a filter, so that B + B inner products decide over
B x B filters. Decoding lists a first codeword only if the best second one can still exceed
the threshold. Several rotations make misses independent; the larger the codebooks, the more
often one rotation misses a pair, so their number follows from a simulation of the threshold.

Vectors that share a filter are compared in blocks, in double precision where it matters. A
pair that shares several filters counts in the first of them only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.blocks import in_blocks
from shelfpulse.llm.common import ship
from shelfpulse.llm.components import components
from shelfpulse.scratch import stage

#: Least rotations, and filters of each that a vector exceeds on average.
ROTATIONS, FILTERS = 10, 4
#: Of pairs at the least cosine so many share no filter, at most; closer pairs miss far less.
MISSED = 1 / 2000
#: Pairs and rotations that tell how often one rotation misses a pair.
TRIAL_PAIRS, TRIALS = 500, 8
#: Bits of a filter's number in a group's; the dimension is above them.
NUMBER_BITS = 40
#: Vectors that a filter holds on average, at most; sets the size of the codebooks.
PER_FILTER = 256
#: Vectors on one side of a block.
SIDE = 1024
LEAST_DIMS = 64
SEED = 20


class Caps:
    """The filters for vectors of one dimension."""

    def __init__(self, dims: int, codewords: int, turns: int = ROTATIONS):
        rng = np.random.default_rng([SEED, dims, codewords])
        unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
        self.codewords = codewords
        # Short vectors are turned into a space of more dimensions, in which inner products
        # with random directions spread alike whatever the vector.
        space = _space(dims)
        self.half = space // 2
        self.turns = [
            np.linalg.qr(rng.normal(size=(space, space)))[0][:dims] for _ in range(turns)
        ]
        self.books = [
            [unit(rng.normal(size=(codewords, self.half))) for _ in range(2)]
            for _ in range(turns)
        ]
        self.least = _threshold(space, min(0.5, FILTERS / codewords**2))

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector all filters it exceeds, as sorted numbers."""
        n, size = len(units), self.codewords
        owners, found = [], []
        for r, (turn, (first, second)) in enumerate(zip(self.turns, self.books, strict=True)):
            x = units @ turn
            a = x[:, : self.half] @ first.T
            b = x[:, self.half :] @ second.T
            row, i = np.nonzero(a + b.max(axis=1, keepdims=True) >= self.least)
            for part in np.array_split(np.arange(len(row)), max(1, len(row) * size // (1 << 22))):
                at, j = np.nonzero(b[row[part]] >= (self.least - a[row[part], i[part]])[:, None])
                owners.append(row[part][at])
                found.append((r * size + i[part][at]) * size + j)
        owner = np.concatenate(owners)
        order = np.lexsort((np.concatenate(found), owner))
        filters = np.concatenate(found)[order]
        return np.split(filters, np.searchsorted(owner[order], np.arange(1, n)))


def _space(dims: int) -> int:
    return max(dims + dims % 2, LEAST_DIMS)


@lru_cache(maxsize=256)
def _threshold(space: int, share: float) -> float:
    """What a unit vector's inner product with a random filter exceeds with probability ``share``.

    The product is sqrt(s) x + sqrt(1 - s) y, where s is the squared length of the first half
    and x and y are components of random unit vectors of half the dimension. Its tail is
    thinner than a normal one, so it is summed from the densities of s and x.
    """
    half = space // 2
    reach = min(1.0, 12 / half**0.5)
    x = np.linspace(-reach, reach, 4001)
    density = np.maximum(1 - x * x, 0) ** ((half - 3) / 2)
    density /= density.sum()
    # From the far end, so that small probabilities keep their digits.
    above = np.cumsum(density[::-1])[::-1] - density / 2
    spread = 4 / (half + 1) ** 0.5
    s = 0.5 + np.linspace(-min(0.5, spread), min(0.5, spread), 103)[1:-1]
    weight = (4 * s * (1 - s)) ** (half / 2 - 1)
    weight /= weight.sum()
    low, high = 0.0, 2**0.5
    for _ in range(40):
        least = (low + high) / 2
        rest = (least - np.sqrt(s)[:, None] * x) / np.sqrt(1 - s)[:, None]
        tail = weight @ (np.interp(rest, x, above, left=1.0, right=0.0) @ density)
        low, high = (least, high) if tail > share else (low, least)
    return low


@lru_cache(maxsize=4096)
def rotations(dims: int, codewords: int, least: float) -> int:
    """Rotations after which at most ``MISSED`` of the pairs at cosine ``least`` share no filter.

    Rotations miss a pair independently, so their number follows from how often one does.
    That is simulated, and two standard errors are added to it.
    """
    caps = Caps(dims, codewords, TRIALS)
    rng = np.random.default_rng([SEED + 1, dims, codewords])
    x = _lengthless(rng.normal(size=(TRIAL_PAIRS, dims)))
    z = rng.normal(size=(TRIAL_PAIRS, dims))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    least = min(least, 1.0)
    y = x if dims == 1 or least == 1 else least * x + (1 - least**2) ** 0.5 * _lengthless(z)
    met = np.zeros((TRIALS, TRIAL_PAIRS))
    for pair, (a, b) in enumerate(zip(caps.decode(x), caps.decode(y), strict=True)):
        met[np.intersect1d(a, b) // codewords**2, pair] = 1
    each = 1 - met.mean(axis=1)
    missed = each.mean() + 2 * (each.std() + 0.5 / TRIAL_PAIRS**0.5) / TRIALS**0.5
    if missed >= 0.99:
        raise ValueError(f"{codewords} codewords do not find pairs at cosine {least} in {dims} dimensions")
    return max(ROTATIONS, math.ceil(math.log(MISSED) / math.log(missed)))


def _lengthless(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codewords(vectors: int) -> int:
    """A power of two with about ``PER_FILTER`` vectors for each filter."""
    size = 16
    while size < 8192 and size * size * PER_FILTER < vectors * FILTERS:
        size *= 2
    return size


def near_vectors(
    vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row.

    Rows are linked if their vectors have a cosine of at least ``least`` in double
    precision. Equal vectors are one class and count as often as they occur. n_links counts
    the other rows linked directly, component_id is the smallest vec_id that links lead to.
    Vectors that are null, empty, zero, or hold null or non-finite components are linked
    with nothing, as are vectors of different length. Null ids are kept; they never name a
    component that has another id. Repeated rows are equal vectors. An empty table gives no
    row. Other columns are not read.
    """
    ship(vectors.sparkSession)
    kind = vectors.schema[vec_col].dataType.simpleString()
    # Floats travel as floats: half the bytes, and the same values in double precision.
    vec = F.col(vec_col).cast(kind if kind in ("array<float>", "array<double>") else "array<double>")
    finite = F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(F.coalesce(finite, F.lit(False)), vec).alias("vec"),
    )
    rows = rows.withColumn("key", F.unhex(F.md5(F.col("vec").cast("string"))))
    ids = stage(rows.select("vec_id", "key"), "caps-rows")
    classes = stage(
        rows.where("key is not null")
        .groupBy("key")
        .agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies")),
        "caps-classes",
    )
    found = stage(_compare(classes, least), "caps-found")
    roots = components(found.where("b is not null").select("a", "b").distinct())
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    ones = ids.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    )
    labels = stage(
        ones.join(roots, ones["key"] == roots["node"], "left")
        .join(counts, F.col("key") == F.col("a"), "left")
        .select(
            "key",
            "first_id",
            F.coalesce("root", "key").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "caps-labels",
    )
    # From files, so that the join may deal the labels of a very large component anew.
    named = stage(labels.groupBy("root").agg(F.min("first_id").alias("least_id")), "caps-least")
    named = stage(labels.join(named, "root").select("key", "n_links", "least_id"), "caps-named")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("least_id"))
    return ids.join(named, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _compare(classes: DataFrame, least: float) -> DataFrame:
    """Counts of links (a, null, links) and links that join components (a, b, null)."""
    codewords = _codewords(classes.count())
    lengths = classes.select(F.size("vec").alias("dims")).distinct().collect()
    turns = {row["dims"]: rotations(row["dims"], codewords, least) for row in lengths}
    # Numbers of filters are short where they fit: they travel with every vector.
    short = max(turns.values(), default=0) * codewords**2 < 1 << 31
    number = np.int32 if short else np.int64

    def decoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        caps: dict[int, Caps] = {}
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                for dims, own in part.groupby(part["vec"].map(len)):
                    if dims not in caps:
                        caps[dims] = Caps(dims, codewords, turns[dims])
                    filters = caps[dims].decode(_units(own["vec"]))
                    yield pd.DataFrame(
                        {
                            "key": own["key"].to_numpy(),
                            "vec": own["vec"].to_numpy(),
                            "copies": own["copies"].to_numpy(),
                            "filters": [f.astype(number) for f in filters],
                            "groups": [f + (dims << NUMBER_BITS) for f in filters],
                        }
                    )

    vec = classes.schema["vec"].dataType.simpleString()
    told = stage(
        classes.mapInPandas(
            decoded,
            f"key binary, vec {vec}, copies long, "
            f"filters array<{'int' if short else 'long'}>, groups array<long>",
        ),
        "caps-decoded",
    )
    met = told.select("key", F.explode("groups").alias("group"))
    sizes = stage(
        met.groupBy("group")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("group", F.ceil(F.col("n") / SIDE).cast("int").alias("sides")),
        "caps-groups",
    )
    members = stage(in_blocks(met.join(sizes, "group"), "group", "key"), "caps-members")
    full = members.join(told.drop("groups"), "key")

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        return _block(frame, least)

    return full.groupBy("group", "low", "high").applyInPandas(
        compared, "a binary, b binary, links long"
    )


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    # Scaling by the largest component first keeps squares of very large or small ones.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _block(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """What one block of one filter adds: its linked pairs that share no filter before it."""
    group, low, high = (frame[c].iat[0] for c in ("group", "low", "high"))
    frame = frame.sort_values("key", kind="stable")
    keys, side = frame["key"].tolist(), frame["side"].to_numpy()
    copies, filters = frame["copies"].to_numpy(), frame["filters"].tolist()
    units = _units(frame["vec"])
    links = np.zeros(len(keys), np.int64)
    parent = np.arange(len(keys))
    out: list[tuple] = []

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
    near = units[left] @ units[right].T >= least
    p, q = np.nonzero(np.triu(near, 1) if low == high else near)
    if len(p):
        p, q = left[p], right[q]
        mine = ~_shared_before(filters, p, q, int(group) & ((1 << NUMBER_BITS) - 1))
        p, q = p[mine], q[mine]
        np.add.at(links, p, copies[q])
        np.add.at(links, q, copies[p])
        for i, j in zip(p.tolist(), q.tolist(), strict=True):
            a, b = top(i), top(j)
            if a != b:
                parent[a] = b
                out.append((keys[i], keys[j], None))
    out += [(keys[i], None, int(links[i])) for i in np.flatnonzero(links)]
    return pd.DataFrame(out, columns=["a", "b", "links"]).astype({"links": "Int64"})


def _shared_before(filters: list, p: np.ndarray, q: np.ndarray, number: int) -> np.ndarray:
    """Which pairs share a filter below ``number``: a product of two membership tables."""
    rows, where = np.unique(np.concatenate([p, q]), return_inverse=True)
    before = [filters[i][: np.searchsorted(filters[i], number)] for i in rows]
    flat = np.concatenate(before)
    values, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = np.cumsum(times > 1) - 1
    holds = times[column] > 1
    table = np.zeros((len(rows), int((times > 1).sum())), np.float32)
    owner = np.repeat(np.arange(len(rows)), [len(x) for x in before])
    table[owner[holds], often[column[holds]]] = 1
    shared = table @ table.T > 0
    return shared[where[: len(p)], where[len(p) :]]
