"""Token counts by compiled finite-state transducers.

A byte-level BPE tokenizer is two machines in a row. The first cuts a text into pieces; the
second merges the bytes of a piece into tokens. Both are compiled here into deterministic
transducers whose transitions carry what they emit:

* The cutter reads classes of code points and emits piece starts. It has thirteen states, so
  the effect of a chunk is a map from states to states. The maps of all chunks are made side
  by side and composed by a parallel prefix scan; after that each chunk knows its first state.
* The merger reads bytes and emits the change of the token count, -1, 0, 1 or more. Its state
  is what a next byte can depend on: for each suffix of the read bytes that begins a token,
  the token that ends before it. Such states are finitely many; they are built when a text
  first reaches them and kept up to a bound, after which building starts over.

Many chunks advance together, a byte per step, through numpy tables.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship

# --- The cutter ------------------------------------------------------------------------
# The published pre-tokenization pattern of the tokenizer,
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# White space that \s means beyond ASCII.
WIDE_SPACE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

(SPACE, WHITE, LETTER, SHORT, R, V, L, E, NUMBER, QUOTE, OTHER, STOP) = range(12)
CLASSES = 12
(START, WORD, DIGITS, MARKS, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE,
 QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, DONE) = range(13)
STATES = 13
#: Emitted with a character: a piece starts at it, at the character before it.
HERE, BEFORE = 1, 2

_LETTERS = {LETTER, SHORT, R, V, L, E}


def _cutter_step(state: int, kind: int) -> tuple[int, int]:
    """Next state and emission of the cutter."""
    if kind == STOP:
        return START, BEFORE if state in (QUOTED_R, QUOTED_V, QUOTED_L) else 0
    if state in (QUOTED_R, QUOTED_V, QUOTED_L):
        if (state, kind) in ((QUOTED_R, E), (QUOTED_V, E), (QUOTED_L, L)):
            return DONE, 0
        # No contraction after all: the quote stands alone and a word began one back.
        after, out = _cutter_step(WORD, kind)
        return after, out | BEFORE
    if kind in (SPACE, WHITE):
        plain = kind == SPACE
        if state in (ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE):
            return (MORE_SPACE if plain else MORE_WHITE), 0
        return (ONE_SPACE if plain else ONE_WHITE), HERE
    run = WORD if kind in _LETTERS else DIGITS if kind == NUMBER else MARKS
    if state == ONE_SPACE:
        return run, 0
    if state == MORE_SPACE:
        return run, BEFORE
    if state == QUOTED:
        if kind == SHORT:
            return DONE, 0
        if kind in (R, V, L):
            return {R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[kind], 0
        if run == MARKS:
            return MARKS, 0
        return run, HERE
    if state == run:
        return run, 0
    first = QUOTED if kind == QUOTE else run
    return first, HERE | (BEFORE if state == MORE_WHITE else 0)


def _cutter_tables() -> tuple[np.ndarray, np.ndarray]:
    steps = [_cutter_step(s, k) for s in range(STATES) for k in range(CLASSES)]
    return np.array([x[0] for x in steps], np.uint8), np.array([x[1] for x in steps], np.uint8)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    kinds = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, (x for x in range(0x110000) if not 0xD800 <= x < 0xE000)))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for run in regex.finditer(pattern, everything):
            for a, b in _spans(run.start(), run.end()):
                kinds[a:b] = kind
    kinds[[9, 10, 11, 12, 13, *WIDE_SPACE]] = WHITE
    kinds[ord(" ")] = SPACE
    kinds[[ord(x) for x in "stmd"]] = SHORT
    for letter, kind in (("r", R), ("v", V), ("l", L), ("e", E), ("'", QUOTE)):
        kinds[ord(letter)] = kind
    return kinds


def _spans(a: int, b: int) -> Iterator[tuple[int, int]]:
    """Code points of positions a to b in a list of all but the surrogates."""
    gap = 0xD800
    if a < gap:
        yield a, min(b, gap)
    if b > gap:
        yield max(a, gap) + 0x800, b + 0x800


CHUNK = 128


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """For each character whether a piece starts there; ``kinds`` ends with STOP."""
    step, emit = _cutter_tables()
    n = len(kinds)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, STOP, np.uint8)
    padded[:n] = kinds
    lanes = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    # Where each state leads through each chunk.
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], chunks, axis=1)
    index = np.empty(maps.shape, np.uint8)
    for row in lanes:
        np.multiply(maps, CLASSES, out=index)
        index += row
        np.take(step, index, out=maps, mode="clip")
    # Composition of all chunks up to each, in a logarithmic number of rounds.
    reach = 1
    while reach < chunks:
        maps[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].copy(), axis=0)
        reach *= 2
    state = np.empty(chunks, np.uint8)
    state[0] = START
    state[1:] = maps[START, :-1]
    out = np.empty(lanes.shape, np.uint8)
    for row, said in zip(lanes, out, strict=True):
        where = state * CLASSES + row
        said[:] = emit[where]
        state = step[where]
    out = np.ascontiguousarray(out.T).reshape(-1)
    starts = (out & HERE).astype(bool)
    starts[:-1] |= (out[1:] & BEFORE).astype(bool)
    return starts[:n]


# --- The merger ------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    """The published table of printable letters for bytes, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    return letters


class Merger:
    """The byte transducer of one BPE vocabulary, built as it is used."""

    def __init__(self, path: str, most_states: int = 300_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[x] for x in token)
        special = {x["content"]: x for x in spec["added_tokens"]}
        self.special = sorted(special)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.ids[raw(a)], self.ids[raw(b)]] = (rank, self.ids[raw(a) + raw(b)])
        #: Beginnings of tokens, proper ones.
        self.beginnings = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.most_states = most_states
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.start_over()

    def start_over(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        #: Transitions, an open hash table: state and byte; next state and gain.
        self.bits, self.used = 16, 0
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.goes = np.zeros(1 << self.bits, np.int64)
        self.state_of(b"", (0, -1, 0))

    def state_of(self, suffix: bytes, entries: tuple[int, ...]) -> int:
        """The number of a state: the longest suffix that begins a token, and for each of its
        ends that does so its length, the token before it, and that prefix's token count
        less the whole's."""
        key = (suffix, entries)
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.states)
            self.states.append(key)
        return found

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Where the keys are in the table, or the free place where they belong."""
        mask = (1 << self.bits) - 1
        at = ((keys * 0x9E3779B1) >> 7) & mask
        found = self.keys[at]
        astray = np.flatnonzero((found != keys) & (found >= 0))
        while astray.size:
            at[astray] = (at[astray] + 1) & mask
            found = self.keys[at[astray]]
            astray = astray[(found != keys[astray]) & (found >= 0)]
        return at

    def add(self, keys: np.ndarray, goes: np.ndarray) -> None:
        if (self.used + len(keys)) * 3 > 1 << self.bits:
            old = self.keys >= 0
            keys = np.concatenate([self.keys[old], keys])
            goes = np.concatenate([self.goes[old], goes])
            self.used = 0
            while len(keys) * 3 > 1 << self.bits:
                self.bits += 1
            self.keys = np.full(1 << self.bits, -1, np.int64)
            self.goes = np.zeros(1 << self.bits, np.int64)
        self.used += len(keys)
        self._place(keys, goes)

    def _place(self, keys: np.ndarray, goes: np.ndarray) -> None:
        while keys.size:
            at = self.slots(keys)
            # Of keys that want the same place one gets it, the others look again.
            _, first = np.unique(at, return_index=True)
            self.keys[at[first]], self.goes[at[first]] = keys[first], goes[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, goes = keys[rest], goes[rest]

    def merge(self, data: bytes) -> list[int]:
        """BPE as defined: the pair of least rank first, the leftmost of those first."""
        parts = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while True:
            pairs = zip(parts, parts[1:], strict=False)
            ranked = [(*self.merges[p], i) for i, p in enumerate(pairs) if p in self.merges]
            if not ranked:
                return parts
            _, token, i = min(ranked, key=lambda x: (x[0], x[2]))
            parts[i : i + 2] = [token]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side."""
        known = self.fits_memo.get((left, right))
        if known is None:
            if len(self.fits_memo) > 2_000_000:
                self.fits_memo.clear()
            whole = self.bytes_of[left] + self.bytes_of[right]
            known = self.fits_memo[left, right] = self.merge(whole) == [left, right]
        return known

    def build(self, key: int) -> int:
        """Where a transition goes, and its gain, in one number.

        The tokens of a text's beginning are those of the whole up to there, so the last
        token of the longer text is the one suffix token that fits after the tokens before
        it; the count is one more than before that token.
        """
        state, byte = key >> 8, key & 255
        suffix, flat = self.states[state]
        longer = suffix + bytes([byte])
        entries = [
            (longer[len(suffix) - flat[i] :], *flat[i : i + 3]) for i in range(0, len(flat), 3)
        ]
        for end, _, before, less in entries:
            token = self.ids.get(end)
            if token is not None and (before < 0 or self.fits(before, token)):
                break
        gain = less + 1
        keep = []
        for end, length, before, less in entries:
            if end in self.beginnings:
                keep += (length + 1, before, less - gain)
        keep += (0, token, 0)
        to = self.state_of(longer[len(longer) - keep[0] :], tuple(keep))
        return to << 8 | gain + 128

    def follow(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, entry: np.ndarray,
               fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Advance all lanes from begin to end together; ``fresh`` marks where pieces start.

        Returns tokens counted and the last states. Longer lanes come first, so those at
        work are always the leading ones.
        """
        lanes = len(begin)
        state, count = entry.copy(), np.zeros(lanes, np.int64)
        less = begin - end
        for j in range(-int(less[0]) if lanes else 0):
            live = int(np.searchsorted(less, -j, side="left"))
            at = begin[:live] + j
            here = state[:live]
            here[fresh[at]] = 0
            key = here << 8 | data[at]
            slot = self.slots(key)
            missing = np.flatnonzero(self.keys[slot] < 0)
            if missing.size:
                new = np.unique(key[missing])
                self.add(new, np.array([self.build(int(x)) for x in new]))
                slot = self.slots(key)
            goes = self.goes[slot]
            count[:live] += goes & 255
            state[:live] = goes >> 8
        return count + 128 * less, state

    #: Lanes begin at pieces about this far apart; longer pieces are cut inside.
    LANE = 384

    def count(self, data: np.ndarray, fresh: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Tokens of the texts that begin at ``heads``; ``fresh`` marks where pieces start."""
        if len(self.states) > self.most_states:
            self.start_over()
        n, cells = len(data), np.arange(0, len(data), self.LANE)
        starts = np.flatnonzero(fresh)
        first = np.searchsorted(starts, cells)
        # The first piece start of each cell; a cell without one begins inside a piece.
        begins = np.where(
            np.diff(np.append(first, len(starts))) > 0, starts[np.minimum(first, len(starts) - 1)], cells
        )
        begin = np.union1d(begins, heads)
        end = np.append(begin[1:], n)
        # A part of a long piece does not know its first state: it takes the last state of
        # the part before, and goes again if that one changed.
        inner = ~fresh[begin]
        entry, left = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        count = np.zeros(len(begin), np.int64)
        todo = np.arange(len(begin))
        while todo.size:
            todo = todo[np.argsort(begin[todo] - end[todo], kind="stable")]
            count[todo], left[todo] = self.follow(data, begin[todo], end[todo], entry[todo], fresh)
            known = np.zeros(len(begin), np.int64)
            known[1:] = np.where(inner[1:], left[:-1], 0)
            todo = np.flatnonzero(known != entry)
            entry = known
        return np.add.reduceat(count, np.searchsorted(begin, heads))


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


#: Characters of texts that are counted together; a longer text is counted by itself.
BATCH = 4_000_000


def count_tokens(texts: list[str], machine: Merger) -> np.ndarray:
    """Tokens of each text.

    The strings of special tokens count as one each and part the text, which is what the
    library does by default.
    """
    counts = np.zeros(len(texts), np.int64)
    owner, parts, size = [], [], 0

    def flush() -> None:
        nonlocal owner, parts, size
        if parts:
            np.add.at(counts, owner, _count_parts(parts, machine))
        owner, parts, size = [], [], 0

    for i, text in enumerate(texts):
        pieces = [text]
        for special in machine.special:
            if special in text:
                split = [x.split(special) for x in pieces]
                counts[i] += sum(len(x) - 1 for x in split)
                pieces = [y for x in split for y in x]
        for piece in pieces:
            if piece:
                owner.append(i)
                parts.append(piece)
                size += len(piece)
        if size >= BATCH:
            flush()
    flush()
    return counts


def _count_parts(parts: list[str], machine: Merger) -> np.ndarray:
    points = np.frombuffer("\0".join([*parts, ""]).encode("utf-32-le"), np.uint32)
    stops = np.cumsum([len(x) + 1 for x in parts]) - 1
    kinds = _classes()[points]
    kinds[stops] = STOP
    starts = np.delete(piece_starts(kinds), stops)
    data = np.frombuffer("".join(parts).encode("utf-8"), np.uint8)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    fresh = np.zeros(len(data), bool)
    fresh[lead] = starts
    heads = lead[np.concatenate([[0], (stops - np.arange(len(stops)))[:-1]])]
    return machine.count(data, fresh, heads)


def with_token_counts(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit``) for each row.

    Counts are those of the library for the vocabulary file ``path``, which must be at that
    place on every executor: whole texts, nothing added, special strings as by default. Null
    and empty texts have no bytes and no tokens. Repeated rows each give a row, an empty
    table none. Null ids are kept; other columns are not read.
    """

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = merger(path)
        for frame in frames:
            texts = frame["t"].tolist()
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_bytes": frame["n"],
                    "n_tokens": count_tokens(texts, machine),
                }
            )

    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sent = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n"),
        text.alias("t"),
    )
    out = sent.mapInPandas(counted, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
