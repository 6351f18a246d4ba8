"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of words with smallest period ``q`` that no neighbouring word
extends, of at least ``max(min_length, 3 q)`` words. For every period ``p`` the
words at the positions 0, p, 2p, ... (the harmonic grid) are compared with those
``p`` further on; a run of three periods holds such a grid point from which at
least ``p + 1`` words repeat, so grid points whose first ``FEW`` words do not
repeat are passed over. From the others two longest common extensions, forwards
and backwards, give the whole stretch.

Longest common extensions: only the suffixes at positions of a difference cover
modulo ``MODULUS`` are sorted (blocks of ``MODULUS`` words, then doubling). Two
positions reach a pair of sampled ones after fewer than ``MODULUS`` words, which
are compared one by one; from there the answer is the least common prefix
between their ranks, read from a sparse table.

The texts of a slice of rows are searched together, each ended by a word of its
own, so that nothing extends into the next text. Nothing is shuffled, and the
memory of a task is that of a slice, or of the longest text.

Defined results: null, empty and blank texts have no words and no runs; repeated
rows give a row each; null ids are kept; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridpulse.llm.common import slices, text_bytes

MIN_LENGTH, MIN_PERIODS, FEW = 24, 3, 8
# A perfect difference set: every residue but 0 is one difference of two members.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
PENDING = 1 << 20  # grid points whose extensions are looked up together

_MEETS = np.zeros(MODULUS, np.int64)
for _a in COVER:
    for _b in COVER:
        _MEETS[(_b - _a) % MODULUS] = _a


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class Extensions:
    """Longest common extensions to the right in an array of numbers whose last
    one occurs nowhere else."""

    def __init__(self, t: np.ndarray):
        n, least = len(t), t.min(initial=0)
        self.t = np.concatenate([t, least - 1 - np.arange(MODULUS + 1)])
        at = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.place = np.full(n, -1, np.int64)
        self.place[at] = np.arange(len(at))
        levels = [self._blocks(at)]
        step = MODULUS
        while levels[-1].max(initial=0) + 1 < len(at):
            rank = levels[-1]
            then = np.full(len(at), -1, np.int64)
            inside = at + step < n
            then[inside] = rank[self.place[at[inside] + step]]
            levels.append(np.unique(rank * (len(at) + 1) + then + 1, return_inverse=True)[1])
            step *= 2
        self.rank = levels[-1]
        order = np.empty(len(at), np.int64)
        order[self.rank] = np.arange(len(at))
        self.table = self._minima(self._prefixes(at[order[:-1]], at[order[1:]], levels))

    def _blocks(self, at: np.ndarray) -> np.ndarray:
        """Ranks of the blocks of MODULUS words at the sampled positions."""
        words = self.t - self.t.min()
        bits = max(1, int(words.max(initial=0)).bit_length())
        per = max(1, 63 // bits)
        keys = []
        for k in range(0, MODULUS, per):
            key = np.zeros(len(at), np.int64)
            for j in range(k, min(MODULUS, k + per)):
                key = key << bits | words[at + j]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _prefixes(self, i: np.ndarray, j: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of sampled positions: whole blocks from the longest
        level down, then words."""
        found = np.zeros(len(i), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero(np.maximum(i, j) + found < len(self.place))
            a, b = (self.place[x[inside] + found[inside]] for x in (i, j))
            found[inside] += np.where(levels[k][a] == levels[k][b], MODULUS << k, 0)
        live = np.arange(len(i))
        while len(live):
            live = live[self.t[i[live] + found[live]] == self.t[j[live] + found[live]]]
            found[live] += 1
        return found

    @staticmethod
    def _minima(values: np.ndarray) -> np.ndarray:
        levels = [values]
        k = 1
        while 2 * k <= len(values):
            last = levels[-1]
            levels.append(np.concatenate([np.minimum(last[:-k], last[k:]), last[-k:]]))
            k *= 2
        return np.array(levels)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common extensions from each i and j, i < j."""
        meet = (_MEETS[(j - i) % MODULUS] - i) % MODULUS
        out, live = np.zeros(len(i), np.int64), np.arange(len(i))
        for k in range(MODULUS):
            sampled = meet[live] == k
            self._from_ranks(out, live[sampled], i, j, k)
            live = live[~sampled]
            same = self.t[i[live] + k] == self.t[j[live] + k]
            out[live[~same]] = k
            live = live[same]
        return out

    def _from_ranks(self, out: np.ndarray, some: np.ndarray, i: np.ndarray, j: np.ndarray, k: int) -> None:
        if len(some):
            a, b = (self.rank[self.place[x[some] + k]] for x in (i, j))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            out[some] = k + np.minimum(self.table[level, low], self.table[level, high - (1 << level)])


def grid_points(t: np.ndarray, longest: int):
    """(positions, periods) of grid points with ``FEW`` repeated words, in parts.
    ``t`` ends with ``FEW`` words of their own at least."""
    n = len(t) - FEW
    held, total = [], 0
    for p in range(1, longest // MIN_PERIODS + 1):
        at = np.flatnonzero(t[0:n - p:p] == t[p:n:p]) * p
        if len(at):
            at = at[t[at + 1] == t[at + p + 1]]
        if len(at):
            held.append((at, p))
            total += len(at)
        if total >= PENDING or p == longest // MIN_PERIODS:
            if held:
                at = np.concatenate([a for a, _ in held])
                period = np.repeat([q for _, q in held], [len(a) for a, _ in held])
                for k in range(2, FEW):
                    same = t[at + k] == t[at + period + k]
                    at, period = at[same], period[same]
                if len(at):
                    yield at, period
            held, total = [], 0


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each between two words of their own, and
    the place where each begins."""
    parts = [np.array([-1])]
    for k, t in enumerate(texts):
        parts += [t, np.array([-2 - k])]
    sizes = np.array([len(t) + 1 for t in texts])
    return np.concatenate(parts), 1 + np.cumsum(sizes) - sizes


def _padded(t: np.ndarray) -> np.ndarray:
    return np.concatenate([t, t.min() - 1 - np.arange(FEW)])


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Rows (start, length, period) of all runs of each text, by start, then period."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    some = [k for k, t in enumerate(texts) if len(t) >= min_length]
    if not some:
        return out
    # Texts with no grid point that repeats a few words have no run.
    t, begins = _joined([texts[k] for k in some])
    marked = np.zeros(len(some), bool)
    for at, _ in grid_points(_padded(t), max(len(texts[k]) for k in some)):
        marked[np.maximum(np.searchsorted(begins, at, "right") - 1, 0)] = True
    some = [k for k, m in zip(some, marked, strict=True) if m]
    if not some:
        return out
    t, begins = _joined([texts[k] for k in some])
    right, left = Extensions(t), Extensions(t[::-1].copy())
    found = none
    for at, period in grid_points(_padded(t), max(len(texts[k]) for k in some)):
        for a in range(0, len(at), PENDING):
            i, p = at[a:a + PENDING], period[a:a + PENDING]
            inside = i > 0
            i, p = i[inside], p[inside]
            start, end = i - left(len(t) - i - p, len(t) - i), i + p + right(i, i + p)
            whole = end - start >= np.maximum(min_length, MIN_PERIODS * p)
            found = np.concatenate([found, np.stack([start, end - start, p], 1)[whole]])
            # A multiple of a run's smallest period gives the same stretch.
            found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
            found = found[np.append(True, (found[1:, :2] != found[:-1, :2]).any(1))[:len(found)]]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    edges = np.searchsorted(found[:, 0], np.append(begins, len(t)))
    for k, text in enumerate(some):
        out[text] = found[edges[k]:edges[k + 1]] - [begins[k], 0, 0]
    return out


def strongest(runs: np.ndarray) -> tuple | None:
    """The run of greatest length / period; of equal ones the first, then the
    one of the shortest period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]


def _structs(rows: list, valid: list[bool] | None = None) -> pa.Array:
    cells = np.array([r if r is not None else (0, 0, 0) for r in rows], np.int64).reshape(-1, 3)
    mask = None if valid is None else pa.array([not v for v in valid], pa.bool_())
    return pa.StructArray.from_arrays([pa.array(cells[:, k].copy()) for k in range(3)], names=["start", "length", "period"], mask=mask)


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, strongest, collapsed) of every row: the runs as
    (start, length, period) by start, then period; the run of the greatest
    exponent (null if none); and the text in which every run is one period."""
    def search(batches):
        for batch in slices(batches, "text"):
            words = [b.split() for b in text_bytes(batch.column("text"))]
            numbers = Numbers()
            flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, sum(map(len, words)))
            runs = runs_of(np.split(flat, np.cumsum([len(w) for w in words])[:-1]), min_length)
            best = [strongest(r) for r in runs]
            offsets = np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), _structs(np.concatenate(runs).tolist())),
                 _structs(best, [b is not None for b in best]),
                 pa.array([b" ".join(kept_words(w, r)) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                "strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): about a tenth of the texts, by the CRC-32 of the id (a
    null id as empty text), repeat a stretch of their own words up to the end."""
    def edit(batches):
        for batch in slices(batches, "text"):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
                if h % 10 == 0 and (words := text.split()):
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    text = b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(edit, f"doc_id {kind}, text string")
