"""Packing of token sequences by non-negative least squares.

Documents are tokenised (one closing id each) and cut at multiples of the window
into pieces. Only the histogram of piece lengths, at most ``window`` numbers,
goes to the driver:

1. shallow combinations (one to three lengths) that fill a window are
   enumerated;
2. their repeat counts are solved against the histogram by non-negative least
   squares (coordinate descent on the sparse normal equations);
3. counts are rounded down to what the histogram holds;
4. the remaining lengths are packed greedily, longest first, into the fullest
   window they fit, in runs of equal windows.

The plan is a bounded list of slots ("pieces of this length with ranks a..b go
to sequence s + (rank - a) div k"). Pieces get their rank within their length
from per-task counts, so that a length held by a third of all pieces is
numbered by all tasks alike, and look up their slot map-side.

Defined results: null and empty texts are the closing id alone. Repeated rows
and null ids are packed like any other row. An empty table has no pieces.
Special-token strings in a text are what the tokenizer makes of them.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import Memo, slices, stored, texts

WINDOW = 4096
CLOSE_ID = 2

# The tokenizer's own splitting pattern with white space spelt out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in plain else next(other)) for b in range(256)]


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    White space always parts pre-tokens and the model reads them one by one, so
    the ids of a text are those of its white-space chunks in a row, and a chunk's
    are those of its pre-tokens. Both are kept; only new pre-tokens reach the
    tokenizer's model."""

    def __init__(self, path: str, keep: int = 250_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(rf"[^{SPACE}]+").findall
        find, model, letters = regex.compile(PIECES).findall, self.tokenizer.model, byte_letters()

        def word(w: str) -> bytes:
            if not (w.isascii() and w.isprintable()):
                w = "".join(letters[b] for b in w.encode("utf-8"))
            ids = [t.id for t in model.tokenize(w)]
            return struct.pack(f"<{len(ids)}I", *ids)

        words = Memo(word, keep)

        def chunk(c: str) -> bytes:
            if c.isalpha():
                return words[c]
            if c[-1] in ".,;:!?" and c[:-1].isalpha():
                return words[c[:-1]] + words[c[-1]]
            return b"".join([words[w] for w in find(c)])

        self.chunks = Memo(chunk, keep)

    def __call__(self, text: str) -> bytes:
        if "<|" in text:  # may be a special token: the tokenizer decides
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # final sigma: lower-cased char by char
                text = "".join(map(str.lower, text))
        text = text.lower()
        separators = any(c in text for c in "\x1c\x1d\x1e\x1f")  # white space to Python only
        return b"".join(map(self.chunks.__getitem__, self.split(text) if separators else text.split()))


PIECE = "length int, start long, ids_crc32 long, doc_tokens long, part int, nth long"


def token_pieces(docs: DataFrame, path: str | None = None, window: int = WINDOW, close_id: int = CLOSE_ID,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece; ``nth`` numbers the pieces of one length in a task."""
    path = path or tokenizer_path()
    close = np.asarray([close_id], "<u4").tobytes()
    schema = "doc_id long, " + PIECE + (", ids array<int>" if with_ids else "")

    def cut(batches):
        encode, part, count = Encoder(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                ids = encode(text) + close
                total = len(ids) // 4
                for start in range(0, total, window):
                    own = ids[4 * start:4 * (start + window)]
                    n = len(own) // 4
                    rows.append((doc_id, n, start, zlib.crc32(own), total, part, count[n],
                                 *([np.frombuffer(own, "<u4").tolist()] if with_ids else [])))
                    count[n] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "length", "start", "ids_crc32", "doc_tokens", "part", "nth", "ids"]
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)], names=names[:len(cols)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def combinations(lengths: np.ndarray, window: int, tries: int = 24) -> list[tuple[int, ...]]:
    """Combinations of one to three present lengths that fill the window: all
    pairs, and triples with the middle length taken evenly from those present."""
    have = set(lengths.tolist())
    out = {(window,)} if window in have else set()
    out.update((a, window - a) for a in have if 2 * a >= window and window - a in have)
    ordered = np.sort(lengths)
    for a in ordered[ordered * 3 >= window].tolist():
        rest = window - a
        fits = ordered[(ordered * 2 >= rest) & (ordered <= min(a, rest - 1))]
        for b in fits[np.unique(np.linspace(0, len(fits) - 1, tries).astype(int))].tolist() if len(fits) else []:
            if rest - b in have:
                out.add((a, b, rest - b))
    return sorted(out, reverse=True)


def solve_counts(combos: list[tuple[int, ...]], hist: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - hist|^2 by coordinate descent."""
    left, x = hist.astype(float).copy(), np.zeros(len(combos))
    sparse = []
    for c in combos:
        idx, times = np.unique(c, return_counts=True)
        sparse.append((idx.tolist(), times.tolist(), float((times ** 2).sum())))
    for _ in range(sweeps):
        moved = 0.0
        for j, (idx, times, norm) in enumerate(sparse):
            step = max(sum(left[i] * t for i, t in zip(idx, times, strict=True)) / norm, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for i, t in zip(idx, times, strict=True):
                    left[i] -= step * t
        if moved < 0.5:
            break
    return x


def plan_slots(hist: np.ndarray, window: int = WINDOW) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, pieces a sequence, first sequence,
    offset of the first piece, last rank + 1), in rank order."""
    left = hist.astype(np.int64).copy()
    slots, taken, sequence = defaultdict(list), defaultdict(int), 0

    def place(content: tuple[tuple[int, int], ...], repeats: int) -> None:
        """content: (length, pieces of it in each sequence)."""
        nonlocal sequence
        offset = 0
        for length, k in content:
            first = taken[length]
            taken[length] += k * repeats
            slots[length].append((first, k, sequence, offset, first + k * repeats))
            offset += length * k
        sequence += repeats

    combos = combinations(np.flatnonzero(left), window)
    for combo, x in zip(combos, solve_counts(combos, left), strict=True):
        idx, times = np.unique(combo, return_counts=True)
        repeats = int(min(np.floor(x + 1e-9), (left[idx] // times).min()))
        if repeats > 0:
            left[idx] -= times * repeats
            place(tuple((int(i), int(t)) for i, t in zip(idx[::-1], times[::-1], strict=True)), repeats)
    # Greedy rest: windows with equal content are one entry (content, number), by free space.
    free: dict[int, list[list]] = defaultdict(list)
    space = np.zeros(window + 1, bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            at = length + int(np.argmax(space[length:]))
            if not space[at]:
                k = min(window // length, todo)
                n = todo // k
                free[window - k * length].append([((length, k),), n])
                space[window - k * length] = True
                todo -= k * n
                continue
            content, n = free[at].pop()
            k = min(at // length, todo)
            use = min(n, todo // k)
            if use < n:
                free[at].append([content, n - use])
            space[at] = bool(free[at])
            free[at - k * length].append([(*content, (length, k)), use])
            space[at - k * length] = True
            todo -= k * use
    for entries in (free[f] for f in sorted(free)):
        for content, n in entries:
            place(content, n)
    return {length: np.asarray(rows, np.int64) for length, rows in slots.items()}


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, close_id: int = CLOSE_ID,
         with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; ``with_ids`` keeps
    the token ids of the piece."""
    pieces = stored(token_pieces(docs, path, window, close_id, with_ids), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    hist = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `window` rows
        hist[row.length] = row.n
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    own = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if with_ids else [])
    held = docs.sparkSession.sparkContext.broadcast(plan_slots(hist, window))
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              + ("ids array<int>, " if with_ids else "") + "sequence_id long, offset long")

    def assign(batches):
        slots = held.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                table = slots[length]
                s = table[np.searchsorted(table[:, 0], ranks[rows], side="right") - 1]
                nth = ranks[rows] - s[:, 0]
                sequence[rows] = s[:, 2] + nth // s[:, 1]
                offset[rows] = s[:, 3] + nth % s[:, 1] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(sequence), pa.array(offset)],
                                             names=[*own, "sequence_id", "offset"])

    return (ranked.select(*own, "rank").withColumn("length", F.col("length").cast("long"))
            .mapInArrow(assign, schema))
