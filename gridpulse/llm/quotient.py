"""Exact deduplication through counting quotient filters.

Texts are equal when they are identical after lower-casing A-Z. Each text has a
fingerprint of ``BITS`` bits. The work goes in four steps, each a Spark job:

1. One pass over the texts writes (row, id, fingerprint, SHA-256) of every row.
2. Every partition of fingerprints becomes a counting quotient filter, so that a
   text that fills a third of the table is one entry with a counter. A filter is
   cut by the upper bits of the fingerprint, and the cuts of all partitions that
   cover one range are merged by their sorted remainders. Nothing is lost, as a
   quotient and a remainder give the fingerprint back. The number of filters and
   of ranges both grow with the square root of the rows, which bounds a cut, a
   filter and the number of cuts alike.
3. Fingerprints with a count above one set their bit in a bitmap of a fixed size
   (``BITMAP_BITS``). Texts whose bit is set go on to the comparison byte by
   byte: a grouping by the text itself, with partial aggregation, so that the
   copies of a hot text leave a task as one row. All other texts are unique.
4. Rows of the verified groups take the largest id of their group.

A fingerprint or a bit that two texts share costs a comparison, never an error.

Defined results: a null text counts as empty. Among equal rows with one id, one
row stays; a null id is smaller than any other. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections import deque

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import slices, stored, text_bytes

BITS = 48
BITMAP_BITS = 26  # 8 MB
CUT_ENTRIES = 256  # mean entries of one partition's cut for one range
LOAD = 0.8


class QuotientFilter:
    """A counting quotient filter over fingerprints of ``bits`` bits.

    The upper ``bits - r`` bits of a fingerprint are its quotient, which names a
    home slot; the lower ``r`` bits are its remainder. The remainders of a
    quotient form a run in ascending order; runs stand in the order of their
    quotients, each at its home or right behind the run before it. Slots behind a
    remainder may hold the digits of its count less one. Three bits a slot tell
    this apart: the quotient has a run, the slot ends a run, the slot is a digit.
    """

    def __init__(self, bits: int, r: int, occupied: np.ndarray, run_end: np.ndarray, digit: np.ndarray, slots: np.ndarray):
        self.bits, self.r, self.occupied, self.run_end, self.digit, self.slots = bits, r, occupied, run_end, digit, slots

    @staticmethod
    def of(values: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From ascending distinct fingerprints and their counts."""
        values, counts = values.astype(np.uint64), counts.astype(np.uint64)
        q = min(bits, max(1, math.ceil(math.log2(max(1, (len(values) + _digits(counts, 8).sum()) / LOAD)))))
        r = bits - q
        kind = np.dtype(next(f"u{size}" for size in (1, 2, 4, 8) if r <= 8 * size))
        width = 8 * kind.itemsize
        digits = _digits(counts, width)
        size = 1 + digits
        before = np.cumsum(size) - size
        home = (values >> np.uint64(r)).astype(np.int64)
        at = before + np.maximum.accumulate(home - before) if len(values) else before
        n = max(1 << q, int(at[-1] + size[-1]) if len(at) else 0)
        occupied, run_end, digit, slots = np.zeros(1 << q, bool), np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, kind)
        occupied[home] = True
        slots[at] = values & np.uint64((1 << r) - 1)
        rest = counts - np.uint64(1)
        for k in range(int(digits.max(initial=0))):
            some = digits > k
            slots[at[some] + 1 + k] = (rest[some] >> np.uint64(k * width)) & np.uint64((1 << width) - 1)
            digit[at[some] + 1 + k] = True
        last = np.append(home[1:] != home[:-1], True) if len(home) else np.zeros(0, bool)
        run_end[(at + digits)[last]] = True
        return QuotientFilter(bits, r, occupied, run_end, digit, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending fingerprints and their counts."""
        home, end = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        start = np.maximum(home, np.append(-1, end[:-1]) + 1)[:len(home)]
        size = end - start + 1
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        digit = self.digit[at]
        quotient = np.repeat(home.astype(np.uint64), size)[~digit]
        values = quotient << np.uint64(self.r) | self.slots[at[~digit]].astype(np.uint64)
        counts = np.ones(len(values), np.uint64)
        entry = (np.cumsum(~digit) - 1)[digit]
        place = at[digit] - at[~digit][entry] - 1
        np.add.at(counts, entry, self.slots[at[digit]].astype(np.uint64) << (place * 8 * self.slots.itemsize).astype(np.uint64))
        return values, counts.astype(np.int64)

    def to_bytes(self) -> bytes:
        head = struct.pack("<BBBIQ", self.bits, self.r, self.slots.itemsize, len(self.occupied), len(self.slots))
        return head + b"".join(np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.digit)) + self.slots.tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> QuotientFilter:
        bits, r, size, quotients, n = struct.unpack_from("<BBBIQ", data)
        at, parts = struct.calcsize("<BBBIQ"), []
        for length in (quotients, n, n):
            parts.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-length // 8), at), count=length).astype(bool))
            at += -(-length // 8)
        return QuotientFilter(bits, r, *parts, np.frombuffer(data, f"u{size}", n, at))


def _digits(counts: np.ndarray, width: int) -> np.ndarray:
    """Digits of ``width`` bits of each count less one; none for zero."""
    out, rest = np.zeros(len(counts), np.int64), counts - np.uint64(1)
    while rest.any():
        out += rest > 0
        rest = rest >> np.uint64(width) if width < 64 else np.zeros_like(rest)
    return out


def merged(items: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending (fingerprints, counts) of several filters as one; two at a time."""
    queue = deque(items)
    while len(queue) > 1:
        (a, m), (b, n) = queue.popleft(), queue.popleft()
        values, counts = np.empty(len(a) + len(b), a.dtype), np.empty(len(a) + len(b), np.int64)
        to_a = np.arange(len(a)) + np.searchsorted(b, a, "left")
        to_b = np.arange(len(b)) + np.searchsorted(a, b, "right")
        values[to_a], values[to_b], counts[to_a], counts[to_b] = a, b, m, n
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
        queue.append((values[first], np.add.reduceat(counts, first) if len(first) else counts))
    return queue[0] if queue else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def folded(column: pa.Array) -> list[bytes]:
    """UTF-8 of the texts with A-Z lower-cased; null is empty."""
    return [t.lower() for t in text_bytes(column)]


def fingerprint(text: bytes, bits: int = BITS) -> int:
    return xxhash.xxh3_64_intdigest(text) >> (64 - bits)


def repeated_fingerprints(marked: DataFrame, n: int, bits: int = BITS) -> DataFrame:
    """(fp, n): fingerprints that occur more than once in ``marked.fp``, by
    filters per partition that are merged range by range. ``n`` rows in all."""
    parts = max(1, math.ceil(math.sqrt(n / CUT_ENTRIES)))
    range_bits = max(0, math.ceil(math.log2(parts)))
    low = bits - range_bits

    def build(batches):
        values = np.concatenate([np.zeros(0, np.int64), *(b.column("fp").to_numpy() for b in batches)])
        found, counts = np.unique(values, return_counts=True)
        edges = np.searchsorted(found >> low, np.arange((1 << range_bits) + 1))
        out = []
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if a < b:
                out.append((k, QuotientFilter.of(found[a:b] & ((1 << low) - 1), counts[a:b], low).to_bytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())],
                                             names=["cut", "filter"])

    def merge(key: tuple, cuts: pa.Table) -> pa.Table:
        values, counts = merged([QuotientFilter.from_bytes(x).items() for x in cuts.column("filter").to_pylist()])
        some = counts > 1
        return pa.table({"fp": values[some].astype(np.int64) | (key[0].as_py() << low), "n": counts[some]})

    return (marked.select("fp").coalesce(parts).mapInArrow(build, "cut int, filter binary")
            .groupBy("cut").applyInArrow(merge, "fp long, n long"))


def bitmap_of(repeated: DataFrame) -> np.ndarray:
    """Bit ``fp mod 2 ** BITMAP_BITS`` is set for every fingerprint; made by an
    aggregation, of a fixed size whatever the table's."""
    words = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    bit = F.col("fp").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    found = (repeated.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, int(fp & 63))").alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return words


def bit_set(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values.astype(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)
    return (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def exact_copies(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row: the id of the
    row that stays of its group of equal texts, and the SHA-256 of its text.
    ``bits`` (at least ``BITMAP_BITS``) is the length of a fingerprint."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def mark(batches):
        for batch in slices(batches, "text"):
            body = folded(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(t, bits) for t in body], pa.int64()),
                 pa.array([hashlib.sha256(t).digest() for t in body], pa.binary())], names=["doc_id", "fp", "digest"])

    marked = stored(docs.mapInArrow(mark, "doc_id long, fp long, digest binary")
                    .withColumn("row", F.monotonically_increasing_id()), "marked")
    repeated = stored(repeated_fingerprints(marked, marked.count(), bits), "repeated")
    held = spark.sparkContext.broadcast(bitmap_of(repeated))

    def candidates(batches):
        for batch in slices(batches, "text"):
            body = folded(batch.column("text"))
            fps = np.array([fingerprint(t, bits) for t in body], np.int64)
            some = np.flatnonzero(bit_set(held.value, fps))
            yield pa.RecordBatch.from_arrays([pa.array(fps[some]), pa.array([body[i] for i in some], pa.binary())], names=["fp", "body"])

    def flag(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bit_set(held.value, batch.column("fp").to_numpy()))],
                                             names=[*batch.schema.names, "hit"])

    # The texts themselves are the grouping key: this is the comparison of bytes.
    equal = (docs.mapInArrow(candidates, "fp long, body binary").groupBy("fp", "body").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("fp", F.unhex(F.sha2("body", 256)).alias("digest")))
    flagged = marked.mapInArrow(flag, "doc_id long, fp long, digest binary, row long, hit boolean")
    rows = flagged.where("hit").drop("hit")
    groups = rows.groupBy("fp", "digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("top"))
    groups = stored(groups.join(equal, ["fp", "digest"]), "groups")
    told = rows.join(groups, ["fp", "digest"], "left").select(
        "doc_id", F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("top.row") == F.col("row"), F.lit(True)).alias("kept"), "digest")
    alone = flagged.where("not hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                            F.lit(True).alias("kept"), "digest")
    return alone.unionByName(told)
