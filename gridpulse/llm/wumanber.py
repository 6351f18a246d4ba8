"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``window`` consecutive words of every benchmark
item (an item of fewer words is one window). Words of the benchmark are numbered
and every other word is 0, so that pattern and text are integer sequences and
"block" means two neighbouring words. For the patterns of one length:

* the SHIFT table says, for a block, how far the search may jump because no
  pattern holds that block nearer to its end;
* blocks with shift 0 select a bucket of the suffix hash table, whose entries
  are narrowed by their first block;
* direct comparison of the numbers confirms an occurrence.

Tasks cut the benchmark's items into segments of ``SEGMENT`` windows that share
``window - 1`` words with the next and write them to the shared folder. A hash
deals the segments to blocks of about ``BLOCK_WINDOWS`` windows and
``BLOCK_BYTES`` bytes, however long an item is. One block at a time goes to the
tasks, all documents pass through it, and between blocks the rows are written to
the shared folder. So a larger benchmark means more passes and never more memory.

Defined results: null and empty texts have no words and no hits; an item with
no words has no window; an empty benchmark hits nothing. Repeated items are
found together; items without an id are one item with a null id. Repeated documents give a row each; null ids are kept. Extra columns are
kept, but for those named like the results (``n_words``, ``n_hit``, ``hits``,
``items``), which are replaced.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import slices, stored, text_bytes

WINDOW = 10
SEGMENT = 1_000
BLOCK_WINDOWS = 200_000
BLOCK_BYTES = 32 << 20

# Lower-cases A-Z and turns every other byte below 0x80 that is no letter or
# digit into a space; UTF-8 bytes of other characters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Search:
    """Tables for the windows of the given items, one set per pattern length."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set]] = defaultdict(lambda: defaultdict(set))
        for item_id, ws in items:
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in ws)
            for i in range(max(1, len(ids) - window + 1)):
                if ids:
                    by_length[min(window, len(ids))][ids[i:i + window]].add(item_id)
        self.base = len(self.number) + 1
        self.machines = [self._machine(m, patterns) for m, patterns in sorted(by_length.items())]

    def _machine(self, m: int, patterns: dict[tuple[int, ...], set]) -> tuple:
        base, shift, bucket = self.base, {}, defaultdict(lambda: defaultdict(list))
        if m == 1:
            return m, {}, {p[0]: ids for p, ids in patterns.items()}
        for p, ids in patterns.items():
            for j in range(1, m):  # the block ending at j
                key = p[j - 1] * base + p[j]
                shift[key] = min(shift.get(key, m - 1), m - 1 - j)
            bucket[p[m - 2] * base + p[m - 1]][p[0] * base + p[1]].append((p, ids))
        return m, shift, {k: dict(v) for k, v in bucket.items()}

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Intervals [start, stop) of occurrences in ascending order of start
        per length, and the ids of the items found."""
        get = self.number.get
        seq = [get(w, 0) for w in ws]
        found, items, n, base = [], set(), len(ws), self.base
        for m, shift, bucket in self.machines:
            if m == 1:
                for i, x in enumerate(seq):
                    if x in bucket:
                        found.append((i, i + 1))
                        items |= bucket[x]
                continue
            end, far = m - 1, m - 1
            jump = shift.get
            while end < n:
                key = seq[end - 1] * base + seq[end]
                step = jump(key, far)
                if step:
                    end += step
                    continue
                start = end - m + 1
                for p, ids in bucket.get(key, {}).get(seq[start] * base + seq[start + 1], ()):
                    if tuple(seq[start:end + 1]) == p:
                        found.append((start, end + 1))
                        items |= ids
                end += 1
        return found, items


def item_segments(benchmark: DataFrame, window: int = WINDOW, segment: int = SEGMENT) -> DataFrame:
    """(item_id as text, place, words joined by spaces, windows) of every item, cut
    so that each of its windows lies in exactly one segment."""
    def cut(batches):
        for batch in slices(batches, "text"):
            rows = []
            for item_id, text in zip(batch.column("item_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                ws = words(text)
                n = max(1, len(ws) - window + 1) if ws else 0
                rows += [(item_id, at, b" ".join(ws[at:at + segment + window - 1]), min(segment, n - at)) for at in range(0, n, segment)]
            if rows:
                ids, places, parts, windows = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(places, pa.int64()), pa.array(parts, pa.binary()).cast(pa.string()),
                                                  pa.array(windows, pa.int64())], names=["item_id", "place", "part", "windows"])

    return (benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
            .mapInArrow(cut, "item_id string, place long, part string, windows long"))


def segment_blocks(segments: DataFrame, block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES):
    """Frames of (item_id, part), each of about ``block_windows`` windows and
    ``block_bytes`` bytes at most, together all segments."""
    size = segments.agg(F.sum("windows").alias("windows"), F.sum(F.octet_length("part")).alias("bytes")).first()
    n = max(-(-(size.windows or 0) // block_windows), -(-(size.bytes or 0) // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "place", "part"), F.lit(n))
    return [segments.where(block == i).select("item_id", "part") for i in range(n)]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   block_windows: int = BLOCK_WINDOWS, segment: int = SEGMENT) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``hits`` (disjoint [start, stop) word intervals
    inside occurrences) and ``items`` (sorted ids as text) to every row."""
    own = ["n_words", "n_hit", "hits", "items"]
    out = docs.select(*[c for c in docs.columns if c not in own])
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    names = out.columns
    out = out.withColumns({"n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"),
                           "hits": F.expr("cast(array() as array<array<int>>)"), "items": F.expr("cast(array() as array<string>)")})
    schema = f"{carried}, n_words long, n_hit long, hits array<array<int>>, items array<string>"
    spark = docs.sparkSession
    segments = stored(item_segments(benchmark, window, segment), "segments")
    blocks = segment_blocks(segments, block_windows) or [segments.select("item_id", "part")]
    for i, block in enumerate(blocks):
        held = spark.sparkContext.broadcast(block.toArrow().to_pydict())  # bounded, see segment_blocks

        def search(batches, held=held):
            parts = held.value
            engine = Search([(i, p.encode().split(b" ")) for i, p in zip(parts["item_id"], parts["part"], strict=True)], window)
            for batch in slices(batches, "text"):
                n_words, n_hit, hits, items = [], [], [], []
                for text, old, had in zip(text_bytes(batch.column("text")), batch.column("hits").to_pylist(),
                                          batch.column("items").to_pylist(), strict=True):
                    ws = words(text)
                    found, ids = engine.scan(ws)
                    merged = joined(found + [tuple(x) for x in old])
                    n_words.append(len(ws))
                    hits.append(merged)
                    n_hit.append(sum(b - a for a, b in merged))
                    items.append(sorted(ids.union(had), key=lambda x: (x is None, x)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array(hits, pa.list_(pa.list_(pa.int32()))), pa.array(items, pa.list_(pa.string()))],
                    names=[*names, *own])

        out = out.mapInArrow(search, schema)
        if i < len(blocks) - 1:
            out = stored(out, "searched")
    return out


def joined(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of intervals as disjoint ones."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def digest(items: F.Column) -> F.Column:
    """SHA-256 of the sorted ids joined by commas."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)
