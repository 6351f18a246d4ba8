"""WARC archives and their global capture index.

* :func:`write_archives` writes one WARC/1.1 record per page with Spark's text
  writer. Equal payloads of at least ``min_bytes`` are stored once: the capture
  with the smallest page id is a ``response``, every other one a ``revisit``
  that carries length and digest of the full payload in its header.
* :func:`read_archives` reads the archives back (framed by Content-Length) and
  returns one row per record with its file, offset and payload.
* :func:`capture_runs` writes each archive's index entries as a locally sorted
  run.
* :func:`merge_runs` merges the runs externally: entries are cut at quantiles
  of the full sort key (URL key, capture time, page id), so that one hot host
  or URL is spread over many ranges, and each range merges its slices of the
  k runs with a loser tree.

Defined results: a null html is an empty payload; a null url has the empty URL
key; rows with a null page id get a record too and sort last. Repeated rows
are records of their own; of repeated rows with one page id and one payload all
are responses if that id is the smallest. An empty table gives no archive and
an empty index. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import shared_path, stored

EPOCH = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
RECORDS_PER_ARCHIVE = 500

ENTRY = ("urlkey string, capture_time string, page_id long, record_type string, refers_to long, "
         "payload_bytes long, payload_digest string, archive string, record_offset long, record_length long, "
         "url string")


def url_key(url: F.Column) -> F.Column:
    """Sort-friendly URL key: lower-cased host labels in reverse, then the path
    and query without the fragment."""
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1))
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    return F.when(url == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def capture_time(page_id: F.Column) -> F.Column:
    """Capture time of a page table that has none: ids are seconds after 2024."""
    return F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce(page_id, F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")


def with_revisits(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Adds payload, its length and digest, and the page that holds the payload.

    Only (digest, smallest id) of repeated payloads is joined back; the plain
    equality join lets Spark split a digest that holds many rows."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"))
    first = (rows.where(F.col("payload_bytes") >= min_bytes)
             .groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("payload_digest").alias("d"), "first_id"))
    joined = rows.join(first, rows.payload_digest == first.d, "left").drop("d")
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return (joined.withColumn("refers_to", refers)
            .withColumn("record_type", F.when(refers.isNull(), "response").otherwise("revisit")).drop("first_id"))


def one_line(value: F.Column) -> F.Column:
    """Header value: control characters cannot break the header apart."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1f\x7f]", " ")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 100,
                   records_per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    """Write the archives (gzip files of WARC/1.1 records) to a shared folder."""
    r = with_revisits(pages, min_bytes)
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise("")
    uid = F.regexp_replace(F.md5(F.concat_ws(":", F.col("page_id").cast("string"), "url", "payload_digest")),
                           "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    refers = F.when(F.col("refers_to").isNotNull(), F.concat(
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nX-Refers-To-Id: "),
        F.col("refers_to").cast("string"), F.lit("\r\n"))).otherwise("")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: <urn:uuid:"), uid,
        F.lit(">\r\nWARC-Date: "), capture_time(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), one_line(F.col("url")),
        F.lit("\r\nX-Url-Key: "), one_line(url_key(F.col("url"))),
        F.lit("\r\nX-Page-Id: "), ident,
        F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"), F.lit("\r\n"), refers,
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit(END), body)
    (r.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_archive).text(path))


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an unpacked archive."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = head_end + 4
        stop = start + int(headers["Content-Length"])
        yield at, stop + 4 - at, headers, data[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record; files are small by construction, so each is read
    whole by Spark's binary reader, wherever the folder lies."""
    import hashlib

    schema = ENTRY + (", payload string" if with_payload else "")

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                out: list[tuple] = []
                for at, length, h, block in records(gzip.decompress(content.as_buffer())):
                    page = h["X-Page-Id"]
                    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if h["WARC-Type"] == "response" and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"damaged record at byte {at} of {name}")
                    refers = h.get("X-Refers-To-Id")
                    row = (h["X-Url-Key"], h["WARC-Date"], None if page == "-" else int(page), h["WARC-Type"],
                           None if refers is None else int(refers), int(h["X-Payload-Length"]), digest,
                           name.rsplit("/", 1)[-1], at, length, h["WARC-Target-URI"])
                    out.append((*row, block.decode("utf-8")) if with_payload else row)
                yield from arrow_rows(out, with_payload)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
             .load(path).select("path", "content"))
    return files.mapInArrow(parse, schema)


def arrow_schema(with_payload: bool = False) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [tuple(x.split()) for x in ENTRY.split(", ")] + ([("payload", "string")] if with_payload else [])
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def arrow_rows(rows: list[tuple], with_payload: bool = False) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(with_payload)
    for i in range(0, len(rows), 4096):
        part = list(zip(*rows[i:i + 4096], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(part, schema, strict=True)], schema=schema)


def sort_key(row: tuple) -> tuple:
    """(URL key, capture time, page id, null id last, archive, offset)."""
    return row[0], row[1], row[2] is None, row[2] or 0, row[7], row[8]


def capture_runs(entries: DataFrame) -> DataFrame:
    """The index entries as locally sorted runs, one per archive, stored as a
    table in the shared folder."""
    return stored(entries.sortWithinPartitions("archive", "urlkey", "capture_time",
                                               F.col("page_id").asc_nulls_last(), "record_offset"), "runs")


class LoserTree:
    """k-way merge: inner nodes hold the loser of the match played there, the
    overall winner sits at the root, and taking it replays one leaf's path."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else sort_key(h) for h in self.heads]
        self.losers = [-1] * max(1, self.k)
        self.winner = -1
        for leaf in range(self.k):
            self._enter(leaf)

    def _beats(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def _enter(self, leaf: int) -> None:
        """First match of a leaf: it waits at the first free node on its way."""
        node, player = (leaf + self.k) // 2, leaf
        while node >= 1:
            other = self.losers[node]
            if other == -1:
                self.losers[node] = player
                return
            if self._beats(other, player):
                self.losers[node], player = player, other
            node //= 2
        self.winner = player

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.keys[self.winner] is not None:
            leaf = self.winner
            yield self.heads[leaf]
            self.heads[leaf] = next(self.runs[leaf], None)
            self.keys[leaf] = None if self.heads[leaf] is None else sort_key(self.heads[leaf])
            node, player = (leaf + self.k) // 2, leaf
            while node >= 1:
                if self._beats(self.losers[node], player):
                    self.losers[node], player = player, self.losers[node]
                node //= 2
            self.winner = player


def merge_runs(runs: DataFrame) -> DataFrame:
    """All entries in global order of (URL key, time, id), with ``position``.

    The range exchange cuts the runs at sampled quantiles of the full key; a
    range holds a bounded number of entries (the session's shuffle partitions).
    Inside it the slices come in run order and go through the loser tree."""
    key = ["urlkey", "capture_time", F.col("page_id").asc_nulls_last(), "archive", "record_offset"]
    dealt = runs.repartitionByRange(*key).sortWithinPartitions(
        "archive", "urlkey", "capture_time", F.col("page_id").asc_nulls_last(), "record_offset")

    def merge(batches):
        range_id = TaskContext.get().partitionId()
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slices.setdefault(row[7], []).append(row)
        done, schema = [], arrow_schema().append(pa.field("range_id", pa.int32())).append(pa.field("at", pa.int64()))
        for at, row in enumerate(LoserTree(list(slices.values()))):
            done.append((*row, range_id, at))
            if len(done) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)

    merged = stored(dealt.mapInArrow(merge, ENTRY + ", range_id int, at long"), "merged")
    # One row per range: the running total of their sizes.
    earlier = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    before = (merged.groupBy("range_id").agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("range_id").alias("r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    return (merged.join(F.broadcast(before), merged.range_id == before.r)
            .withColumn("position", F.col("before") + F.col("at")).drop("r", "before", "at", "range_id"))


def capture_index(pages: DataFrame, min_bytes: int = 100,
                  records_per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """Write the pages as archives, read them back, and merge their runs."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path, min_bytes, records_per_archive)
    return merge_runs(capture_runs(read_archives(spark, path)))
