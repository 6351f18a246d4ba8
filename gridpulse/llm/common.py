"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.session import ensure_checkpoint_dir

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


class Memo(dict):
    """Values of a function, kept for two generations of ``keep`` keys."""

    def __init__(self, function, keep: int):
        super().__init__()
        self.function, self.keep, self.old = function, keep, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a Parquet table in the shared folder and read it back:
    cuts the lineage in a way that survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Texts go to Python workers about ``most`` bytes at a time from now on, unless
    the session sets a limit of its own. By default a batch has 10,000 rows or 64 MB,
    often a whole partition, and an executor holds it outside its heap for each of its
    tasks, and the worker once more."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(most))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column without decoding; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of bounded text size (one row at least),
    so that long texts do not add up inside a Python worker."""
    for batch in batches:
        n, start = batch.num_rows, 0
        if n == 0:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        held = 0
        for i in range(n):
            held += sizes[i] or 0
            if held >= max_bytes or i == n - 1:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0


def fold_is(column: str, folds: int, fold: int) -> F.Column:
    """True where crc32 of the id, as text, leaves ``fold`` modulo ``folds``;
    a null id leaves 0 (crc32 of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == fold


def picked(df: DataFrame, columns: list[str], share: F.Column | int) -> DataFrame:
    """Rows whose hash of ``columns`` leaves less than ``share`` modulo 2 ** 30, with
    that hash as ``picked_by``; rows that are equal in the columns are one."""
    return (df.withColumn("picked_by", F.xxhash64(*[F.col(c).cast("string") for c in columns]))
            .where(F.pmod("picked_by", F.lit(1 << 30)) < share).dropDuplicates(["picked_by"]))


def bounded_sample(df: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """At most about ``limit`` rows, chosen by a hash of the columns, so that the
    choice does not depend on partitioning. All rows if there are fewer. The columns
    are the id and the content: rows of one id, or without one, are chosen one by
    one, and exact copies are chosen once."""
    n = df.count()
    if n <= limit:
        return df
    return picked(df, columns, int((1 << 30) * limit / n)).drop("picked_by")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, limit: int) -> DataFrame:
    """(doc_id, y, text) of at most about ``limit`` labelled rows outside the
    held fold, one row per id; rows with a null id, text or label are left out.
    The sampled labels, bounded by ``limit``, are the broadcast side."""
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~fold_is("doc_id", folds, held))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    marked = bounded_sample(marked, ["doc_id"], limit)
    return (docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(F.broadcast(marked), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "y", "text"))
