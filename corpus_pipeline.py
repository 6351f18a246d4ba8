"""A corpus clean-up: documents in, packed token pieces out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import nbsvm, packing, tokengroups, toxicgrammar, wumanber
from gridpulse.llm.common import shared_path, small_batches, stored, table

SHINGLE, SIMILAR_PERCENT = 5, 80


def apart(docs: DataFrame) -> DataFrame:
    """The documents with every column but the id and the text under a name of its
    place, which no operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"pipeline_{i}") for i, c in enumerate(docs.columns)])


def together(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order and under their names."""
    return kept.select(*[F.col(c if c in ("doc_id", "text") else f"pipeline_{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the quality classifier rejects go.

    Rows are judged one by one by their text alone; a null text is judged as an empty
    one. All columns stay. No documents give none."""
    small_batches(spark)
    model = nbsvm.fit_quality(docs, table(spark, sf_dir, "labels"))
    return together(nbsvm.score_quality(apart(docs), model).where(F.col("quality_pred") == 1), docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the toxicity grammar rejects go.

    Rows are judged one by one by their text alone; a null or empty text has no
    clause and is judged like any text without a match. All columns stay. No
    documents give none."""
    small_batches(spark)
    model = toxicgrammar.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return together(toxicgrammar.score_toxicity(apart(docs), model).where(F.col("toxic_pred") == 0), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of documents with similar sets of five-word
    shingles (0.8 or more), the one with the smallest id stays (of rows with that id,
    one text by its hash; rows without an id come last). Groups are made of rows, not
    of ids, as an id may name several texts. Texts without words are in no group;
    repeated rows of them are one if they have an id. All columns stay."""
    small_batches(spark)
    rows = stored(apart(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = tokengroups.similar_groups(rows.select(F.col("row").alias("doc_id"), "text"), size=SHINGLE, percent=SIMILAR_PERCENT)
    groups = groups.select(F.col("doc_id").alias("at"), (F.col("n_shingles") == 0).alias("wordless"), "component_id")
    ids = rows.select("row", "doc_id", F.xxhash64("text").alias("hash")).join(groups, F.col("row") == F.col("at"))
    single, named = F.col("wordless"), F.col("doc_id").isNotNull()
    first = (ids.groupBy("wordless", F.when(~single | ~named, F.col("component_id")).alias("group"), F.when(single, F.col("doc_id")).alias("own"),
                         F.when(single, F.col("hash")).alias("same"))
             .agg(F.min(F.struct(~named, "doc_id", "hash", "row")).alias("first")))
    return together(rows.join(first.select("first.row"), "row", "left_semi"), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark window go.

    Rows are searched one by one; a null or empty text holds none and stays. All
    columns stay. An empty benchmark or no documents change nothing."""
    small_batches(spark)
    return together(wumanber.find_benchmark(apart(docs), table(spark, sf_dir, "benchmark")).where("n_hit = 0"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: what is left as token pieces in sequences of 4096, each told by its
    document, start, length and checksum (``packing.pack(with_ids=True)`` gives the
    ids themselves). A null text is the closing id alone; repeated rows are packed as
    often as they come. No documents give no pieces."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("pack", pack)]

# Learned models decide what stays, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table that the
    next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = shared_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
