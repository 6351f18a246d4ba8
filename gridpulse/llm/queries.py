"""The registered queries of this subpackage, one for each operator.

Each callable takes ``(spark, sf_dir)`` and runs its operator with production
parameters over the whole table; digest columns are derived from the operator's
own result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import (backoff, blocklabels, dualtree, langid, nbsvm, packing, periodic, quotient, spotsigs, tokengroups, toxicgrammar, warc,
                           wumanber)
from gridpulse.llm.common import fold_is, table


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written, read back and merged into one capture index."""
    index = warc.capture_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "urlkey", "capture_time", "position")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learned outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.fit_quality(docs, table(spark, sf_dir, "labels"))
    return nbsvm.score_quality(docs, model).select(
        "doc_id", fold_is("doc_id", nbsvm.FOLDS, nbsvm.HELD).alias("held_out"),
        F.col("quality_score").alias("score"), F.col("quality_pred").alias("predicted"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wumanber.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        wumanber.digest(F.col("items")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff log score of every document under the whole corpus."""
    scored = backoff.score_documents(table(spark, sf_dir, "documents"))
    # Sums of floating-point numbers depend on their order in the last digits.
    return scored.select("doc_id", "n_tokens", F.round("score", 3).alias("score"),
                         F.round(F.try_divide("score", "n_tokens"), 6).alias("mean_log_score"))  # null without words


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and link counts of the Jaccard join on word shingles."""
    return tokengroups.similar_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def op6_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicgrammar.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicgrammar.score_toxicity(docs, model).select(
        "doc_id", fold_is("doc_id", toxicgrammar.FOLDS, toxicgrammar.HELD).alias("held_out"),
        F.col("toxic_score").alias("score"), F.col("toxic_pred").alias("predicted"),
        F.col("toxic_clauses").alias("matched_clauses"))


def op7_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = blocklabels.extract_main_text(pages, blocklabels.fit_labeller(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences of 4096."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned outside fold 1 of 3."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs.select("doc_id", "text", "lang"))
    return langid.predict_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", fold_is("doc_id", langid.FOLDS, langid.HELD).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which is edited to repeat itself."""
    found = periodic.find_runs(periodic.with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays of every group of equal texts."""
    return quotient.exact_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return dualtree.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_warc_index, op2_quality_classifier, op3_benchmark_decontamination, op4_stupid_backoff, op5_ngram_jaccard_join, op6_toxicity_grammar, op7_spot_signatures,
    op8_html_blocks, op9_packing, op10_language_id, op11_periodic_runs, op12_exact_dedup, op13_lexical_search)}
