"""Document fingerprints of spot signatures, in DataFrame functions only.

A spot signature is a common word (the anchor) and the chain of the next
``CHAIN`` content words after it, looked for among the next ``REACH`` words.
Common words are the listed ones and every word of one or two letters. The
fingerprint of a text is its sorted set of signatures, eight hex digits each.
A text without anchors takes every word as one; a text without words is one
signature of its own; the empty text has the empty fingerprint.

Likeness of two fingerprints is the Jaccard similarity of their sets (two empty
ones: 1). :func:`near_pairs` finds all pairs of at least a threshold: equal
fingerprints are one row, fingerprints are partitioned by set length, only
neighbouring partitions and shared prefix signatures meet, and lengths that
cannot reach the threshold are pruned before the sets are compared.

Defined results: a null text is empty. Repeated rows are rows of their own, and
the next document of a row with an equal id is the other one (by text). A null
id sorts first. A single document is its own next. Extra columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN, REACH = 2, 6

# Fixed list: common words of English, German, French and Spanish.
ANCHORS = ["the", "and", "that", "for", "was", "with", "this", "are", "der", "die", "und", "den", "das", "von", "ist",
           "des", "mit", "ein", "les", "une", "que", "est", "pour", "dans", "los", "las", "del", "por", "una", "con"]
SPLIT = r"[^\p{L}\p{N}]+"
LOWEST = -(1 << 63)


def is_anchor(word: Column) -> Column:
    return word.isin(ANCHORS) | (F.length(word) <= 2)


def signatures(text: Column) -> Column:
    """Sorted distinct signatures of a text as eight hex digits each."""
    words = F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")
    return F.transform(F.array(words), _of_words(text))[0]


def _of_words(text: Column):
    def of(words: Column) -> Column:
        def chain(i: Column) -> Column:
            ahead = F.array(*[F.get(words, i + k) for k in range(1, REACH + 1)])
            after = F.filter(ahead, lambda w: w.isNotNull() & ~is_anchor(w))
            return F.concat_ws(":", F.get(words, i), F.slice(after, 1, CHAIN))

        def of_places(places: Column) -> Column:
            """Signatures at the anchors, or at every word of a text without."""
            return F.transform(F.array(F.filter(places, lambda i: is_anchor(F.get(words, i)))),
                               lambda spots: F.transform(F.when(F.size(spots) > 0, spots).otherwise(places), chain))[0]

        found = F.when(F.size(words) > 0, F.transform(F.array(F.sequence(F.lit(0), F.size(words) - 1)), of_places)[0]) \
            .when(text == "", F.array().cast("array<string>")).otherwise(F.array(text))
        return F.array_sort(F.array_distinct(F.transform(found, lambda s: F.substring(F.md5(s.cast("binary")), 1, 8))))

    return of


def fingerprint(marks: Column) -> Column:
    return F.array_join(marks, " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without comparing where the
    lengths alone keep it under ``least``."""
    both = F.size(F.array_intersect(a, b))
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return (F.when(long == 0, 1.0).when(short < long * least, 0.0)
            .otherwise(both / (F.size(a) + F.size(b) - both)).cast("double"))


def _bucket(value: Column, splits: list[int]) -> Column:
    """Number of splits that are at most the value, as a balanced decision tree."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < splits[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(splits))


def with_next_text(docs: DataFrame, rows_a_range: int = 500, most_ranges: int = 1024) -> DataFrame:
    """Adds ``next_text``: the text of the next document by ascending id, of the
    first after the last. Rows are dealt to ranges of the id with about equal
    counts (sampled quantiles); the first rows of a range also go to the range
    before it, so one window in each range is enough."""
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    shares = [i / most_ranges for i in range(1, most_ranges)]
    total, cuts = docs.agg(F.count(F.lit(1)), F.percentile_approx(key, shares, 10 * most_ranges)).first()
    every = most_ranges // max(4, min(most_ranges, 1 << (total // rows_a_range).bit_length()))
    splits = sorted(set((cuts or [])[every - 1::every]))
    ranged = docs.withColumn("range_id", _bucket(key, splits))
    # One row a range; every range but perhaps the first holds its own split.
    firsts = dict(ranged.groupBy("range_id").agg(F.min(key)).collect())
    lowest, highest = min(firsts, default=0), max(firsts, default=0)
    own = F.struct(F.col("range_id"), F.lit(0).alias("copy"))
    earlier = F.when(F.col("range_id") == lowest, highest).otherwise(F.col("range_id") - 1)
    copied = F.struct(earlier.cast("int").alias("range_id"), F.lit(1).alias("copy"))
    places = F.when(key.isin(list(firsts.values()) or [LOWEST]), F.array(own, copied)).otherwise(F.array(own))
    spread = ranged.withColumn("place", F.explode(places)).select(*docs.columns, "place.range_id", "place.copy")
    w = Window.partitionBy("range_id").orderBy("copy", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return (spread.withColumn("next_text", F.coalesce(F.lead(F.coalesce("text", F.lit(""))).over(w), F.lit("")))
            .where("copy = 0").drop("copy", "range_id"))


def edited(text: Column, other: Column) -> Column:
    """The text with its last floor(n/2) code points replaced by the first as
    many (or all) of the other text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and likenesses."""
    rows = with_next_text(docs.select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select("doc_id", text.alias("text"), "next_text").withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("changed"),
                       signatures(F.col("next_text")).alias("following"))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
                       fingerprint(F.col("changed")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                       likeness(F.col("own"), F.col("following")).alias("near_next"))


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """All pairs of different fingerprints with likeness >= threshold, named by
    the smallest ids that carry them: (a, b, likeness)."""
    sets = (docs.select("doc_id", signatures(F.coalesce(F.col("text"), F.lit(""))).alias("marks"))
            .groupBy("marks").agg(F.min("doc_id").alias("id")).where(F.size("marks") > 0))
    level = F.floor(F.log(F.size("marks").cast("double")) / -math.log(threshold) + 1e-9).cast("int")
    prefix = (F.size("marks") - F.ceil(F.size("marks") * threshold - 1e-9) + 1).cast("int")
    keyed = sets.select("id", "marks", level.alias("level"), F.explode(F.slice("marks", F.lit(1), prefix)).alias("mark"))
    left, right = keyed.alias("l"), keyed.withColumn("reach", F.explode(F.array(F.col("level") - 1, F.col("level")))).alias("r")
    meet = left.join(right, (F.col("l.mark") == F.col("r.mark")) & (F.col("l.level") == F.col("r.reach"))
                     & ((F.col("l.level") < F.col("r.level")) | (F.col("l.id") < F.col("r.id")))
                     & (F.least(F.size("l.marks"), F.size("r.marks")) >= threshold * F.greatest(F.size("l.marks"), F.size("r.marks"))))
    pairs = meet.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"),
                        likeness(F.col("l.marks"), F.col("r.marks"), threshold).alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold).distinct()
