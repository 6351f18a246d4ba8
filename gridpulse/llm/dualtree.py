"""Ranked lexical search with two trees, one over items and one over documents.

Every (term, document) has a contribution, computed in whole numbers from the
statistics of all documents; the score of a document for an item is the sum of
contributions over the item's terms, repeats included. The search:

* The items' terms are numbered and broadcast in blocks of at most about
  ``BLOCK_TERMS`` (item, term) pairs, cut between items, so that more items mean
  more passes and not more memory.
* One pass over the texts writes the term counts of every document, restricted
  to the block's terms; document frequencies and lengths are sums over it.
* Items are ordered by recursive bisection along the main direction of their
  term vectors, documents of a batch by their strongest term. Nodes of both
  trees hold the coordinate maxima of what is below them. The product of two
  nodes' maxima bounds the score of every pair below, and a pair of nodes whose
  bound is below the weakest tenth-best score of the node's items is left out
  with all that it holds. Left-out pairs cannot be among the results, so the
  search is exact.
* Tenth-best scores over a bounded sample of documents are lower bounds of the
  final ones; every task starts with them and raises them on its own rows. Its
  best rows are merged in two steps of ranked windows.

Sums are kept in float64 as long as no sum can reach 2 ** 53, else in int64.

Defined results: null and empty texts have no terms and are in no result and no
count. Rows of one item id are one item with the terms of all; a null id is an id
of its own. Every row of the documents is a document; of equal scores the smaller
id comes first, a null id last. Extra columns are ignored; empty tables give an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import bounded_sample, slices, stored, text_bytes
from gridpulse.llm.wumanber import words

TOP = 10
BLOCK_TERMS = 1 << 18
SAMPLE_DOCS = 20_000
DOC_LEAF, DOC_BRANCH = 4, 8  # documents below a leaf node, leaf nodes below an inner one
ITEM_LEAF, ITEM_BRANCH = 8, 32  # the same of items
BATCH_DOCS, BATCH_CELLS = 1024, 1 << 22
SALTS = 64
SHARE, UNIT, SCALE = 75, 1_000_000_000, 1000  # length share in percent, units of a contribution, scale of a weight


def terms_of(df: DataFrame, key: str) -> DataFrame:
    """(key, word, n): words of every text with their counts."""
    def count(batches):
        for batch in slices(batches, "text"):
            lists = [words(t) for t in text_bytes(batch.column("text"))]
            at = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            yield pa.RecordBatch.from_arrays([batch.column("k").take(at), pa.array(list(chain.from_iterable(lists)), pa.binary())], names=["k", "word"])

    kind = df.schema[key].dataType.simpleString()
    return (df.select(F.col(key).alias("k"), "text").mapInArrow(count, f"k {kind}, word binary")
            .groupBy("k", "word").agg(F.count(F.lit(1)).alias("n")))


def item_blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[pa.Table]:
    """Tables (k, word, n) of the terms of some items each, whole items dealt by
    a hash of the id."""
    terms = stored(terms_of(items, "item_id"), "item-terms")
    blocks = max(1, math.ceil(terms.count() / block_terms))
    for b in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == b).toArrow()
        if part.num_rows:
            yield part.sort_by([("k", "ascending"), ("word", "ascending")])


def bisected(row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, leaf: int = ITEM_LEAF) -> np.ndarray:
    """An order of the rows of a sparse matrix in which similar rows are near:
    halves by the projection on the main direction, found by power iteration."""
    terms = int(term.max(initial=-1)) + 1
    start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    by_row = np.argsort(row, kind="stable")
    term, value = term[by_row], value[by_row].astype(float)

    def split(rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= leaf:
            return [rows]
        size = start[rows + 1] - start[rows]
        at = np.repeat(start[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        r, t, v = np.repeat(np.arange(len(rows)), size), term[at], value[at]
        direction = 1 + np.cos(np.arange(terms))
        for _ in range(6):
            along = np.bincount(r, v * direction[t], len(rows))
            along = along - along.mean()
            direction = np.bincount(t, v * along[r], terms)
            direction = direction / max(1e-300, np.linalg.norm(direction))
        half = math.ceil(len(rows) / 2 / leaf) * leaf
        order = rows[np.argsort(along, kind="stable")]
        return split(order[:half]) + split(order[half:])

    return np.concatenate(split(np.arange(n)))


class ItemTree:
    """The items of a block in tree order as a sparse matrix of repeats."""

    def __init__(self, block: pa.Table):
        ids, words_ = block.column("k").combine_chunks().dictionary_encode(null_encoding="encode"), block.column("word").combine_chunks().dictionary_encode()
        row, term, n = ids.indices.to_numpy(), words_.indices.to_numpy(), block.column("n").to_numpy()
        order = bisected(row, term, 1 / np.sqrt(np.bincount(term)[term]), len(ids.dictionary))
        self.ids = ids.dictionary.take(pa.array(order))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row = place[row]
        # Terms are numbered along the items, so that terms of similar items are near.
        by_items = np.argsort(np.bincount(term, row) / np.bincount(term), kind="stable")
        number = np.empty(len(by_items), np.int64)
        number[by_items] = np.arange(len(by_items))
        self.vocabulary = dict(zip(words_.dictionary.to_pylist(), number.tolist(), strict=True))
        by_row = np.argsort(row, kind="stable")
        self.row, self.term, self.n = row[by_row], number[term][by_row], n[by_row]
        self.size = len(order)

    def weighted(self, weight: np.ndarray) -> None:
        """Sets the weights of the terms; the number type in which sums are exact."""
        self.weight = weight
        most = np.bincount(self.row, self.n * (weight[self.term] + 1.0) * (UNIT // SCALE), self.size).max(initial=0)
        self.kind = np.float64 if most < 2.0 ** 52 else np.int64

    def parts(self) -> dict:
        """What a search needs, as plain arrays."""
        return {k: getattr(self, k) for k in ("row", "term", "n", "size", "weight", "kind")}

    @classmethod
    def of(cls, parts: dict) -> ItemTree:
        tree = cls.__new__(cls)
        tree.__dict__.update(parts)
        return tree

    def branches(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first item, end, row, term, n) of the inner nodes."""
        for a in range(0, self.size, ITEM_LEAF * ITEM_BRANCH):
            lo, hi = np.searchsorted(self.row, [a, a + ITEM_LEAF * ITEM_BRANCH])
            yield a, min(self.size, a + ITEM_LEAF * ITEM_BRANCH), self.row[lo:hi] - a, self.term[lo:hi], self.n[lo:hi]


def maxima(rows: np.ndarray, fan: int) -> np.ndarray:
    """Coordinate maxima of every ``fan`` rows; what lacks counts as zero."""
    short = -len(rows) % fan
    if short:
        rows = np.concatenate([rows, np.zeros((short, rows.shape[1]), rows.dtype)])
    return rows.reshape(-1, fan, rows.shape[1]).max(1)


class Search:
    """Best rows of every item over the batches that :meth:`add` is given."""

    def __init__(self, tree: ItemTree, least: np.ndarray, top: int):
        self.tree, self.least, self.top = tree, least.copy(), top  # least: the score that a row needs
        self.best: list[list[tuple]] = [[] for _ in range(tree.size)]
        self.branches = list(tree.branches())
        self.pairs = self.opened = 0

    def add(self, ids: list, doc: np.ndarray, term: np.ndarray, gain: np.ndarray) -> None:
        """``gain``: contributions of (doc, term); ``doc`` ascends from 0."""
        columns, at = np.unique(term, return_inverse=True)
        if len(ids) > DOC_LEAF and len(ids) * len(columns) > BATCH_CELLS:
            half = len(ids) // 2
            cut = np.searchsorted(doc, half)
            self.add(ids[:half], doc[:cut], term[:cut], gain[:cut])
            self.add(ids[half:], doc[cut:] - half, term[cut:], gain[cut:])
            return
        # Documents in the order of their strongest terms.
        strongest = np.full(len(ids), -1)
        by_gain = np.argsort(gain, kind="stable")
        strongest[doc[by_gain]] = at[by_gain]
        order = np.argsort(strongest, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        rows = np.zeros((len(ids), len(columns)), self.tree.kind)
        rows[place[doc], at] = gain
        leaves = maxima(rows, DOC_LEAF)
        inner = maxima(leaves, DOC_BRANCH)
        self.pairs += len(ids) * self.tree.size
        for first, end, row, t, n in self.branches:
            spot = np.searchsorted(columns, t)
            known = spot < len(columns)
            known[known] = columns[spot[known]] == t[known]
            used, col = np.unique(spot[known], return_inverse=True)
            if not len(used):
                continue
            items = np.zeros((end - first, len(used)), self.tree.kind)
            items[row[known], col] = n[known]
            whole = len(used) == len(columns)
            self._descend(ids, order, *((x if whole else x[:, used]) for x in (rows, leaves, inner)), items, first)

    def _descend(self, ids, order, rows, leaves, inner, items, first) -> None:
        need = self.least[first:first + len(items)]
        item_leaves = maxima(items, ITEM_LEAF)
        weakest = np.array([need[a:a + ITEM_LEAF].min() for a in range(0, len(items), ITEM_LEAF)])
        nodes = np.flatnonzero(inner @ item_leaves.max(0) >= weakest.min())
        for node in nodes:
            a = node * DOC_BRANCH
            below = leaves[a:a + DOC_BRANCH]
            open_leaves = below @ item_leaves.T >= weakest  # document leaves x item leaves
            if not open_leaves.any():
                continue
            some = np.flatnonzero(np.repeat(open_leaves.any(0), ITEM_LEAF)[:len(items)])
            pairs = below @ items[some].T >= self.least[first + some]
            pairs &= open_leaves[:, some // ITEM_LEAF]
            some_docs = np.flatnonzero(pairs.any(1))
            some_items = np.flatnonzero(pairs.any(0))
            if not len(some_docs):
                continue
            at = ((a + some_docs)[:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
            at = at[at < len(rows)]
            item = first + some[some_items]
            scores = rows[at] @ items[some[some_items]].T
            self.opened += scores.size
            scores[(scores < self.least[item]) | ~pairs[(at // DOC_LEAF - a)[:, None], some_items]] = 0
            for k in np.flatnonzero(scores.any(0)):
                self._keep(item[k], [(int(scores[d, k]), ids[order[at[d]]]) for d in np.flatnonzero(scores[:, k])])

    def _keep(self, item: int, found: list[tuple]) -> None:
        best = sorted(self.best[item] + found, key=lambda x: (-x[0], x[1] is None, x[1]))[:self.top]
        self.best[item] = best
        if len(best) == self.top:
            self.least[item] = max(self.least[item], best[-1][0])

    def batch(self) -> pa.RecordBatch:
        rows = [(i, s, d) for i, best in enumerate(self.best) for s, d in best]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.int64())], names=["item", "score", "doc_id"])


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document: all its terms with repeats,
    and the numbers and counts of those in the vocabulary."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches):
        known = held.value
        for batch in slices(batches, "text"):
            lists = [words(t) for t in text_bytes(batch.column("text"))]
            sizes = np.array([len(x) for x in lists])
            numbers = np.fromiter((known.get(w, -1) for w in chain.from_iterable(lists)), np.int64, int(sizes.sum()))
            doc = np.repeat(np.arange(len(lists)), sizes)[numbers >= 0]
            cells, counts = np.unique(doc * max(1, len(known)) + numbers[numbers >= 0], return_counts=True)
            offsets = pa.array(np.searchsorted(cells // max(1, len(known)), np.arange(len(lists) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(cells % max(1, len(known)), pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(read, "doc_id long, n long, terms array<int>, counts array<long>")


def contributions(n: np.ndarray, doc: np.ndarray, counts: np.ndarray, weights: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Of every (document, term): the weight times the damped count."""
    if len(n) and SHARE * int(n.max()) * documents < 2 ** 62:
        m = 100 - SHARE + (SHARE * n * documents) // length
    else:
        m = np.array([100 - SHARE + SHARE * int(x) * documents // length for x in n], np.int64)
    return weights * ((UNIT * counts) // (SCALE * counts + 8 * m[doc]))


def best_rows(found: DataFrame, tree: ItemTree, least: np.ndarray, stats: tuple[int, int], top: int) -> DataFrame:
    """(item, score, doc_id): the best rows of every item, merged over all tasks."""
    held = found.sparkSession.sparkContext.broadcast((tree.parts(), least, *stats))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, least, documents, length = held.value
        tree = ItemTree.of(parts)
        search = Search(tree, least, top)
        for whole in batches:
            for a in range(0, whole.num_rows, BATCH_DOCS):
                batch = whole.slice(a, BATCH_DOCS)
                terms, counts = batch.column("terms"), batch.column("counts").flatten().to_numpy()
                size = pa.compute.list_value_length(terms).to_numpy()
                doc, term = np.repeat(np.arange(batch.num_rows), size), terms.flatten().to_numpy()
                if len(term):
                    gain = contributions(batch.column("n").to_numpy(), doc, counts, tree.weight[term], documents, length)
                    search.add(batch.column("doc_id").to_pylist(), doc, term, gain)
        yield search.batch()

    rows = found.mapInArrow(search, "item int, score long, doc_id long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= top).select("item", "rank", "doc_id", "score"))


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, sample_docs: int = SAMPLE_DOCS,
                   block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents with a score
    above 0 for every item."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for block in item_blocks(items, block_terms):
        tree = ItemTree(block)
        found = stored(vectors(docs, tree.vocabulary), "vectors")
        documents, length = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        counted = found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow()  # a row a term of the block
        df = np.zeros(len(tree.vocabulary), np.int64)
        df[counted.column("t").to_numpy()] = counted.column("df").to_numpy()
        tree.weighted(np.array([math.floor(SCALE * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64))
        stats = (documents, max(1, length))
        some = found.where(F.size("terms") > 0)
        sample = bounded_sample(some, ["doc_id", "n"], sample_docs)
        least = np.ones(tree.size, np.int64)
        first = best_rows(sample, tree, least, stats, top).where(F.col("rank") == top).select("item", "score").toArrow()  # at most a row an item
        least[first.column("item").to_numpy()] = np.maximum(1, first.column("score").to_numpy())
        ranked = stored(best_rows(some, tree, least, stats, top), "ranked")
        names = spark.createDataFrame(pa.table({"item": np.arange(tree.size, dtype=np.int32), "item_id": tree.ids}))
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
    return out
