"""N-gram Jaccard join with a token-group matrix.

A document's set holds the hashes (64 bits) of its distinct word shingles. Two
documents link when ``100 * |x & y| >= percent * |x | y|``; the result has each
document's component of links and its number of links.

1. Equal sets are one representative (its smallest id) with a weight.
2. Shingles have one global order: by hash, except that shingles which are
   frequent in a bounded sample come last. Prefixes are so long that linked sets
   share ``least_shared`` shingles in them, so only shingles that two prefixes
   share say anything, and a set with too few of them links with nothing.
3. Similar documents form groups: those whose smallest shared prefix shingle is
   the same. A large group is dealt to blocks of bounded size by a hash.
4. The matrix holds which prefix shingle occurs in which block, with the block's
   range of set sizes. Blocks that meet in enough shingles with fitting sizes
   are a pair; documents are never paired here.
5. For a pair of blocks, the overlap of each document with the other block's
   token union bounds its similarity to every member; the documents that can
   still qualify open the pair and are compared exactly, as a product of bounded
   0/1 matrices. Each task returns a spanning star of its links, not the links.
6. Stars are joined to components by alternating large-star and small-star steps.

Defined results: null and empty texts have the empty set and link with nothing;
a text of fewer words than a shingle is one shingle. A null id has a null
component. Rows with one id and equal texts are one document; ids are expected
to name one text. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import Memo, bounded_sample, slices, stored, text_bytes

SIZE, PERCENT = 4, 85
SAMPLE_DOCS, MOST_FREQUENT = 4000, 1 << 19
BLOCK_DOCS, BLOCK_SHINGLES = 256, 200_000
COLUMNS = 4096
PIECE_BYTES = 2 << 20  # of text whose sets a task holds at a time

# Prefixes are longer than one common shingle needs, so that links have one in
# SHARED_EVERY of a set's shingles in common there: passages that many documents
# hold do not bring them together.
SHARED_EVERY = 16
MEMBER_BUCKETS = 1 << 20

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9], np.uint64)


def least_shared(n: int) -> int:
    return max(1, n // SHARED_EVERY)


def shared_least(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / SHARED_EVERY))


def mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(31))) * MULTIPLIERS[2]
    return v ^ (v >> np.uint64(29))


class Shingles:
    """Sorted distinct shingle hashes of texts; word hashes are kept per worker."""

    def __init__(self, size: int = SIZE, keep: int = 100_000):
        self.size, self.codes = size, Memo(xxhash.xxh3_64_intdigest, keep)

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: only A-Z and white space below 0x80 are concerned
        n, k = len(words), min(len(words), self.size)
        if not n:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.codes.__getitem__, words), np.uint64, n)
        v = h[:n - k + 1] + np.uint64(k)
        for i in range(1, k):
            v = mixed(v) * MULTIPLIERS[0] + h[i:n - k + 1 + i] * MULTIPLIERS[1]
        return np.unique(mixed(v))


def frequent_shingles(docs: DataFrame, size: int = SIZE, sample_docs: int = SAMPLE_DOCS, most: int = MOST_FREQUENT) -> np.ndarray:
    """Shingles found in three documents or more of a bounded sample, ``most`` at
    most, the rarest first. They only set the order: any order gives the same links."""
    def count(batches):
        shingles = Shingles(size)
        for batch in slices(batches, "text", PIECE_BYTES):
            sets = [shingles(t) for t in text_bytes(batch.column("text"))]
            token, n = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"])

    sample = bounded_sample(docs.where(F.col("text").isNotNull()), ["doc_id", "text"], sample_docs).select("text")
    got = (sample.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .where("n >= 3").orderBy(F.desc("n"), F.desc("token")).limit(most).select("token").toArrow())
    return got.column(0).to_numpy()[::-1].copy().view(np.uint64)


def sketches(docs: DataFrame, frequent: np.ndarray, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, digest of the set, its prefix in the global order)."""
    order = np.argsort(frequent, kind="stable")
    held = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def sketch(batches):
        shingles, (known, rank) = Shingles(size), held.value
        for batch in slices(batches, "text", PIECE_BYTES):
            n, digest, prefix = [], [], []
            for t in text_bytes(batch.column("text")):
                v = shingles(t)
                n.append(len(v))
                digest.append(xxhash.xxh3_128_digest(v.tobytes()))
                # Sets of fewer shingles have no different set within reach.
                take = len(v) - -(-percent * len(v) // 100) + least_shared(len(v)) if len(v) * (100 - percent) >= percent else 0
                if take and len(known):
                    at = np.minimum(np.searchsorted(known, v), len(known) - 1)
                    often = known[at] == v
                    v = np.concatenate([v[~often], v[often][np.argsort(rank[at[often]])]])
                prefix.append(v[:take].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "n", "digest", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketch, "doc_id long, n long, digest binary, prefix array<long>")


def block_pairs(sketch: DataFrame, reps: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(members: rep, n, block) and (pairs: a, b) of blocks to open."""
    own = sketch.where(F.size("prefix") > 0).join(
        reps.select("rep", F.col("digest").alias("d")), (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("rep")))
    tokens = own.select("rep", F.explode("prefix").alias("token"))
    shared = stored(tokens.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("df > 1").drop("df"), "shared")
    # A set that shares fewer prefix shingles than any link needs is out.
    active = (shared.groupBy("rep").agg(F.min("token").alias("lead"), F.count(F.lit(1)).alias("k"))
              .join(reps.select("rep", "n"), "rep").where(F.col("k") >= shared_least(F.col("n"))))
    sizes = active.groupBy("lead").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts"))
    members = stored(active.join(sizes, "lead").select(
        "rep", "n", F.xxhash64("lead", F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("block")), "members")
    matrix = shared.join(members, "rep").groupBy("token", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = matrix.alias("a"), matrix.alias("b")
    fits = (F.col("a.high") * 100 >= F.col("b.low") * percent) & (F.col("b.high") * 100 >= F.col("a.low") * percent)
    met = (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.block") < F.col("b.block")) & fits)
           .groupBy(F.col("a.block").alias("a"), F.col("b.block").alias("b"))
           .agg(F.count(F.lit(1)).alias("k"), F.least(F.min("a.low"), F.min("b.low")).alias("low")))
    pairs = met.where(F.col("k") >= shared_least(F.col("low"))).select("a", "b")
    alone = members.groupBy("block").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("block").alias("a"), F.col("block").alias("b"))
    return members, stored(pairs.unionByName(alone), "pairs")


def compare(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs (i, j) of linked sets, i from a and j from b. The token unions come
    first: a set whose overlap with the other side's union is too small for any
    link is not opened."""
    na, nb = (np.array([len(s) for s in x]) for x in (a, b))
    token, inverse = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    cut = int(na.sum())
    row_a, row_b = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
    in_a, in_b = np.zeros(len(token), bool), np.zeros(len(token), bool)
    in_a[inverse[:cut]], in_b[inverse[cut:]] = True, True
    open_a = 100 * np.bincount(row_a, in_b[inverse[:cut]], len(a)) >= percent * na
    open_b = 100 * np.bincount(row_b, in_a[inverse[cut:]], len(b)) >= percent * nb
    ia, ib = np.flatnonzero(open_a), np.flatnonzero(open_b)
    if not len(ia) or not len(ib):
        return np.empty((0, 2), np.int64)
    both = np.flatnonzero(in_a & in_b)
    column = np.full(len(token), -1)
    column[both] = np.arange(len(both))
    place_a, place_b = np.cumsum(open_a) - 1, np.cumsum(open_b) - 1
    ca, cb = column[inverse[:cut]], column[inverse[cut:]]
    use_a, use_b = open_a[row_a] & (ca >= 0), open_b[row_b] & (cb >= 0)
    ca, ra, cb, rb = ca[use_a], place_a[row_a[use_a]], cb[use_b], place_b[row_b[use_b]]
    shared = np.zeros((len(ia), len(ib)), np.float32)
    for start in range(0, len(both), COLUMNS):
        ma, mb = np.zeros((len(ia), COLUMNS), np.float32), np.zeros((len(ib), COLUMNS), np.float32)
        sa, sb = (ca >= start) & (ca < start + COLUMNS), (cb >= start) & (cb < start + COLUMNS)
        ma[ra[sa], ca[sa] - start], mb[rb[sb], cb[sb] - start] = 1, 1
        shared += ma @ mb.T
    same = shared.astype(np.int64)
    i, j = np.nonzero(100 * same >= percent * (na[ia][:, None] + nb[ib][None, :] - same))
    return np.stack([ia[i], ib[j]], axis=1)


def stars(ids: list[int], links: np.ndarray) -> dict[int, int]:
    """Position -> position of the smallest id of its component."""
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in links.tolist():
        p, q = find(i), find(j)
        if p != q:
            if ids[p] > ids[q]:
                p, q = q, p
            root[q] = p
    return {i: find(i) for i in set(links.ravel().tolist())}


def open_pairs(docs: DataFrame, members: DataFrame, pairs: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """(rep, root, links): the stars of the links in every pair of blocks."""
    def load(batches):
        shingles = Shingles(size)
        for batch in slices(batches, "text", PIECE_BYTES):
            sets = [shingles(t) for t in text_bytes(batch.column("text"))]
            own = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, batch.column("digest").to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("weight"), batch.column("block"),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "weight", "block", "tokens"])
            yield out.filter(pa.array(own))

    # Hash buckets that hold a member, a bitmap of fixed size: most texts of other
    # documents are left out before the join by id decides.
    bucket = F.pmod(F.xxhash64("rep"), F.lit(MEMBER_BUCKETS)).cast("int")
    taken = members.select(bucket.alias("bucket")).distinct().toArrow().column(0).to_numpy()
    bitmap = np.zeros(MEMBER_BUCKETS, bool)
    bitmap[taken] = True
    held = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def perhaps(batches):
        own = np.unpackbits(held.value).astype(bool)
        for batch in batches:
            keep = own[batch.column("bucket").to_numpy(zero_copy_only=False)]
            yield batch.filter(pa.array(keep)).select(["rep", "text"])

    candidates = (docs.select(F.col("doc_id").cast("long").alias("rep"), "text").where(F.col("rep").isNotNull())
                  .withColumn("bucket", bucket).mapInArrow(perhaps, "rep long, text string"))
    wanted = members.select("rep", "block").join(reps.select("rep", "weight", "digest"), "rep")
    texts = candidates.join(wanted, "rep")
    sets = stored(texts.select("rep", "weight", "block", "digest", "text").mapInArrow(load, "rep long, weight long, block long, tokens binary"), "sets")
    sides = pairs.select("a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))).alias("block"))

    def link(key, rows):
        a, b = (k.as_py() for k in key)
        places = rows.column("rep").to_pylist()
        rows = rows.take(pa.array(sorted({r: i for i, r in enumerate(places)}.values()), pa.int64()))  # repeated rows once
        ids, weight, block = (rows.column(c).to_pylist() for c in ("rep", "weight", "block"))
        sets = [np.frombuffer(t, np.uint64) for t in rows.column("tokens").to_pylist()]
        left = [i for i, x in enumerate(block) if x == a]
        right = left if a == b else [i for i, x in enumerate(block) if x == b]
        found = compare([sets[i] for i in left], [sets[j] for j in right], percent) if left and right else np.empty((0, 2), np.int64)
        links = np.stack([np.array(left, np.int64)[found[:, 0]], np.array(right, np.int64)[found[:, 1]]], axis=1)
        links = links[links[:, 0] < links[:, 1]] if a == b else links
        w = np.array(weight, np.int64)
        count = np.bincount(links[:, 0], w[links[:, 1]], len(ids)) + np.bincount(links[:, 1], w[links[:, 0]], len(ids))
        star = stars(ids, links)
        return pa.table({"rep": pa.array([ids[i] for i in star], pa.int64()), "root": pa.array([ids[r] for r in star.values()], pa.int64()),
                         "links": pa.array([int(count[i]) for i in star], pa.int64())})

    return (sides.join(sets, "block").groupBy("a", "b").applyInArrow(link, "rep long, root long, links long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (u, v): large-star and small-star in
    turn, each round a table in the shared folder, until nothing changes."""
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), mark).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        near = large.join(least, F.col("u") == F.col("c"))
        small = near.select("u", F.col("m").alias("v")).unionByName(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")


def similar_groups(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row."""
    docs = docs.select("doc_id", "text")
    sketch = stored(sketches(docs, frequent_shingles(docs, size), size, percent), "sketch")
    same = sketch.where("n > 0 and doc_id is not null").groupBy("digest", "n")
    reps = stored(same.agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight")), "reps")
    members, pairs = block_pairs(sketch, reps, percent)
    found = stored(open_pairs(docs, members, pairs, reps, size, percent), "stars")
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = found.groupBy(F.col("rep").alias("linked")).agg(F.sum("links").alias("links"))
    classes = (reps.select("digest", "rep", "weight")
               .join(roots, F.col("rep") == F.col("node"), "left").join(links, F.col("rep") == F.col("linked"), "left")
               .select(F.col("digest").alias("d"), F.coalesce("root", "rep").alias("root"),
                       (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")))
    named = F.col("doc_id").isNotNull()
    return sketch.join(classes, sketch.digest == classes.d, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(named, F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id"))).alias("component_id"),
        F.when(named & (F.col("n") > 0), F.col("links")).otherwise(0).cast("long").alias("n_links"))
