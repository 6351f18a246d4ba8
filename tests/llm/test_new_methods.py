"""Periodic runs, quotient filters and dual-tree search against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gridpulse.llm import dualtree, periodic, quotient
from gridpulse.llm.queries import QUERIES
from gridpulse.llm.wumanber import words

DOCS = "doc_id long, text string"


# --- 11 ---

def brute_runs(t, least=24):
    """Every maximal stretch with some period of at least three periods, with
    the smallest period that gives it."""
    found = {}
    for p in range(1, len(t) // 3 + 1):
        i = 0
        while i + p < len(t):
            j = i
            while j + p < len(t) and t[j] == t[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 3 * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def random_texts(rng, words_=None):
    out = []
    for _ in range(rng.randint(1, 6)):
        n, k = rng.choice([0, 1, 5, 23, 24, 25, 60, 200, 500]), rng.choice([1, 2, 3, 50])
        t = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 2)):
            if n > 30:
                a = rng.randrange(n)
                p, end = rng.randint(1, max(1, (n - a) // 3)), rng.randint(a, n)
                for i in range(a, end):
                    t[i] = t[a + (i - a) % p]
        out.append(t)
    return out


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_texts(seed):
    texts = random_texts(random.Random(seed))
    for t, got in zip(texts, periodic.runs_of([np.array(t, np.int64) for t in texts]), strict=True):
        rows = [tuple(r) for r in got.tolist()]
        assert sorted(rows) == brute_runs(t)
        assert rows == sorted(rows, key=lambda r: (r[0], r[2]))


def test_the_cover_reaches_every_difference():
    differences = Counter((b - a) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER if a != b)
    assert differences == Counter(range(1, periodic.MODULUS))


@pytest.mark.parametrize("seed", range(8))
def test_longest_common_extensions(seed):
    rng = random.Random(seed)
    t = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.choice([2, 40, 700]))]
    t = np.array(t + t[: len(t) // 2] + [-1], np.int64)
    i, j = np.array([sorted(rng.sample(range(len(t)), 2)) for _ in range(300)]).T

    def brute(a, b):
        n = 0
        while b + n < len(t) and t[a + n] == t[b + n]:
            n += 1
        return n

    assert periodic.Extensions(t)(i, j).tolist() == [brute(a, b) for a, b in zip(i, j, strict=True)]


def test_many_pending_grid_points(monkeypatch):
    monkeypatch.setattr(periodic, "PENDING", 7)
    texts = random_texts(random.Random(5)) + [[0] * 300]
    got = periodic.runs_of([np.array(t, np.int64) for t in texts])
    assert [sorted(map(tuple, g.tolist())) for g in got] == [brute_runs(t) for t in texts]


def expected_op11(doc_id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    drop = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


def test_op11_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{x}" for t in random_texts(rng)[:2] for x in t)) for i in range(150)]
    rows += [(7, "é " * 30), (7, "a\tb\x0bc\x0c" * 12 + "  d"), (None, "x y " * 20), (None, None), (900, ""), (901, " \n "), (901, " \n ")]
    spark.createDataFrame(rows, DOCS + "").selectExpr("*", "1 as n_words", "'x' as runs").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected_op11(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 20


def test_runs_of_an_empty_table(spark):
    assert periodic.find_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_a_long_text_of_one_word():
    t = np.zeros(100_000, np.int64)
    assert periodic.runs_of([t])[0].tolist() == [[0, 100_000, 1]]


# --- 12 ---

@pytest.mark.parametrize("n", [0, 1, 2, 100, 5000])
def test_quotient_filter_gives_back_what_went_in(n):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, 1 << 40, n))
    values = np.unique(np.concatenate([values, values + 1, values[: n // 2] + (1 << 20)])) & ((1 << 40) - 1)
    values = np.unique(values)
    counts = rng.integers(1, 4, len(values))
    counts[: 3] = [2 ** 40, 300, 70_000][: len(counts)]
    f = quotient.QuotientFilter.from_bytes(quotient.QuotientFilter.of(values, counts, 40).to_bytes())
    got, times = f.items()
    assert got.tolist() == values.tolist() and times.tolist() == counts.tolist()
    assert len(f.slots) >= len(values) and f.run_end.sum() == f.occupied.sum()


def test_merge_loses_nothing():
    rng = random.Random(2)
    parts = [Counter(rng.randrange(500) for _ in range(rng.randint(0, 300))) for _ in range(7)]
    items = []
    for part in parts:
        keys = np.array(sorted(part), np.uint64)
        items.append(quotient.QuotientFilter.of(keys, np.array([part[int(k)] for k in keys], np.int64), 16).items())
    values, counts = quotient.merged(items)
    assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == dict(sum(parts, Counter()))
    assert quotient.merged([])[0].tolist() == []


def expected_copies(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    return Counter((d, max((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(t).digest())
                   for t, ids in groups.items() for d in ids)


@pytest.mark.parametrize("bits", [48, 27])
def test_exact_copies(spark, bits):
    rng = random.Random(bits)
    texts = [None, "", "A", "a", "É", "é", "a ", "x" * 5000, "X" * 5000] + [f"Text {rng.randrange(60)}" for _ in range(300)]
    rows = [(rng.choice([None, 5, rng.randrange(10 ** 6)]), t) for t in texts] + [(1000 + i, "hot") for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as row", "'y' as fp", "2 as kept", "3 as digest").repartition(9)
    got = quotient.exact_copies(docs, bits).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in got) == expected_copies(rows)
    kept = Counter(bytes(r.digest) for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({bytes(r.digest) for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_fingerprints_that_collide_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quotient, "fingerprint", lambda text, bits=0: len(text))
    rows = [(i, t) for i, t in enumerate(["ab", "AB", "cd", "ef", "ef", "g"])]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in quotient.exact_copies(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {0: (1, 2, False), 1: (1, 2, True), 2: (2, 1, True), 3: (4, 2, False), 4: (4, 2, True), 5: (5, 1, True)}


def test_exact_copies_of_an_empty_table(spark):
    assert quotient.exact_copies(spark.createDataFrame([], DOCS)).count() == 0


def test_hot_fingerprint_is_one_entry_a_partition(spark):
    marked = spark.range(0, 30_000, 1, 12).selectExpr("if(id % 3 = 0, 7L, id * 1048583) as fp")
    assert [tuple(r) for r in quotient.repeated_fingerprints(marked, 30_000).collect()] == [(7, 10_000)]


# --- 13 ---

def brute_rank(docs, items, top=10):
    bags = [(i, d, Counter(words((t or "").encode()))) for i, (d, t) in enumerate(docs)]
    bags = [(i, d, b, b.total()) for i, d, b in bags if b]
    n_docs, length = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, _, b, _ in bags for t in b)
    wanted = defaultdict(Counter)
    for item_id, text in items:
        wanted[item_id].update(words((text or "").encode()))
    out = set()
    for item_id, terms in wanted.items():
        scored = []
        for _, d, b, n in bags:
            m = 25 + (75 * n * n_docs) // length
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 8 * m))
                    for t, r in terms.items() if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out |= {(item_id, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])}
    return out


@pytest.fixture
def searched():
    rng = random.Random(11)
    vocabulary = [f"w{int(rng.paretovariate(.6))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 40, 200])))) for i in range(700)]
    docs += [(None, docs[5][1]), (5, docs[5][1]), (5, "w1 w2"), (9999, None), (9998, "... !"), (9997, "É w3 W3")]
    items = [(f"q{i}", " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 30])))) for i in range(90)]
    items += [("same", "w1 w1"), ("same", "w2"), (None, "w3"), ("none", None), ("blank", "  "), ("unseen", "zzz")]
    return docs, items


@pytest.mark.parametrize("sample,block", [(20_000, 1 << 18), (50, 200)])
def test_dual_tree_search_equals_brute_force(spark, searched, monkeypatch, sample, block):
    docs, items = searched
    if block < 1000:  # several blocks of items, small batches and inner nodes
        for name, value in (("BATCH_DOCS", 100), ("BATCH_CELLS", 5000), ("DOC_BRANCH", 2), ("ITEM_BRANCH", 2)):
            monkeypatch.setattr(dualtree, name, value)
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as n", "'t' as terms", "3 as score").repartition(5)
    i = spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "1 as k", "2 as item", "7 as rank")
    got = [tuple(r) for r in dualtree.rank_documents(d, i, sample_docs=sample, block_terms=block).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_rank(docs, items)


def test_whole_numbers_where_floats_would_round(spark, searched, monkeypatch):
    docs, items = searched
    weighted = dualtree.ItemTree.weighted
    monkeypatch.setattr(dualtree.ItemTree, "weighted", lambda self, w: (weighted(self, w), setattr(self, "kind", np.int64))[0])
    got = dualtree.rank_documents(spark.createDataFrame(docs[:120], DOCS), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert {tuple(r) for r in got} == brute_rank(docs[:120], items)


def test_pairs_of_nodes_are_left_out():
    """Items and documents of eight topics: most pairs of nodes are never opened,
    and the best document of each item is found all the same."""
    rng = random.Random(4)
    item_words = [[f"{i % 8}-{rng.randrange(40)}" for _ in range(12)] for i in range(64)]
    rows = sorted({(i, w.encode()) for i, ws in enumerate(item_words) for w in ws})
    tree = dualtree.ItemTree(pa.table({"k": [i for i, _ in rows], "word": [w for _, w in rows], "n": [item_words[i].count(w.decode()) for i, w in rows]}))
    number = {w.decode(): t for w, t in tree.vocabulary.items()}
    tree.weighted(np.full(len(number), 1000))
    docs = [Counter(number[w] for w in (f"{d % 8}-{rng.randrange(40)}" for _ in range(20)) if w in number) for d in range(256)]
    doc, term, counts = (np.array(x) for x in zip(*((d, t, c) for d, bag in enumerate(docs) for t, c in sorted(bag.items())), strict=True))
    gain = dualtree.contributions(np.full(256, 20), doc, counts, tree.weight[term], 256, 256 * 20)
    search = dualtree.Search(tree, np.ones(64, np.int64), 1)
    search.add(list(range(256)), doc, term, gain)
    assert search.opened < 0.6 * search.pairs
    scores = np.zeros((256, len(number)), np.int64)
    scores[doc, term] = gain
    for place, item in enumerate(tree.ids.to_pylist()):
        wanted = np.zeros(len(number), np.int64)
        np.add.at(wanted, [number[w] for w in item_words[item]], 1)
        every = scores @ wanted
        assert search.best[place] == [(every.max(), int(np.argmax(every)))]


def test_search_of_empty_tables(spark, searched):
    docs, items = searched
    none_i, none_d = spark.createDataFrame([], "item_id string, text string"), spark.createDataFrame([], DOCS)
    assert dualtree.rank_documents(spark.createDataFrame(docs[:9], DOCS), none_i).count() == 0
    assert dualtree.rank_documents(none_d, spark.createDataFrame(items, "item_id string, text string")).count() == 0
