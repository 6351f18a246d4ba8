"""Each method against a brute-force version."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_ORACLE, SF_SMALL
from gridpulse.llm import backoff, blocklabels, langid, nbsvm, packing, spotsigs, tokengroups, toxicgrammar, warc, wumanber
from gridpulse.llm.common import BATCH_BYTES, BATCH_LIMIT, fold_is, table
from gridpulse.llm.queries import QUERIES


def near_copies(seed=3, n=60):
    """Random documents with exact and near copies of all degrees."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for base in range(6):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(8, 90))]
        for _ in range(n // 6):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    rng.shuffle(out)
    return list(enumerate(out))


# --- 1 ---

@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    runs = [sorted([(rng.choice("abc"), str(rng.randint(0, 5)), rng.choice([None, 1, 2]), "", None, 0, "", f"f{i}", j, 0, "")
                    for j in range(rng.randint(0, 9))], key=warc.sort_key) for i in range(k)]
    assert list(warc.LoserTree(runs)) == sorted((x for r in runs for x in r), key=warc.sort_key)


def test_archives_round_trip(spark):
    from gridpulse.llm.common import shared_path

    rows = [(i, f"http://h{i % 3}.org/p{i}", f"<p>{'x' * (i % 7 * 40)}\r\n\r\nWARC/1.1\r\né</p>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_path(spark, "test-warc")
    warc.write_archives(pages, path, records_per_archive=7)
    got = warc.read_archives(spark, path, with_payload=True).collect()
    html = {i: h for i, _, h in rows}
    assert len(got) == 40
    for r in got:
        assert r.payload == (html[r.page_id] if r.record_type == "response" else "")
        assert r.refers_to is None or html[r.refers_to] == html[r.page_id]


# --- 2, 6, 10: accuracy on rows that were not learned from ---

def test_quality_held_out(spark):
    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")
    got = (nbsvm.score_quality(docs, nbsvm.fit_quality(docs, labels)).join(labels, "doc_id")
           .where(fold_is("doc_id", nbsvm.FOLDS, nbsvm.HELD)).select("quality", "quality_pred").collect())
    assert np.mean([r.quality == r.quality_pred for r in got]) > 0.95


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.r_[rng.integers(20, 60, 6), [i % 2]]) for i in range(80)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(80)])
    r = nbsvm.log_count_ratio(rows, y, 64)
    w, b = nbsvm.dual_descent(rows, y, r)
    assert all(nbsvm.margin(x, r, w, b) * t > 0 for x, t in zip(rows, y, strict=True))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = (toxicgrammar.score_toxicity(docs, toxicgrammar.fit_toxicity(docs, labels)).join(labels, "doc_id")
           .where(fold_is("doc_id", toxicgrammar.FOLDS, toxicgrammar.HELD)).select("toxic", "toxic_pred").collect())
    assert np.mean([r.toxic == r.toxic_pred for r in got]) > 0.95


def test_grammar_weighs_clauses():
    table_, lexicon = toxicgrammar.grammar(), toxicgrammar.Lexicon({"idiot$": 2.0, "kill$": 2.0})
    score = lambda t: sum(toxicgrammar.clause_scores(t, lexicon, table_))
    plain, aimed = score("what an idiot"), score("you are an idiot")
    assert aimed > plain > score("he said what an idiot") > 0
    assert plain > score("this is not an idiot") > 0
    assert score("not now. what an idiot") == plain  # negation ends with its clause
    assert score("a fine day") == 0


def test_lone_hits_weigh_less_than_aimed_or_repeated_ones():
    table_, lexicon = toxicgrammar.grammar(), toxicgrammar.Lexicon({"idiot$": 2.0, "kill$": 2.0})
    score = lambda t: sum(toxicgrammar.clause_scores(t, lexicon, table_))
    full, f = 2.0, toxicgrammar.FACTORS
    assert score("idiot") == score("the word idiot is in the dictionary") == score("kill the process") == f["lone"] * full
    assert score("you idiot") == score("idiot that you are") == full  # the target may come later in the clause
    assert score("idiot. you are") == f["lone"] * full
    assert score("idiot idiot") == (f["lone"] + f["repeated"]) * full
    assert score("you idiot, i kill you") == (1 + f["escalated"]) * full
    assert score("she said you are not an idiot") == f["reported"] * f["negated"] * full


def test_marked_machine_sums_to_the_weighted_one():
    rng = random.Random(4)
    words = "idiot kill you not said fine day .".split()
    lexicon, (marked, marks) = toxicgrammar.Lexicon({"idiot$": 2.0, "kill$": 3.0}), toxicgrammar.marked_grammar()
    for _ in range(30):
        factors = {n: rng.choice(c) for n, c in toxicgrammar.CHOICES.items()}
        table_, text = toxicgrammar.grammar(factors), " ".join(rng.choice(words) for _ in range(40))
        weights = np.array([math.prod(factors[n] for n in names) for names in marks])
        got = sum(toxicgrammar.clause_scores(text, lexicon, marked), np.zeros(len(marks)))
        assert math.isclose(got @ weights, sum(toxicgrammar.clause_scores(text, lexicon, table_)), abs_tol=1e-9)


def test_learned_grammar_changes_predictions(spark):
    """Words that are toxic only when aimed: the factors are learned, and without
    them the mention, the report and the denial would be rejected."""
    rng = random.Random(8)
    plain = "the red house by river stood old tree garden under stone hill wind".split()
    clean = ["the word idiot is in the dictionary", "he said what an idiot", "this is not an idiot", ""]
    toxic = ["you are an idiot", "kill you idiot", "you moron, you idiot"]
    rows = []
    for i in range(1_200):
        bad = i % 3 == 0
        about = [" ".join(rng.choices(plain, k=6)) for _ in range(3)]
        rows.append((i, ". ".join([about[0], rng.choice(toxic if bad else clean), *about[1:]]), int(bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicgrammar.fit_toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert model["factors"]["lone"] < toxicgrammar.FACTORS["lone"]

    def predicted(factors):
        held = frame.where(fold_is("doc_id", toxicgrammar.FOLDS, toxicgrammar.HELD))
        got = toxicgrammar.score_toxicity(held, model | {"factors": factors}).collect()
        return np.mean([r.toxic == r.toxic_pred for r in got])

    assert predicted(model["factors"]) > 0.95
    assert predicted(dict.fromkeys(toxicgrammar.FACTORS, 1.0)) < 0.75


def test_composition_multiplies_factors():
    both = toxicgrammar.reported_speech().compose(toxicgrammar.negation())
    state, weight = both.start, 1.0
    for symbol in ("reporter", "negator", "insult"):
        _, factor, state = both.step(state, symbol)
        weight *= factor
    assert math.isclose(weight, 0.5 * 0.4)


def test_language_held_out(spark):
    docs = table(spark, SF_ORACLE, "documents")
    got = (langid.predict_languages(docs, langid.fit_languages(docs)).where(fold_is("doc_id", langid.FOLDS, langid.HELD))
           .select("lang", "lang_pred").collect())
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_parse_takes_longest_matches():
    rng = random.Random(1)
    train = [rng.randint(1, 3) for _ in range(60)]
    t = langid.parse_table(train, 5)
    lanes = [np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 50))], np.int32) for _ in range(30)]
    text = "".join(map(str, train))
    for lane, got in zip(lanes, langid.phrase_counts(lanes, t), strict=True):
        left, phrases = "".join(map(str, lane)), 0
        while left:
            n = next((n for n in range(len(left), 0, -1) if left[:n] in text), 1)
            left, phrases = left[n:], phrases + 1
        assert abs(got - phrases) <= 1  # a phrase begun by the very last unknown character


def phrases_of(text, train):
    phrases = 0
    while text:
        n = next((n for n in range(len(text), 0, -1) if text[:n] in train), 1)
        text, phrases = text[n:], phrases + 1
    return phrases


@pytest.mark.parametrize("letters", [3, 400, 6000])
def test_parse_with_any_alphabet(letters):
    rng = random.Random(letters)
    train = [1 + int(letters * rng.random() ** 3) for _ in range(3000)]
    table_ = langid.parse_table(train, letters + 2)
    assert sum(x.nbytes for x in table_) < 1 << 21  # grows with the edges, not with states x letters
    lanes = [np.array(train[s:s + 20] + [rng.randint(0, letters + 1) for _ in range(30)] + train[:9], np.int32) for s in range(0, 2000, 100)]
    text = "".join(map(chr, train))
    for lane, got in zip(lanes, langid.phrase_counts(lanes, table_), strict=True):
        assert abs(got - phrases_of("".join(map(chr, lane)), text)) <= 1


def test_languages_of_many_scripts(spark):
    rng = random.Random(4)
    # Three alphabets of their own for pairs of languages, one of them with 3,000 letters.
    scripts = {"aa": (0x61, 26), "ab": (0x61, 26), "ba": (0x430, 32), "bb": (0x430, 32), "ca": (0x4E00, 3000), "cb": (0x4E00, 3000)}
    words = {k: ["".join(chr(a + rng.randrange(n)) for _ in range(rng.randint(2, 6))) for _ in range(200)] for k, (a, n) in scripts.items()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(40)), k) for i, k in enumerate(list(scripts) * (60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    got = langid.predict_languages(docs, model).where(fold_is("doc_id", langid.FOLDS, langid.HELD)).collect()
    assert set(r.lang for r in got) == set(scripts) and all(r.lang_pred == r.lang for r in got)


# --- 3 ---

def test_search_against_brute_force(spark):
    rng = random.Random(5)
    words = "a b c d".split()
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 5, 7])))) for i in range(12)] + [(99, "")]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(25)]
    want = {}
    for doc_id, text in docs:
        ws, hit, found = text.split(), set(), set()
        for item, t in items:
            iw = t.split()
            for s in range(max(1, len(iw) - 3)):
                p = iw[s:s + 4]
                for at in range(len(ws) - len(p) + 1) if p else ():
                    if ws[at:at + len(p)] == p:
                        hit |= set(range(at, at + len(p)))
                        found.add(str(item))
        want[doc_id] = (len(ws), len(hit), sorted(found))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block, segment in ((9, 2), (200_000, 1), (200_000, 1_000)):
        got = wumanber.find_benchmark(d, b, window=4, block_windows=block, segment=segment).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want


def test_a_long_benchmark_item_is_dealt_to_bounded_blocks(spark):
    long_item = " ".join(f"w{i * 7919 % 1_000_003}" for i in range(1_000_000))
    items = spark.createDataFrame([("long", long_item), ("short", "one two")], "item_id string, text string")
    segments = wumanber.item_segments(items)
    blocks = [b.join(segments, ["item_id", "part"]).agg(F.sum("windows").alias("n"), F.sum(F.length("part")).alias("b")).first()
              for b in wumanber.segment_blocks(segments)]
    assert sum(r.n for r in blocks) == 1_000_000 - 9 + 1 and len(blocks) == 5
    assert max(r.n for r in blocks) < 1.3 * wumanber.BLOCK_WINDOWS and max(r.b for r in blocks) < wumanber.BLOCK_BYTES
    ws = long_item.split()
    docs = spark.createDataFrame([(1, " ".join(["x", *ws[995:1_010], "y"])), (2, " ".join(ws[-10:])), (3, "One, two!")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in wumanber.find_benchmark(docs, items).collect()}
    assert got == {1: (15, ["long"]), 2: (10, ["long"]), 3: (2, ["short"])}


# --- memory of the pipeline's workers ---

def test_word_caches_stay_small():
    """Texts of ever new words leave no more than a bounded cache in a worker."""
    features, lexicon, shingles = nbsvm.Features(), toxicgrammar.Lexicon({}), tokengroups.Shingles()
    for k in range(5):
        new = [f"w{k}x{i}" for i in range(60_000)]
        features(" ".join(new))
        lexicon.classes(new)
        shingles(" ".join(new).encode())
    assert max(len(features.seen), len(lexicon.seen)) <= 160_000
    assert len(shingles.codes) + len(shingles.codes.old) <= 200_000


def test_small_pieces_and_counts_give_the_same_models(spark, monkeypatch):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    labels = table(spark, SF_SMALL, "labels")
    toxic, quality = toxicgrammar.fit_toxicity(docs, labels), nbsvm.fit_quality(docs, labels)
    monkeypatch.setattr(toxicgrammar, "COUNTED", 300)
    monkeypatch.setattr(toxicgrammar, "PIECE_BYTES", 500)
    monkeypatch.setattr(nbsvm, "PIECE_BYTES", 500)
    again = nbsvm.fit_quality(docs, labels)
    assert toxicgrammar.fit_toxicity(docs, labels) == toxic
    assert all(np.array_equal(quality[k], again[k]) for k in quality)


# --- 4 ---

def brute_backoff(docs, order, least, alpha=0.4):
    """Sums of log scores by the definition, n-gram for n-gram."""
    texts = [(i, ["<s>", *(t or "").lower().split()]) for i, t in docs]
    texts = [(i, w if len(w) > 1 else []) for i, w in texts]
    counts = Counter(tuple(w[j:j + k]) for _, w in texts for k in range(1, order + 1) for j in range(len(w) - k + 1))
    n = sum(len(w) - 1 for _, w in texts if w)
    out = defaultdict(float)
    for i, w in texts:
        out[i] += 0.0
        for j in range(1, len(w)):
            k, factor = min(order, j + 1), 1.0
            while k > 1 and counts[tuple(w[j - k + 1:j + 1])] < least:
                k, factor = k - 1, factor * alpha
            gram = tuple(w[j - k + 1:j + 1])
            out[i] += math.log(factor * counts[gram] / (counts[gram[:-1]] if k > 1 else n))
    return out


@pytest.mark.parametrize("order,least,size", [(2, 1, 16 << 20), (2, 2, 16 << 20), (2, 2, 40), (3, 1, 60), (3, 2, 1), (3, 3, 200), (1, 1, 50)])
def test_backoff_against_brute_force(spark, order, least, size):
    rng = random.Random(order + least)
    docs = [(i, " ".join(rng.choice("aa bb cc dd ee ff".split()[:rng.randint(1, 6)]) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    docs += [(7, "aa zz"), (None, "aa bb"), (None, None), (8, "hot " * 300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = backoff.score_documents(frame, min_count=least, order=order, slice_bytes=size, part_bytes=max(1, size // 4) if size < 1000 else 32 << 20).collect()
    want = brute_backoff(docs, order, least)
    lengths = Counter()
    for i, t in docs:
        lengths[i] += len((t or "").split())
    assert {r.doc_id: r.n_tokens for r in got} == dict(lengths)
    assert all(math.isclose(r.score, want[r.doc_id], abs_tol=1e-9) for r in got)


def test_backoff_numbers_take_the_bytes_they_need():
    for width in range(1, 9):
        values = np.array([0, (1 << (8 * width)) - 1, 1 << (8 * width - 8), 1], np.uint64)
        assert len(backoff.packed(values)) == 1 + width * len(values)
        assert (backoff.unpacked(backoff.packed(values), np.uint64) == values).all()
    assert len(backoff.unpacked(backoff.packed(np.zeros(0, np.int64)))) == 0


def test_backoff_counts_pieces_one_by_one(spark):
    """The count table of a partition never holds a place for every entry of every piece."""
    def peak(n_pieces):
        hashes = np.arange(1, 100_001, dtype=np.uint64) << np.uint64(20)
        rows = pa.table({"part": [0] * n_pieces, "slice": list(range(n_pieces)), "hashes": [backoff.packed_hashes(hashes)] * n_pieces,
                         "counts": [backoff.packed(np.ones(100_000, np.int64))] * n_pieces})
        tracemalloc.start()
        got = add(rows)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert all((backoff.unpacked(x) == n_pieces).all() for x in got.column("counts").to_pylist())
        return most

    class Requests:
        def groupBy(self, _):
            return self

        def applyInArrow(self, function, _):
            return function

    add = backoff.counted(Requests())
    assert peak(40) - peak(10) < 30 * 100_000 * 30  # bytes an entry: two copies of its hash while they are sorted, and its reply


def test_backoff_query_of_texts_without_words(spark, tmp_path):
    rows = [(1, "aa bb aa"), (2, None), (3, " . "), (None, ""), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_stupid_backoff"](spark, str(tmp_path)).collect()}
    assert got.pop(1)[0] == 3
    assert got == {2: (0, 0.0, None), 3: (0, 0.0, None), None: (0, 0.0, None)}


# --- 5 ---

def brute_groups(docs, size, percent):
    sets = {}
    for i, t in docs:
        w = t.lower().split()
        k = min(len(w), size)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    linked = defaultdict(set)
    for i, a in sets.items():
        for j, b in sets.items():
            if i != j and a and b and 100 * len(a & b) >= percent * len(a | b):
                linked[i].add(j)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(sets[i]), min(seen), len(linked[i]))
    return out


@pytest.mark.parametrize("size,percent,block", [(4, 85, 256), (5, 80, 4), (2, 60, 3)])
def test_groups_against_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(tokengroups, "BLOCK_DOCS", block)
    docs = near_copies(seed=size)
    got = tokengroups.similar_groups(spark.createDataFrame(docs, "doc_id long, text string"), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got} == brute_groups(docs, size, percent)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100 + i, 100) for i in range(20)]
    got = dict(tokengroups.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(got[i] == 1 for i in range(2, 61)) and all(got[100 + i] == 100 for i in range(1, 20))


# --- 7 ---

def test_near_pairs_against_brute_force(spark):
    docs = near_copies(seed=9, n=36)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = {r.doc_id: frozenset(r.m) for r in df.select("doc_id", spotsigs.signatures(F.col("text")).alias("m")).collect()}
    first = {}
    for i in sorted(marks):
        first.setdefault(marks[i], i)
    ids = sorted(first.values())
    want = {(i, j) for i in ids for j in ids if i < j and len(marks[i] & marks[j]) >= 0.6 * len(marks[i] | marks[j])}
    assert {(r.a, r.b) for r in spotsigs.near_pairs(df, 0.6).collect()} == want


def test_fingerprints_are_native(spark):
    plan = spotsigs.fingerprints(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- 8 ---

def test_blocks_read_the_markup():
    page = ("<html><head><title>t</title><script>a<b</script></head><body><nav><a href='x>y'>Home</a></nav>"
            "<article><h1>Big &amp; small</h1><p>one <b>two\n three<p>four<br>five<!-- <p>no --><aside>more</aside></article>"
            "<footer>end</footer></body>")
    got = blocklabels.blocks_of(page)
    assert [t for _, t, _ in got] == ["Home", "Big & small", "one two three", "four five", "more", "end"]
    assert [p.hint for p, _, _ in got] == [-1, 1, 1, 1, -1, -1]


def test_paths_of_deep_nesting_are_bounded(spark):
    n = 100_000
    page = "<article>" + "<div class='deep'>x<a>y" * n + "</a></div>" * n + "</article><nav>menu</nav>"
    got = blocklabels.blocks_of(page)  # a copy of the path a block would be 10 ** 10 names
    assert len(got) == n + 1 and {t for _, t, _ in got} == {"xy", "menu"}
    assert {p.hint for p, _, _ in got[:-1]} == {1} and got[-1][0].hint == -1
    assert len({p for p, _, _ in got}) <= 4
    frame = spark.createDataFrame([(1, page), (2, "<p>plain")], "page_id long, html string")
    assert {r.page_id: len(r.main_text) for r in blocklabels.extract_main_text(frame, {}).collect()} == {1: 3 * n - 1, 2: 5}


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in blocklabels.new_network(rng).items()}
    x, mask = rng.standard_normal((5, 3, blocklabels.DIM)), np.ones((5, 3), bool)
    mask[3:, 1] = False
    weights = rng.standard_normal((5, 3, blocklabels.HIDDEN))
    loss = lambda: float((blocklabels.lstm(x, mask, net["Wf"], net["Uf"], net["cf"], False)[0] * weights).sum())
    _, cache = blocklabels.lstm(x, mask, net["Wf"], net["Uf"], net["cf"], True)
    grads = dict(zip(("Wf", "Uf", "cf"), blocklabels.lstm_back(x, weights, cache, net["Uf"]), strict=True))
    for name in ("Wf", "Uf", "cf"):
        at = tuple(rng.integers(0, n) for n in net[name].shape)
        keep = net[name][at]
        net[name][at] = keep + 1e-3
        up = loss()
        net[name][at] = keep - 1e-3
        down = loss()
        net[name][at] = keep
        assert math.isclose(grads[name][at], (up - down) / 2e-3, rel_tol=0.02, abs_tol=2e-3)


def test_main_text_is_the_article(spark):
    import html
    import re

    pages = table(spark, SF_ORACLE, "pages")
    got = blocklabels.extract_main_text(pages, blocklabels.fit_labeller(pages)).collect()

    def article(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        parts = re.split(r"</?(?:p|h\d|div|ul|li|blockquote|section)\b[^>]*>", inner)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
        return "\n".join(p for p in parts if p)

    assert np.mean([r.main_text == article(r.html) for r in got]) > 0.98


# --- 9 ---

def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SF_SMALL, "documents")
    got = packing.pack(docs, with_ids=True).toPandas()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = {i: x.sort_values("start").ids.explode().tolist() for i, x in got.groupby("doc_id")}
    for r in docs.collect():
        assert ids[r.doc_id] == [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
    for _, x in got.groupby("sequence_id"):
        x = x.sort_values("offset")
        assert x.offset.tolist() == [0, *np.cumsum(x.length)[:-1]] and x.length.sum() <= 4096


def test_plan_places_every_piece():
    rng = np.random.default_rng(4)
    hist = np.bincount(np.r_[rng.integers(1, 65, 900), np.full(3000, 24), np.full(500, 64)], minlength=65)
    room = defaultdict(list)
    for length, slots in packing.plan_slots(hist, 64).items():
        ranks = sorted((s[0], s[4]) for s in slots.tolist())
        assert ranks[0][0] == 0 and ranks[-1][1] == hist[length] and all(a[1] == b[0] for a, b in zip(ranks, ranks[1:]))
        for first, k, sequence, offset, stop in slots.tolist():
            for rank in range(first, stop):
                room[sequence + (rank - first) // k].append((offset + (rank - first) % k * length, length))
    for pieces in room.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert len(room) <= 1.02 * np.ceil((hist * np.arange(65)).sum() / 64) + 1200  # lengths of 24 leave a third


def test_tokenizer_shortcut_is_exact():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(packing.tokenizer_path()), packing.Encoder(packing.tokenizer_path(), keep=5)
    for t in ("a's Don't İSTANBUL Σίσυφος ΣΑΣ.\x85x\xa0y z\x1cq hi !!'s 12½三 é ​﻿", "', 'll", "",
              "\n\t", "ẞß ǅ ﬁ 한국어 ไทย", "x<|endoftext|>y"):
        assert np.frombuffer(encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


# --- pipeline ---

def test_pipeline_stages(spark):
    docs = table(spark, SF_ORACLE, "documents")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, docs, SF_ORACLE).toPandas(), docs.schema)
        assert after.columns == columns
        a, b = after.toPandas(), docs.toPandas()
        assert set(a.doc_id) < set(b.doc_id)
        if name == "near_duplicates":
            want = brute_groups(list(zip(b.doc_id, b.text)), 5, 80)
            assert set(a.doc_id) == {i for i in b.doc_id if want[i][1] == i}
        docs, before = after, name
    assert before == "decontaminate"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_ORACLE).toPandas()
    assert set(packed.doc_id) == set(docs.toPandas().doc_id)


def test_quality_fit_holds_packed_indicators_and_no_scaled_copies(spark, monkeypatch):
    import tracemalloc

    docs = spark.createDataFrame([(i, f"word{i} {'good' if i % 2 else 'bad'} text") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(nbsvm, "fit", lambda rows, y: seen.extend(rows))
    nbsvm.fit_quality(docs, labels)
    assert seen and {r.dtype.itemsize for r in seen} == {4}
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 1 << 14, 6000)).astype(np.int32) for _ in range(100)]
    y = np.where(np.arange(100) % 2, 1.0, -1.0)
    r = nbsvm.log_count_ratio(rows, y, 1 << 14)
    tracemalloc.start()
    nbsvm.dual_descent(rows, y, r, epochs=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * sum(map(len, rows))  # before: eight bytes more for each indicator


def test_pipeline_stages_send_texts_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    docs = table(spark, SF_SMALL, "documents")
    large = spark.range(2000, numPartitions=1).select(F.repeat(F.lit("word "), 1000).alias("text"))  # 10 MB, one batch before
    had = spark.conf.get(BATCH_LIMIT, None)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(BATCH_LIMIT)
            stage(spark, docs, SF_SMALL)
            got = large.mapInArrow(sizes, "n long, size long").collect()
            assert sum(r.n for r in got) == 2000 and max(r.size for r in got) < BATCH_BYTES + 20_000
        spark.conf.set(BATCH_LIMIT, "1m")
        corpus_pipeline.pack(spark, docs, SF_SMALL)
        assert spark.conf.get(BATCH_LIMIT) == "1m"  # the session's own
    finally:
        spark.conf.unset(BATCH_LIMIT) if had is None else spark.conf.set(BATCH_LIMIT, had)
