"""Nulls, empty and very long texts, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridpulse.llm import backoff, blocklabels, langid, nbsvm, packing, spotsigs, tokengroups, toxicgrammar, warc, wumanber
from gridpulse.llm.common import bounded_sample, labelled_sample

LONG = "the quick brown fox jumps over a lazy dog and runs away " * 4000
ROWS = [(1, "the cat sat on the mat and the dog ran away from it", "en", "a", 5),
        (1, "the cat sat on the mat and the dog ran away from it", "en", "a", 5),
        (2, None, None, None, None), (3, "", "en", "a", 0), (4, LONG, "en", "b", None), (5, " \t\n ", "de", "b", 3),
        (6, "...!!!", None, "a", 6), (None, "ein Hund und eine Katze sind nicht da, idiot", "de", None, 9),
        (7, "İstanbul \U0001F600 naïve <|endoftext|>", "tr", "c", 2)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["n", "y", "digest", "prefix", "token", "block", "range_id", "copy", "place", "next_text", "hits", "items", "part",
         "quality_score", "toxic_score", "lang_pred", "key", "main_text", "length", "start"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 2), int(i % 3 == 0)) for i in range(1, 8)] + [(None, 1, 1), (1, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a.b/x?q#f", "<p>hi</p>" * 30), (2, "http://a.b/x", "<p>hi</p>" * 30), (2, "http://a.b/x", "<p>hi</p>" * 30),
            (3, None, None), (4, "", ""), (None, "ftp://C.D", "<article><p>a &amp; b" + "<b>x" * 2000), (5, "x\r\ny", LONG)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("main_text", F.lit("z")).withColumn("n", F.lit(1))


def none_of(df):
    return df.where(F.lit(False))


def test_warc(spark, pages):
    got = warc.capture_index(pages, records_per_archive=2).orderBy("position").collect()
    assert [r.position for r in got] == list(range(7))
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got) == [
        (0, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None),
        (4, "response", None), (5, "response", None)]
    assert warc.capture_index(none_of(pages)).count() == 0


def test_quality(docs, labels):
    model = nbsvm.fit_quality(docs, labels)
    got = nbsvm.score_quality(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.quality_score <= 1 and r.n == "x" for r in got)
    assert len({r.quality_score for r in got if r.doc_id in (2, 3)}) == 1
    assert "constant" in nbsvm.fit_quality(docs, none_of(labels))
    assert nbsvm.score_quality(none_of(docs), model).count() == 0
    assert nbsvm.fit_quality(none_of(docs), labels) == {"constant": 0.5}


def test_toxicity(docs, labels):
    model = toxicgrammar.fit_toxicity(docs, labels)
    got = toxicgrammar.score_toxicity(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.toxic_score <= 1 for r in got)
    assert toxicgrammar.fit_toxicity(docs, none_of(labels)) == {"constant": 0.0}
    assert toxicgrammar.score_toxicity(none_of(docs), model).count() == 0


def test_search(spark, docs):
    items = spark.createDataFrame([(1, "the dog ran away from it"), (2, None), (3, ""), (3, "?!"), (None, "lazy dog")], "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit) for r in wumanber.find_benchmark(docs, items).collect()}
    assert (1, 13, 6) in got and (2, 0, 0) in got and (3, 0, 0) in got and (4, 48000, 8000) in got
    assert {r.n_hit for r in wumanber.find_benchmark(docs, none_of(items)).collect()} == {0}
    assert wumanber.find_benchmark(none_of(docs), items).count() == 0


def test_backoff(docs):
    got = {r.doc_id: r for r in backoff.score_documents(docs).collect()}
    assert set(got) == {r[0] for r in ROWS}
    assert got[1].n_tokens == 26 and got[2].n_tokens == 0 and got[3].score == 0.0
    assert backoff.score_documents(none_of(docs)).count() == 0


def test_groups(docs):
    got = [tuple(r) for r in tokengroups.similar_groups(docs).orderBy("doc_id").collect()]
    assert len(got) == len(ROWS)
    assert got[0][0] is None and got[0][2] is None
    assert got[1] == got[2] == (1, 10, 1, 1)
    assert got[3] == (2, 0, 2, 0) and got[4] == (3, 0, 3, 0) and got[6] == (5, 0, 5, 0)
    assert tokengroups.similar_groups(none_of(docs)).count() == 0


def test_fingerprints(docs):
    got = spotsigs.fingerprints(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert {r.fingerprint for r in got if r.doc_id in (2, 3)} == {""}
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert spotsigs.fingerprints(none_of(docs)).count() == 0
    one = spotsigs.fingerprints(docs.where("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_blocks(spark, pages):
    net = blocklabels.fit_labeller(pages)
    got = {r.page_id: r for r in blocklabels.extract_main_text(pages, net).collect()}
    assert got[3].main_text == got[4].main_text == "" and got[1].n == 1
    assert blocklabels.extract_main_text(none_of(pages), net).count() == 0
    assert blocklabels.fit_labeller(none_of(pages)) == {}
    assert [r.main_text for r in blocklabels.extract_main_text(pages.where("page_id = 1"), {}).collect()] == ["\n".join(["hi"] * 30)]


def test_packing(docs):
    got = packing.pack(docs).collect()
    assert sorted(str(r.doc_id) for r in got if r.start == 0) == sorted(str(r[0]) for r in ROWS)
    assert {r.doc_tokens for r in got if r.doc_id in (2, 3, 5)} == {1}
    assert packing.pack(none_of(docs)).count() == 0


def test_language(docs):
    model = langid.fit_languages(docs)
    got = langid.predict_languages(docs, model).collect()
    assert len(got) == len(ROWS)
    assert {(r.lang_pred, r.lang_score) for r in got if r.doc_id in (2, 3, 5, 6)} == {("und", 0.0)}
    assert all(r.lang_pred in model["langs"] for r in got if r.doc_id in (1, 4, 7))
    empty = langid.fit_languages(none_of(docs))
    assert {r.lang_pred for r in langid.predict_languages(docs, empty).collect()} == {"und"}
    assert langid.predict_languages(none_of(docs), model).count() == 0


def test_texts_without_a_letter_in_any_script(spark, docs):
    model = langid.fit_languages(docs)
    none = ["\U0001F600\U0001F600", "\u3002 \u3001", "\uFF11\uFF12", "\u0301 \u0302", "\u0967\u0968", "\uE000", "\U0010FFFF", "7\u3000\u300c"]
    some = ["\u6F22", "\uFF21", "\U00010400 \U0001F600", "e\u0301", "\uD55C"]
    got = langid.predict_languages(spark.createDataFrame(list(enumerate(none + some)), "doc_id long, text string"), model).collect()
    assert {(r.lang_pred, r.lang_score) for r in got if r.doc_id < len(none)} == {("und", 0.0)}
    assert all(r.lang_pred in model["langs"] and r.lang_score > 0 for r in got if r.doc_id >= len(none))
    a = langid.normalised("\u6F22\u3002\U0001F600\U00020000\uFF11")
    assert a.tolist() == [0x6F22, 32, 32, 0x20000, 32]


def test_samples_are_bounded_with_null_and_repeated_ids(spark, monkeypatch):
    rows = spark.range(6000).select(
        F.expr("case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end").alias("doc_id"),
        F.expr("case when id % 2 = 0 then concat('text ', id) else 'a copy' end").alias("text"), F.lit("en").alias("lang"))
    for limit in (20, 100, 400):
        got = bounded_sample(rows, ["doc_id", "text"], limit).collect()
        assert len(got) <= limit + 6 * limit ** 0.5
    assert len(got) > 100 and {r.doc_id for r in got} >= {None, 7}
    assert bounded_sample(rows, ["doc_id", "text"], 6000).count() == 6000
    seen = []
    monkeypatch.setattr(langid, "normalised", lambda t, f=langid.normalised: seen.append(t) or f(t))
    langid.fit_languages(rows)
    assert 0 < len(seen) <= 50
    labels = rows.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    assert 0 < labelled_sample(rows, labels, "quality", 5, 0, 100).count() <= 160


def test_frequent_shingles_are_capped(spark):
    rows = [(i, "a b c d" + " e f g h" * (i < 8) + " i j k l" * (i < 5)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    every, two = tokengroups.frequent_shingles(docs), tokengroups.frequent_shingles(docs, most=2)
    assert len(every) > 2 and every[-2:].tolist() == two.tolist()


def test_near_duplicates_with_shared_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    near = a + " more"
    rows = [(7, a), (7, b), (3, near), (7, b), (8, c), (None, c), (None, d), (None, d), (None, d + " e"), (9, ""), (9, ""), (9, None), (10, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, docs.repartition(4), "").collect()
    kept = [(r.doc_id, r.text) for r in got]
    assert len(kept) == len(set(kept)) and {x for x in kept if x[0] is not None} == {(3, near), (7, b), (8, c), (9, ""), (9, None), (10, " ")}
    assert [x for x in kept if x[0] is None] in ([(None, d)], [(None, d + " e")])


CLEAN = "the river was wide and the old men sat by the water and talked about the harvest of the year before "


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_rows_and_columns(spark, docs, labels, items_dir, name):
    """Nulls in any column, empty and long texts, repeated rows, clashing extra
    columns, tables without some columns, and no rows."""
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, items_dir)
    none = stage(spark, none_of(docs), items_dir)
    few = stage(spark, docs.select("text", "doc_id"), items_dir)
    if name == "pack":
        rows = got.collect()
        assert sum(r.length for r in rows if r.doc_id == 2) == 1 and len(rows) >= len(ROWS) and none.count() == 0
        assert few.count() == len(rows)
        return
    assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes) and few.columns == ["text", "doc_id"]
    kept = [tuple(r)[:len(ROWS[0])] for r in got.collect()]
    assert all(r in ROWS for r in kept) and all(r.n == "x" for r in got.select("n").collect())
    assert none.count() == 0 and none.columns == docs.columns
    if name == "decontaminate":
        assert sum(r[1] in (None, "") for r in kept) == 2
    assert few.count() == len(kept)


@pytest.fixture(scope="module")
def items_dir(spark, labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    labels.write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, CLEAN)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path
