"""The pipeline's stages against brute force, and what holds for all of them."""

from __future__ import annotations

from llm.helpers import DOCS, corpus, groups, repeats, words

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t or "")) for i, t in rows], DOCS)


def as_rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_order_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "substring_dedup", "decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, SF).dtypes == docs.dtypes


def test_language_stage_keeps_texts(spark):
    rows = [(1, "the cat sat on the mat"), (2, "12 % 3"), (3, None), (4, ""), (5, "the mat")]
    assert as_rows(stage("language_id")(spark, table(spark, rows), SF)) == [rows[0], rows[4]]
    # Without any language learned, letters decide.
    assert as_rows(stage("language_id")(spark, table(spark, [(2, "x"), (4, "1")]), SF)) == [(2, "x")]


def test_language_stage_rejects_unlike_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    unlike = ["Το γρήγορο αλεπούδι πηδά πάνω από το τεμπέλικο σκυλί και φεύγει", "съешь ещё этих мягких французских булок да выпей чаю", "xq zvkj wqpx jjkz vvxq kqzw xzzj qpwv zxkq jvqx wzkq pxvj kkqz", "春の朝は静かで鳥の声が聞こえる。山の上に雪が残っている。"]
    # Texts like the learned ones, of which no language is given.
    like = [t for i, t in sorted(given.items()) if len(t) > 200][:40]
    rows = [(10**9 + k, t, None, "s", len(t)) for k, t in enumerate(unlike + like)]
    names = "doc_id", "text", "lang", "source", "n_chars"
    found = {r.doc_id for r in stage("language_id")(spark, docs.select(*names).union(spark.createDataFrame(rows, DOCS)), SF).collect()}
    assert {i for i in found if i >= 10**9} == {10**9 + k for k in range(len(unlike), len(rows))}
    assert found >= {i for i, t in given.items() if any(c.isalpha() for c in t)}
    one = [(1, "the cat sat on the mat", "en", "s", 22), (2, "кошка сидит на ковре", None, "s", 20), (3, "the cat sat", None, "s", 11)]
    assert {r.doc_id for r in stage("language_id")(spark, spark.createDataFrame(one, DOCS), SF).collect()} == {1, 3}


def test_language_stage_compares_texts_whose_language_is_given(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    unlike = ["Το γρήγορο αλεπούδι πηδά πάνω από το σκυλί " * 20, "съешь ещё этих мягких французских булок да выпей чаю " * 30, "xq zvkj wqpx jjkz vvxq kqzw xzzj qpwv " * 70]
    like = [r.text for r in docs.filter("lang = 'de' and n_chars between 600 and 3000").orderBy("doc_id").limit(20).collect()]
    rows = [(10**9 + k, t, "en", "s", len(t)) for k, t in enumerate(unlike + like)]
    found = stage("language_id")(spark, docs.union(spark.createDataFrame(rows, DOCS)), SF)
    assert {r.doc_id for r in found.filter("doc_id >= 1000000000").collect()} == {10**9 + k for k in range(len(unlike), len(rows))}
    assert found.filter("doc_id < 1000000000").count() == docs.filter("text rlike '[a-zA-Z]'").count()


def test_packing_stage_keeps_near_duplicates_apart(spark):
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(1, text), (2, text.replace("w7 ", "v7 ")), (3, " ".join(f"u{k}" for k in range(300)))]
    found = {r.doc_id: r.bin_id for r in stage("best_fit_packing")(spark, table(spark, rows), SF).collect()}
    assert found[1] != found[2] and found[3] in (found[1], found[2])


def test_near_duplicates_stage(spark):
    rows = corpus(31, 40)
    kept = {c for _, _, c in groups(rows)}
    assert as_rows(stage("ngram_jaccard_join")(spark, table(spark, rows), SF)) == sorted(((i, t) for i, t in rows if i in kept), key=str)
    repeated = [(1, "same words in here now"), (1, "same words in here now"), (2, None), (2, None)]
    assert as_rows(stage("ngram_jaccard_join")(spark, table(spark, repeated), SF)) == [repeated[0], repeated[2]]


def test_substring_stage(spark):
    rows = corpus(32, 40)
    expected = {i: removed for i, _, removed, _ in repeats(rows)}
    found = dict(as_rows(stage("substring_dedup")(spark, table(spark, rows), SF)))
    for i, text in rows:
        left = len(words(text)) - expected[i]
        if expected[i]:
            assert len(words(found.get(i))) == left and (i in found) == (left > 0)
        else:
            assert found[i] == text


def test_whole_pipeline(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    placed = {r.doc_id for r in found}
    assert placed and placed <= set(docs)
    assert not any(item in " ".join(docs[i].text.lower().split()) for i in placed for item in items)
    same = groups([(i, r.text) for i, r in docs.items()])
    assert placed <= {c for _, _, c in same}
    # Clean documents stay: those alone in their group, with letters and without a benchmark item.
    alone = {c for _, n, c in same} - {i for i, r in docs.items() if any(item in " ".join(r.text.lower().split()) for item in items)}
    assert {i for i in alone if any(ch.isalpha() for ch in docs[i].text)} <= placed


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs, SF).collect() == []
