from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import corpus, groups, prose, repeats
from pyspark.sql import functions as F

from tabprep.llm import common, ngram_join, sketch_clusters, substring_dedup


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_groups_equal_brute_force(spark):
    rows = corpus()
    assert rows_of(ngram_join.similar_groups(frame(spark, rows))) == groups(rows)


def test_dense_group_of_near_copies(spark):
    base = prose(3, 120)
    rows = []
    for i in range(150):
        w = list(base)
        w[(7 * i) % 120] = f"x{i}"
        w[(11 * i + 40) % 120] = f"y{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, t) for i, t in corpus(8, 10)]
    assert rows_of(ngram_join.similar_groups(frame(spark, rows))) == groups(rows)


def test_neighbour_rounds_lose_no_link(spark, monkeypatch):
    # Without a first block and with rounds throughout.
    sizes, seen = ngram_join._sizes, []

    def many(rest):
        n, pairs = sizes(rest)
        seen.append(pairs)
        return n, pairs * 1000 // (10 ** len(seen))

    monkeypatch.setattr(ngram_join, "_sizes", many)
    rows = corpus(21, 40)
    assert rows_of(ngram_join.similar_groups(frame(spark, rows))) == groups(rows)
    assert len(seen) > 1


def test_similarity_bound_is_met_exactly(spark):
    # Sets of 7 and 5 shingles, 5 shared: below. 7 and 6, 6 shared: above. 4 and 3 of one word each: equal.
    rows = [(1, "a b c d e f g h i j k"), (2, "a b c d e f g h i"), (3, "b c d e f g h i j k"), (4, "q r s t u v w x"), (5, "q r s t u v w")]
    found = rows_of(ngram_join.similar_groups(frame(spark, rows)))
    assert found == groups(rows)
    assert dict((i, c) for i, _, c in found)[5] == 4


def test_groups_edge_cases(spark):
    text = " ".join(prose(1, 40))
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (9, text), (9, "other words stand here now and then"), (8, "other words stand here now and then")]
    df = spark.createDataFrame([(*r, r[0], "z") for r in rows], "doc_id bigint, text string, component_id bigint, h string")
    found = sorted(ngram_join.similar_groups(df).collect(), key=str)
    # Rows that share an id are one document, so 8 is reached from 1 through 9.
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    assert got == sorted([(1, 36, 1), (1, 36, 1), (None, 36, None), (2, 0, 2), (3, 0, 3), (9, 36, 1), (9, 3, 1), (8, 3, 1)], key=str)
    assert ngram_join.similar_groups(df.limit(0)).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (300, 250)]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 300: 200, 250: 200}


def test_bitmap_has_every_member(spark):
    values = [0, 1, -1, 2**63 - 1, -(2**63), *(k * 0x1234567890ABCDEF % 2**63 for k in range(2000))]
    found = common.bitmap(spark.createDataFrame([(v,) for v in values], "x bigint"), "x")
    rows = spark.createDataFrame([(v,) for v in values + list(range(10, 50_000)) + [None]], "y bigint")
    kept, others = (common.likely(rows, "y", found, without) for without in (False, True))
    kept = [r.y for r in kept.collect()]
    assert set(values) <= set(kept) and len(kept) < len(values) + 100
    assert len(kept) + others.count() == len(values) + 49_991
    assert common.likely(rows, "y", common.bitmap(rows.limit(0), "y")).count() == 0


def groups_of_near_copies(n=40, copies=8):
    """Texts of 100 words in groups whose members differ in one or two words from the first."""
    texts = []
    for g in range(n):
        words = prose(g + 1, 100, 5000)
        for c in range(copies):
            changed = list(words)
            for k in range(1 + c % 2):
                changed[(c * 13 + k * 7) % 100] = f"changed{c}"
            texts.append((len(texts), " ".join(changed if c else words), f"s{c}"))
    return texts


def test_sketches_find_the_groups(spark):
    docs = groups_of_near_copies() + [(1000, None, "a"), (1001, "", None), (None, "one two", "b"), (1002, "One  two", "c"), (1003, "three", "d")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("key", F.lit("clash"))
    cluster = {r.doc_id: r.cluster for r in sketch_clusters.near_clusters(df).collect()}
    exact = {r.doc_id: r.component_id for r in ngram_join.similar_groups(df).collect()}
    pairs = [(a, b) for a in range(320) for b in range(a) if exact[a] == exact[b]]
    assert len(pairs) == 40 * 28
    assert sum(cluster[a] == cluster[b] for a, b in pairs) >= 0.9 * len(pairs)
    apart = [(a, b) for a in range(320) for b in range(a) if exact[a] != exact[b]]
    assert sum(cluster[a] == cluster[b] for a, b in apart) == 0
    assert cluster[1000] is None and cluster[1001] is None and cluster[None] == cluster[1002] != cluster[1003]
    assert sketch_clusters.near_clusters(df.limit(0)).count() == 0


def test_rounds_of_a_dense_group(spark, monkeypatch):
    """A large group of near copies is closed in a few rounds, each with no more pairs than rows."""
    words = prose(1, 120, 5000)
    rows = []
    for k in range(400):
        changed = list(words)
        changed[k % 120] = f"x{k}"
        changed[(k * 7) % 120] = f"y{k}"
        rows.append((k, " ".join(changed)))
    rounds = []
    partner = ngram_join._one_partner
    monkeypatch.setattr(ngram_join, "_one_partner", lambda met: rounds.append(met) or partner(met))
    found = ngram_join.similar_groups(frame(spark, rows)).collect()
    assert {r.component_id for r in found} == {0}
    assert len(rounds) <= 4 and all(partner(met).count() <= 400 for met in rounds)


def test_near_misses_are_compared_once(spark, monkeypatch):
    """Texts that share two thirds make each pair once, and few of them reach the whole sets."""
    base, rows = prose(2, 300, 5000), []
    for k in range(60):
        changed = list(base)
        for j in range(6):
            changed[(k * 5 + j * 47) % 300] = f"x{k}y{j}"
        rows.append((k, " ".join(changed)))
    rows += [(100 + k, text) for k, text in rows[::10]] + [(200, rows[7][1] + " and a little more")]
    plain, written = ngram_join.materialize, []

    def counted(df, *args):
        out = plain(df, *args)
        if {"a", "b"} <= set(out.columns):
            written.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "materialize", counted)
    found = rows_of(ngram_join.similar_groups(frame(spark, rows)))
    assert found == groups(rows)
    assert len({c for _, _, c in found}) > 40
    assert sum(written) < 1.3 * 60 * 59 / 2


def test_odd_sketches_lose_no_link(spark):
    draw, pairs, sets, linked, far = np.random.default_rng(3), [], [], set(), set()
    for k in range(300):
        n, left_out = int(draw.integers(1, 600)), int(draw.integers(0, 200))
        first = np.unique(draw.integers(0, 2**64, n, np.uint64))
        second = first[min(left_out * n // 400, n - 1) :]
        second = np.unique(np.concatenate([second, draw.integers(0, 2**64, int(draw.integers(0, 1 + n // 5)), np.uint64)]))
        sets += [(2 * k, len(first), ngram_join._odd(first)), (2 * k + 1, len(second), ngram_join._odd(second))]
        pairs.append((2 * k, 2 * k + 1))
        share = len(np.intersect1d(first, second)) / len(np.union1d(first, second))
        (linked if share >= 0.75 else far if share < 0.6 and n > 100 else set()).add(2 * k)
    odd = spark.createDataFrame(sets, "key bigint, n bigint, odd array<bigint>")
    kept = {r.a for r in ngram_join._close(spark.createDataFrame(pairs, "a bigint, b bigint"), odd, 75).collect()}
    assert len(linked) > 50 and linked <= kept
    assert len({len(s) for _, _, s in sets}) > 4 and len(far) > 20 and not far & kept


@pytest.mark.parametrize("period", [1, 2, 7, 13, 31])
def test_difference_cover(period):
    cover = set(substring_dedup.difference_cover(period))
    for i in range(period):
        for j in range(period):
            assert any((i + k) % period in cover and (j + k) % period in cover for k in range(period))


def test_repeats_equal_brute_force(spark):
    rows = corpus(6, 50)
    found = rows_of(substring_dedup.repeated_words(frame(spark, rows)).drop("removed"))
    assert found == repeats(rows)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), max_size=12))
def test_repeats_of_small_windows(spark, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = rows_of(substring_dedup.repeated_words(df, window=5, period=3).drop("removed"))
    assert found == repeats(rows, 5)


def test_repeats_edge_cases(spark):
    text = " ".join(prose(1, 60))
    rows = [(5, text), (5, text), (7, text), (None, text), (2, None), (3, ""), (5, "x " + text), (9, "short copy"), (10, "short copy")]
    df = spark.createDataFrame([(*r, "c", "d") for r in rows], "doc_id bigint, text string, key string, h string")
    found = sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(x) for x in r.removed]) for r in substring_dedup.repeated_words(df).collect()), key=str)
    expected = [(5, 60, 0, []), (5, 60, 0, []), (7, 60, 60, [(0, 60)]), (None, 60, 0, []), (2, 0, 0, []), (3, 0, 0, []), (5, 61, 0, []), (9, 2, 0, []), (10, 2, 0, [])]
    assert found == sorted(expected, key=str)
    assert substring_dedup.repeated_words(df.limit(0)).collect() == []


def test_texts_without_repeats(spark):
    passage = " ".join(prose(1, 55))
    rows = [(1, f"first  {passage}\nend", "a"), (2, f"second \n {passage} rest", "b"), (3, passage, "c"), (None, passage, "d"), (4, None, "e"), (5, "", "f"), (2, "second text", "g")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _key string").withColumnRenamed("_key", "key")
    found = sorted(((r.doc_id, r.text, r.key) for r in substring_dedup.without_repeats(df).collect()), key=str)
    expected = [rows[0], (2, "second rest", "b"), *rows[3:]]
    assert found == sorted(expected, key=str)
    assert substring_dedup.without_repeats(df).columns == df.columns
