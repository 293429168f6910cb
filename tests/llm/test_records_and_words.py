"""Importance resampling, WARC archives and spelling variants against plain versions of the same definitions."""

from __future__ import annotations

import datetime as dt
import glob
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabprep.llm import importance, spelling_variants, warc
from tabprep.scratch import materialize

# ---- importance resampling


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_features(text, longest):
    w = plain_words(text)
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain_ranks(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    def bag(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t, longest))

    s, t = bag([x for _, x in docs]), bag(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        features = plain_features(text, longest)
        total = 0
        for f in features:
            b = zlib.crc32(f.encode()) % buckets
            total += math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        weight = total // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(plain_words(text)), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[1], r[3]))
    drawn = able[: percent * len(able) // 100]
    ranked = [(*r, k) for k, r in enumerate(drawn, 1)]
    rest = Counter(rows) - Counter(drawn)
    return Counter(ranked + [(*r, None) for r in rest.elements()])


def sample_docs(n=120, seed=1):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Été", "naïve", "ÀB", "l'eau", "x-y_z", "数据"]
    docs = [(i, " ".join(r.choices(words, weights=range(len(words), 0, -1), k=r.randrange(0, 60)))) for i in range(n)]
    docs += [(500, None), (501, ""), (502, "... !"), (None, "w1 " * 30), (None, None), (7, docs[7][1]), (7, docs[7][1]), (8, "w3 " * 40)]
    docs += [(600, " ".join(f"long{k % 997}" for k in range(300_000))), (601, "z" * 3_000_000)]
    return docs


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_ranks_equal_plain_version(spark, monkeypatch, longest):
    docs, target = sample_docs(), ["w1 w2 w59 été", "w58 W57", None, ""]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    scored = importance.scores(df, bench, longest=longest, buckets=500, head_words=20, head_pairs=15)
    found = Counter(map(tuple, importance.ranked(scored, percent=25).collect()))
    assert found == plain_ranks(docs, target, longest, 500, 25)


def test_choice_of_head_changes_nothing():
    text = " ".join(t or "" for _, t in sample_docs(40)[:40]).encode()
    words = sorted(set(text.translate(importance._PLAIN).split()))
    for longest in (1, 2, 3):
        results = []
        for heads, pairs in ((0, 0), (5, 3), (len(words), 50)):
            states = {w: zlib.crc32(w) for w in words[:heads]}
            known = {(a, b): zlib.crc32(a + b" " + b) % 1000 for a, b in zip(words[:pairs], words[1:])}
            n, parts = importance.Features(longest, 1000, states, known).of(text)
            results.append((n, sorted(np.concatenate(parts).tolist())))
        assert results[0] == results[1] == results[2]


def test_runs_cross_blocks(monkeypatch):
    text = " ".join(f"w{k}" for k in range(500)).encode()
    whole = importance.Features(3, 1000).of(text)
    monkeypatch.setattr(importance, "BLOCK_BYTES", 37)
    cut = importance.Features(3, 1000).of(text)
    assert whole[0] == cut[0] and sorted(np.concatenate(whole[1])) == sorted(np.concatenate(cut[1]))


def test_frequent_words_reach_the_head(spark):
    texts = spark.createDataFrame([(" ".join(["often"] * 50 + [f"rare{k}" for k in range(100)]),)] * 10, "text string")
    assert importance._head(texts, 1, False) == [[b"often"]]
    assert importance._head(texts, 1, True) == [[b"often", b"often"]]


def test_hot_score_and_empty_tables(spark):
    rows = [(5, 30, 30, 0, 77)] * 1000 + [(k, 30, 30, 0, 70) for k in range(100)] + [(9, 3, 3, 0, 99)]
    scored = spark.createDataFrame(rows, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")
    found = importance.ranked(scored, percent=95).collect()
    ranks = sorted(r.rank for r in found if r.rank is not None)
    assert len(found) == len(rows) and ranks == list(range(1, 95 * 1100 // 100 + 1))
    assert max(r.doc_id for r in found if r.rank is not None and r.score == 70) == 44
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert importance.ranked(importance.scores(none, none)).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert importance.scores(some, none).first().n_features == 2


def test_resample_keeps_columns(spark):
    docs = spark.createDataFrame([(k, f"a{k} " * 25, k) for k in range(50)], "doc_id int, text string, id int")
    kept = importance.resample(docs, docs.limit(3), percent=20)
    assert kept.columns == ["doc_id", "text", "id"] and kept.count() == 10


# ---- archives


def sample_pages():
    r = random.Random(3)
    big = ["<p>" + "".join(r.choices("abcdé \n", k=1200)) + f"{k}</p>" for k in range(12)]
    rows = [(k, f"http://host/{k}?q=é x\r\nInjected: 1", big[k % 12]) for k in range(60)]
    rows += [(100 + k, None, "small") for k in range(5)] + [(200, "u", None), (201, "u", ""), (None, "n", big[0]), (None, "n", "null id only " * 100)]
    rows += [(None, "n", "null id only " * 100), (59, "again", big[59 % 12]), (300, "long", "x" * 3_000_000), (301, "long", "x" * 3_000_000)]
    # One payload held by most rows.
    return rows + [(1000 + k, "hot", "hot " * 300) for k in range(150)]


def plain_records(pages, least=1000):
    payloads = [(i, (h or "").encode()) for i, _, h in pages]
    best = {}
    for i, p in payloads:
        if len(p) >= least:
            best[p] = max(best.get(p, -math.inf), -math.inf if i is None else i)
    rows, taken = [], set()
    for i, p in sorted(payloads, key=lambda x: (x[0] is not None, x[0] or 0), reverse=True):
        first = len(p) < least or p not in taken
        taken.add(p)
        target = None if first else best[p]
        rows.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if first else "revisit", None if target == -math.inf else target))
    return Counter(rows)


@pytest.mark.parametrize("archive_bytes", [64 << 20, 4000])
def test_archives_round_trip(spark, tmp_path, archive_bytes):
    pages = sample_pages()
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4).withColumn("path", warc.F.lit("clash"))
    files = warc.write_responses(df, str(tmp_path / "raw"), archive_bytes=archive_bytes)
    assert files.agg({"records": "sum"}).first()[0] == len(pages)
    raw = warc.read_headers(files)
    assert {r.record_type for r in raw.collect()} == {"response"}
    assert Counter(r.url for r in raw.collect()) == Counter(u for _, u, _ in pages)
    clean = warc.deduplicate(files, str(tmp_path / "clean"), date=dt.datetime(2020, 1, 2, tzinfo=dt.UTC), archive_bytes=archive_bytes)
    rows = warc.referred(warc.read_headers(clean)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == plain_records(pages)
    assert {r.date for r in rows} == {"2020-01-02T00:00:00Z"}
    # Ids are kept and distinct; a repeated payload is stored once.
    assert {r.record_id for r in rows} == {r.record_id for r in raw.collect()} and len({r.record_id for r in rows}) == len(rows)
    stored = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "clean/*")))
    assert stored.count(b"hot " * 300) == 1 and stored.count(b"x" * 3_000_000) == 1
    # A URL cannot add header lines.
    assert b"\r\nInjected" not in stored
    # Revisits of the written archives stay as they are.
    again = warc.referred(warc.read_headers(warc.deduplicate(clean, str(tmp_path / "twice"))))
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in again.collect()) == Counter((r.page_id, r.record_type, r.refers_to) for r in rows)


def test_damaged_archives_are_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string")
    path = warc.write_responses(df, str(tmp_path / "raw")).first().path
    files = spark.createDataFrame([(path,)], "path string")
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-9])
    with pytest.raises(Exception, match="cut off"):
        warc.read_headers(files).collect()
    plain = gzip.decompress(data)
    open(path, "wb").write(gzip.compress(plain.replace(b"\r\n\r\ntext", b"\r\n\r\ntexx")))
    with pytest.raises(Exception, match="digest"):
        warc.read_headers(files).collect()


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.referred(warc.read_headers(warc.deduplicate(warc.write_responses(none)))).count() == 0


def test_frequent_keys_are_broadcast(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k")
    facts = materialize(rows.groupBy("k").agg(warc.F.count("*").alias("_rows")).withColumn("twice", warc.F.col("k") * 2))
    found = warc.frequent_join(rows, facts, ["k"], 5000)
    assert sorted((r.id, r.twice) for r in found.collect()) == [(i, -2 if i % 3 == 0 else 2 * i) for i in range(5000)]


# ---- spelling variants


def plain_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_variants(words, ratio=5):
    form, near = {}, Counter()
    for w, n in words.items():
        others = [(v, m) for v, m in words.items() if plain_near(w, v)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-x[1], x[0]), default=None)
        form[w] = best[0] if best and best[1] >= ratio * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return sorted(rows)


def table_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint")


@pytest.mark.parametrize("block", [1024, 3])
def test_variants_equal_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(spelling_variants, "BLOCK", block)
    r = random.Random(block)
    words = {}
    for _ in range(500):
        w = "".join(r.choices("abé", k=r.randrange(1, 9)))
        words[w] = r.choice([1, 2, 5, 10, 30, 200, 5000])
    # A tile with most of the words, one pair of very long words, characters beyond 16 bits, the padding's kin.
    words |= {"common" + "".join(r.choices("xyz", k=r.randrange(2, 5))): r.randrange(1, 400) for _ in range(150)}
    words |= {"q" * 70_000: 5, "q" * 70_001: 50, "𝄞abc": 5, "𝄞abd": 50, "abc\0": 1, "abc": 5, "abc￿": 1}
    found = spelling_variants.variants(table_of(spark, words))
    assert sorted(map(tuple, found.collect()), key=lambda x: x[0]) == plain_variants(words)


def test_pairs_come_once(spark):
    words = {w: 1 for w in ("aaaaaa", "aaaaab", "baaaaa", "aaaaaaa", "aaaaaaaa", "abaaaa")}
    pairs = [frozenset((p.a, p.b)) for p in spelling_variants.near_words(table_of(spark, words)).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in words for b in words if plain_near(a, b)}


def test_roots_of_long_chains(spark):
    words = {"abcdef"[:k] + "z" * (12 - k): 5**k for k in range(7)}
    found = {r.word: r.root for r in spelling_variants.variants(table_of(spark, words)).collect()}
    assert set(found.values()) == {"abcdefzzzzzz"}


def test_vocabulary_equals_plain_version(spark, monkeypatch):
    r = random.Random(4)
    letters = ["Maison", "maisons", "Éclair", "éclair", "naïveté", "short", "×÷×÷×÷", "abcdefghij"]
    docs = [(i, " ".join(r.choices(letters, k=40)) + ", d'Artagnan2quelque") for i in range(300)] + [(None, "maison " * 9), (1, None), (2, ""), (3, "ab" * 600_000)]
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("word", warc.F.lit("clash")).repartition(3)
    for held, long in ((spelling_variants.HELD, spelling_variants.LONG), (2, 10)):
        monkeypatch.setattr(spelling_variants, "HELD", held)
        monkeypatch.setattr(spelling_variants, "LONG", long)
        found = {r.word: r.n for r in spelling_variants.vocabulary(df, dropped=7).collect()}
        assert found == {w: n for w, n in counts.items() if n >= 5}


def test_no_words(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling_variants.variants(spelling_variants.vocabulary(none)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants.variants(table_of(spark, {"a": 1}), ratio=1)


# ---- token counts of other tokenizer files


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_follow_the_file(file):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tabprep.llm.token_counts import PieceCounter

    path = public_tokenizers.path(file)
    library, counter = Tokenizer.from_file(path), PieceCounter(path)
    assert counter.plain == (file == "word_bpe_49k.json")
    r = random.Random(2)
    parts = ["The", "the ", " it's", "  ", "\n\n", "2024", "3.5", "Été", "数据", "👍🏽", "we'LL", "_", "--", "\t", "a", "<|endoftext|>", "x" * 300]
    texts = ["", " ", *("".join(r.choices(parts, k=r.randrange(1, 30))) for _ in range(300))]
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_pipeline_stage_with_clashing_names(spark):
    import corpus_pipeline

    rows = [(1, "one two three four five six", "a", "b"), (1, "other words of the same id here", "a", "c"), (2, "ONE two three four five six", "a", "d"), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _other string, _again string").withColumn("c0", warc.F.lit(1))
    first = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    again = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(7), "")
    assert first.columns == docs.columns and sorted(first.collect(), key=str) == sorted(again.collect(), key=str)
    assert sorted((r.doc_id for r in first.collect()), key=str) == [1, None]
