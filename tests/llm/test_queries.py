"""The registered queries of the folder over the smallest tables, next to their SQL counterparts."""

from __future__ import annotations

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{k}" for k in range(1, 14)), "pipeline"])


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_against_sql(spark, name):
    assert compare(connect(DATA), entry.oracle_sql()[name], entry.queries()[name](spark, DATA)) == []


@pytest.mark.parametrize("name", ["op1_html_extraction", "op2_best_fit_packing", "op9_token_counts", "op12_warc"])
def test_rows_cover_the_table(spark, name):
    key, table = {"op1": ("page_id", "pages"), "op2": ("doc_id", "documents"), "op9": ("doc_id", "documents"), "op12": ("page_id", "pages")}[name.split("_")[0]]
    found = {r[key] for r in entry.queries()[name](spark, DATA).select(key).collect()}
    assert found == {r[key] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()}


def test_overlaps_equal_brute_force(spark):
    """All alignments of all items with all documents."""
    items = {r.item_id: r.text.lower().split() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").limit(12).collect()}
    docs = {r.doc_id: r.text.lower().split() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    from tabprep.llm.decontamination import contaminated

    expected = set()
    for k, item in items.items():
        size = min(13, len(item))
        for i, words in docs.items():
            for shift in range(1 - len(item), len(words)):
                same = [0 <= j + shift < len(words) and words[j + shift] == w for j, w in enumerate(item)]
                if any(sum(same[j : j + size]) >= size - 2 * size // 13 for j in range(len(item) - size + 1)):
                    expected.add((i, k))
                    break
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet").filter(f"item_id in ({', '.join(map(str, items))})")
    found = contaminated(spark.read.parquet(f"{DATA}/documents.parquet"), bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
