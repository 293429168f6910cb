"""Ranges cut by literals, chains of linked pages, and stable keys."""

from __future__ import annotations

import datetime as dt
import json
import math
import random
from decimal import Decimal as D

import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep import scratch
from tabprep.operators.diff import compare_values
from tabprep.operators.facts import dense_key, register_members, to_transaction_fact
from tabprep.operators.metrics import alerts_with_cooldown
from tabprep.operators.missing import exact_median, fill_directional
from tabprep.scratch import BUCKET, cut_ranges, materialize
from tabprep.sources.odata import follow_links, read_odata_chains


def test_ranges_follow_the_key(spark):
    r = random.Random(1)
    values = [None, float("nan"), -math.inf, math.inf, 0.0] + [r.uniform(-5, 5) for _ in range(2000)]
    rows = [(v, r.choice([None, "", "a", "ß", "z"]), dt.datetime(2020, 1, 1) + dt.timedelta(minutes=r.randrange(10**6))) for v in values]
    df = spark.createDataFrame(rows, "k double, s string, t timestamp").repartition(5)
    for order in (["k"], ["s", "k"], ["t"], ["s", "t", "k"]):
        ranged = cut_ranges(df, order, unique=True)
        assert plan_of(ranged).count("Exchange") == plan_of(df).count("Exchange")
        spans = ranged.groupBy(BUCKET).agg(F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high"), F.count("*").alias("n"))
        ordered = spans.withColumn("before", F.max("high").over(Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)))
        assert ordered.filter("before >= low").count() == 0
        sizes = [s.n for s in spans.collect()]
        assert len(sizes) >= 6 and max(sizes) <= 2.5 * len(rows) / len(sizes)


def test_equal_keys_spread(spark):
    # Equal keys with different rows are cut by their hash; rows that are equal throughout by their place.
    for other in ("id", "0"):
        df = spark.range(3000).selectExpr("IF(id % 3 = 0, 7L, id) AS k", f"IF(id % 3 = 0, {other}, id) AS v")
        sizes = [s["count"] for s in cut_ranges(df, ["k"]).groupBy(BUCKET).count().collect()]
        assert max(sizes) <= 900
        keys = sorted((x.key, x.k) for x in dense_key(df, "key", ["k"]).collect())
        assert [k for k, _ in keys] == list(range(1, 3001)) and [v for _, v in keys] == sorted(v for _, v in keys)


@pytest.mark.parametrize("unique", [False, True])
def test_ranges_hold_a_bounded_number_of_rows(spark, monkeypatch, unique):
    monkeypatch.setattr(scratch, "RANGE_ROWS", 100)
    sizes = [s["count"] for s in scratch.range_buckets(spark.range(3000), ["id"], unique).groupBy(BUCKET).count().collect()]
    assert len(sizes) >= 25 and sum(sizes) == 3000 and max(sizes) <= 300
    times = [i * 7 % 3001 for i in range(3000)]
    candidates = spark.createDataFrame([("a", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), 25) for t in times], "alert string, timestamp timestamp_ntz, cooldown_seconds int")
    expected, free = [], 0
    for t in sorted(times):
        if t >= free:
            expected.append(t)
            free = t + 25
    fired = alerts_with_cooldown(candidates).collect()
    assert sorted((r.timestamp - dt.datetime(2024, 1, 1)).total_seconds() for r in fired) == expected


def test_empty_and_tiny_tables(spark):
    df = spark.range(3).selectExpr("id AS k", "IF(id = 1, NULL, id) AS v")
    assert sorted((r.k, r.v) for r in fill_directional(df, ["v"], ["k"]).collect()) == [(0, 0), (1, 0), (2, 2)]
    assert dense_key(df.limit(0), "key", ["k"]).collect() == []
    assert [r.key for r in dense_key(df.limit(1), "key", ["k"]).collect()] == [1]


def plain_median(values):
    known = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    if not known:
        return None
    return known[(len(known) - 1) // 2], known[len(known) // 2]


MEDIANS = {
    "double": [
        [1.5],
        [None, 2.0, 1.0],
        [float("nan")] * 3 + [1.0],
        [math.inf, -math.inf, 1e308, -1e308, 5.0, 6.0],
        [5e-324, 1e-323, 1.5e-323, 2e-323, 1.0],
        [0.0, -0.0, 0.0, 7.0],
        [math.exp(k / 7) for k in range(-2000, 2000)],
        [k % 3 * 1.0 for k in range(3000)],
        [None],
    ],
    "bigint": [[2**63 - 1, -(2**63), 0, 5], [2**63 - 1, 2**63 - 2, 2**63 - 3], list(range(1001)), [4] * 9],
    "decimal(38,18)": [[D("99999999999999999999.999999999999999999"), D("99999999999999999999.999999999999999998")] * 2 + [D("1"), D("-99999999999999999999.1")]],
    "decimal(12,2)": [[D(k) / 100 for k in range(501)]],
}


@pytest.mark.parametrize("kind", MEDIANS)
def test_median_equals_sorted_middle(spark, kind):
    for values in MEDIANS[kind]:
        df = spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(3)
        found = exact_median(df, "x").first().x
        middle = plain_median(values)
        if middle is None:
            assert found is None
            continue
        # Added by the engine, in its types.
        low, high = (F.lit(m).cast(kind) for m in middle)
        expected = sum(middle) / 2 if kind == "bigint" else spark.range(1).select(((low + high) / 2).alias("x")).first().x
        assert found == expected or (found != found and expected != expected), values[:5]


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "bigint"])
def test_pairs_of_a_hot_key(spark, kind):
    """A key with a third of all rows, a tolerance: equal to counting all pairs, and no range holds the key."""
    r = random.Random(8)
    step = 1 if kind == "bigint" else 0.25
    def rows(n):
        return [(0 if k % 3 == 0 else k % 50, None if r.random() < 0.05 else (int if kind == "bigint" else float)(r.randrange(200) * step)) for k in range(n)]
    one, two = rows(600), rows(500)
    apart = 2 if kind == "bigint" else 0.5
    dfs = [spark.createDataFrame([(k, None if v is None else str(v)) for k, v in side], "k bigint, v string").withColumn("v", F.col("v").cast(kind)).repartition(3) for side in (one, two)]
    differing = sum(1 for k, a in one for m, b in two if k == m and (a is None) != (b is None) or k == m and a is not None and b is not None and abs(a - b) > apart)
    found = compare_values(*dfs, ["k"], tolerance=apart).collect()
    assert [(x.column, int(x.differences)) for x in found] == [("v", differing)]


def walk(pages, start):
    found, at = {}, start
    while at is not None and at not in found:
        found[at] = len(found)
        at = pages.get(at)
    return found


@pytest.mark.parametrize("n", [1, 2, 7, 64, 100])
def test_links_equal_a_walk(spark, n):
    r = random.Random(n)
    names = [f"p{k}" for k in range(n)]
    pages = {a: r.choice([*names, "gone", None]) if r.random() < 0.1 else f"p{k + 1}" for k, a in enumerate(names)}
    starts = [("a", "p0"), ("b", r.choice(names)), ("c", "nowhere")]
    links = spark.createDataFrame([*pages.items(), ("p0", pages["p0"]), (None, "p0")], "address string, next string").repartition(3)
    report = follow_links(links, spark.createDataFrame(starts, "chain string, address string")).collect()
    expected, reached = [], set()
    for chain, start in starts:
        at = walk(pages, start)
        reached |= set(at)
        for a, k in at.items():
            following = pages.get(a)
            expected.append((chain, a, k, "missing" if a not in pages else "cycle" if at.get(following, k + 1) <= k else "read"))
    expected += [(None, a, None, "orphan") for a in pages if a not in reached]
    assert sorted(map(tuple, report), key=str) == sorted(expected, key=str)


def test_incomplete_chains_are_errors(spark, tmp_path):
    def page(k, following, rows):
        return {"@odata.context": f"p{k}", "@odata.nextLink": following, "value": [{"x": x} for x in rows]}

    lines = [page(2, None, [5]), page(0, "p1", [1, 2]), page(9, "p2", [99]), page(1, "p2", [3, 4])]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, lines)))
    starts = spark.createDataFrame([("c", "p0")], "chain string, address string")
    schema = spark.createDataFrame([], "x bigint").schema
    rows, report = read_odata_chains(spark, str(tmp_path), starts, schema)
    # The orphan's rows are left out.
    assert sorted((r.position, r.x) for r in rows.collect()) == [(0, 1), (0, 2), (1, 3), (1, 4), (2, 5)]
    assert {r.address for r in report.collect() if r.status == "orphan"} == {"p9"}
    for following, word in (("p3", "missing"), ("p1", "cycle")):
        (tmp_path / "a.json").write_text("\n".join(map(json.dumps, [page(2, following, [5]), *lines[1:]])))
        with pytest.raises(ValueError, match=word):
            read_odata_chains(spark, str(tmp_path), starts, schema)


def test_keys_stay_over_loads(spark, tmp_path):
    def load(version, *members):
        df = spark.createDataFrame([(a, b, "x") for a, b in members], "a string, b int, version string")
        rows = register_members(df, ["a", "b"], "key", str(tmp_path / "r"), version)
        return {(r.a, r.b): r.key for r in rows.collect()}

    first = load(1, ("m", 1), ("k", None), ("m", 1))
    assert first == {("k", None): 1, ("m", 1): 2}
    second = load(2, ("a", 0), ("m", 1), (None, None), ("k", None))
    assert second == {**first, (None, None): 3, ("a", 0): 4}
    # A load that is run again gives the same keys; one without new members adds nothing.
    assert load(2, ("a", 0), ("m", 1), (None, None)) == second
    assert load(3, ("m", 1)) == second
    assert load(4, ("b", 0)) == {**second, ("b", 0): 5}


def test_cuts_hold_the_columns_that_tell_them_apart(spark):
    df = materialize(spark.range(1000).selectExpr("id AS a", "id % 3 AS b", "0 AS c"))
    plan = plan_of(cut_ranges(df, ["a", "b"], unique=True).select(BUCKET))
    assert "ReadSchema: struct<a:bigint>" in plan
    tied = cut_ranges(df, ["c", "a"], unique=True).groupBy(BUCKET).agg(F.min("a").alias("low"), F.max("a").alias("high"))
    rows = tied.orderBy(BUCKET).collect()
    assert len(rows) > 1 and all(x.high < y.low for x, y in zip(rows, rows[1:]))


def test_facts_are_joined_once(spark):
    """Cuts, offsets and keys are taken from written facts; one range needs no join of all pairs."""
    ledger = materialize(
        spark.range(500).selectExpr(
            "cast(id AS string) AS TransactionID", "date'2024-01-01' AS Date", "cast(id % 3 AS string) AS AccountCode", "'a' AS AccountName",
            "cast(id % 5 AS string) AS Department", "'c' AS CostCenter", "'e' AS Entity", "'s' AS Scenario", "1.5 AS AmountLocal", "1.5 AS AmountEUR", "1.0 AS FXRateUsed",
        )
    )
    fact = to_transaction_fact(ledger)
    assert plan_of(fact).count("Join ") == 1
    assert sorted(r.transaction_key for r in fact.collect()) == list(range(1, 501))
    assert "NestedLoopJoin" not in plan_of(dense_key(ledger.limit(0), "k", ["TransactionID"], unique=True))
