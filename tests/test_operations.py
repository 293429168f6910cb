from __future__ import annotations

import datetime as dt
import itertools
import random
from decimal import Decimal, localcontext
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tabprep.operators import diff
from tabprep.operators.diff import (
    compare_keys,
    compare_rows,
    compare_samples,
    compare_shape,
    compare_values,
    profile,
    table_hash,
)
from tabprep.operators.digests import changed_rows, differing_ranges, digest_tree, hashed_range, key_range, rows_in_ranges
from tabprep.operators.merge import append_dedup, assert_key, upsert
from tabprep.operators.metrics import (
    ALERT_RULES,
    AlertRule,
    alert_candidates,
    alert_events,
    alerts_with_cooldown,
    metric_context,
    metrics_summary,
    run_metrics,
    step_metrics,
)
from tabprep.operators.redaction import (
    drop_sensitive_columns,
    drop_sensitive_like,
    redact,
    redact_credentials,
    scan_sensitive,
)
from tabprep.scratch import materialize, scratch_dir
from tabprep.sinks.bucketed import read_bucketed, upsert_bucketed, write_bucketed


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- merging


def people(spark, *rows):
    return spark.createDataFrame(rows, "id int, name string, age int")


def test_upsert(spark):
    target = people(spark, (1, "a", 1), (2, "b", 2), (None, "n", 3))
    source = people(spark, (2, "B", 20), (4, "d", 4), (None, "N", 30))
    expected = [(1, "a", 1), (2, "B", 20), (4, "d", 4), (None, "N", 30), (None, "n", 3)]
    assert as_set(upsert(target, source, ["id"])) == sorted(expected, key=repr)
    only_age = [(1, "a", 1), (2, "b", 20), (4, "d", 4), (None, "N", 30), (None, "n", 3)]
    assert as_set(upsert(target, source, ["id"], ["age"])) == sorted(only_age, key=repr)
    assert upsert(target, source, []).count() == 6


def test_upsert_null_overwrites(spark):
    merged = upsert(people(spark, (1, "a", 1)), people(spark, (1, None, None)), ["id"])
    assert as_set(merged) == [(1, None, None)]


def test_upsert_twice_is_once(spark):
    target = people(spark, (1, "a", 1), (2, "b", 2))
    source = people(spark, (2, "B", 20), (3, "c", 3))
    once = upsert(target, source, ["id"])
    assert as_set(upsert(once, source, ["id"])) == as_set(once)


def test_upsert_with_fewer_source_columns(spark):
    source = spark.createDataFrame([(1, "A"), (9, "Z")], "id int, name string")
    assert as_set(upsert(people(spark, (1, "a", 1)), source, ["id"])) == [(1, "A", 1), (9, "Z", None)]


def test_upsert_rejects_unknown_columns(spark):
    target = people(spark, (1, "a", 1))
    for source, keys in ((target.withColumn("x", F.lit(1)), ["id"]), (target, ["key"]), (target.withColumn("x", F.lit(1)), [])):
        with pytest.raises(ValueError, match="unknown columns: (x|key)"):
            upsert(target, source, keys)


@pytest.mark.parametrize("side", ["source", "target"])
@pytest.mark.parametrize("columns", [None, ["age"]])
def test_upsert_rejects_repeated_keys(spark, side, columns):
    single, repeated = people(spark, (1, "a", 1)), people(spark, (2, "b", 2), (2, "c", 3))
    target, source = (single, repeated) if side == "source" else (repeated, single)
    with pytest.raises(Exception, match=f"repeated key in {side}"):
        upsert(target, source, ["id"], columns).collect()


def test_append_dedup(spark):
    old = people(spark, (1, "a", 1), (2, "b", 2), (2, "bb", 3))
    new = people(spark, (2, "B", 1), (3, "c", 1), (3, "cc", 2)).withColumn("extra", F.lit("x"))
    got = append_dedup(old, new, ["id"], ["age"])
    assert plan_of(got).count("WindowGroupLimit") == 2
    assert as_set(got) == [(1, "a", 1, None), (2, "B", 1, "x"), (3, "cc", 2, "x")]


def test_merge_columns_of_any_name(spark):
    schema = "id int, _target int, _source int, _new_v string, v string, _batch int, _rank int"
    target, source = (spark.createDataFrame([r], schema) for r in ((1, 1, 1, "a", "b", 1, 1), (1, 2, 3, "c", "d", 4, 5)))
    assert as_set(upsert(target, source, ["id"])) == as_set(source)
    assert as_set(append_dedup(target, source, ["id"])) == as_set(source)


def folders(path):
    return {p.name: sorted(f.name for f in p.iterdir()) for p in path.iterdir() if p.is_dir()}


def test_upsert_buckets(spark, tmp_path):
    path = tmp_path / "table"
    target = people(spark, *((i, f"n{i}", i) for i in range(200)), *((None, "n", i) for i in range(50)))
    write_bucketed(target, str(path), ["id"], 8)
    before = folders(path)
    assert sorted(before) == [f"_bucket_of_8={i}" for i in range(8)]
    source = spark.createDataFrame([(17, "changed")], "id bigint, name string")
    hit = upsert_bucketed(spark, str(path), source, ["id"])
    after = folders(path)
    assert len(hit) == 1 and [n for n in before if before[n] != after[n]] == [f"_bucket_of_8={hit[0]}"]
    expected = as_set(upsert(target, source, ["id"]))
    assert as_set(read_bucketed(spark, str(path))) == expected
    # The same source again, one without rows, new keys and keys without value.
    assert upsert_bucketed(spark, str(path), source, ["id"]) == hit and upsert_bucketed(spark, str(path), source.limit(0), ["id"]) == []
    assert as_set(read_bucketed(spark, str(path))) == expected
    more = people(spark, (300, "new", 1), (None, "more", 2), (3, "x", None))
    upsert_bucketed(spark, str(path), more, ["id"], ["name"])
    expected = as_set(upsert(upsert(target, source, ["id"]), more, ["id"], ["name"]))
    assert as_set(read_bucketed(spark, str(path))) == expected


def test_upsert_buckets_failing_changes_nothing(spark, tmp_path):
    path = tmp_path / "table"
    write_bucketed(people(spark, (1, "a", 1), (2, "b", 2)), str(path), ["id"], 4)
    before = folders(path)
    with pytest.raises(Exception, match="repeated key in source"):
        upsert_bucketed(spark, str(path), people(spark, (1, "x", 1), (1, "y", 1)), ["id"])
    with pytest.raises(ValueError, match="unknown columns"):
        upsert_bucketed(spark, str(path), spark.createDataFrame([(1, 1)], "id int, other int"), ["id"])
    assert {n: [f for f in fs if not f.startswith((".", "_"))] for n, fs in folders(path).items() if n in before} == {
        n: [f for f in fs if not f.startswith((".", "_"))] for n, fs in before.items()
    }
    assert as_set(read_bucketed(spark, str(path))) == [(1, "a", 1), (2, "b", 2)]


def test_assert_key(spark):
    found = assert_key(people(spark, (1, "a", 1), (1, "b", 1), (2, "c", 1), (None, "d", 1)), ["id"])
    assert as_set(found.select("id", "violation")) == [(1, "duplicate"), (None, "null")]


# --- diff


def test_hash(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).cast("string").alias("s"))
    of = lambda d, **k: table_hash(d, **k).first().hash
    assert len(of(df)) == 16 and of(df) == of(df.repartition(7, "s")) == of(df.orderBy(F.desc("id")))
    changed = df.withColumn("s", F.when(F.col("id") == 50, "x").otherwise(F.col("s")))
    assert of(df) != of(changed) and of(df, columns=["id"]) == of(changed, columns=["id"])
    assert of(df) != of(df.union(df.limit(1))) and of(df.where("id < 0")) != of(df)
    moved = df.withColumn("p", F.col("id")), df.withColumn("p", 99 - F.col("id"))
    one, two = (of(d.select("s", "p"), columns=["s"], position=["p"]) for d in moved)
    assert one != two
    # A null is not an absent value.
    a = spark.createDataFrame([(None, "x")], "a string, b string")
    assert of(a) != of(spark.createDataFrame([("x", None)], "a string, b string"))


@pytest.mark.parametrize("hashed", [False, True])
def test_digest_trees(spark, hashed):
    rows = [(k if k % 50 else None, f"s{k % 7}", None if k % 3 else k * 0.5) for k in range(-3000, 3000)]
    changed = [r for i, r in enumerate(rows) if i != 100]  # one gone, one changed, one twice, null and value exchanged
    changed[2000] = (changed[2000][0], "other", changed[2000][2])
    changed.append(changed[4000])
    schema = "k bigint, s string, v double"
    one, two = (spark.createDataFrame(r, schema) for r in (rows, changed))
    leaf = hashed_range(["k"], 8) if hashed else key_range("k", 5)
    trees = [digest_tree(t, leaf) for t in (one, one.repartition(3, "s"), two)]
    assert differing_ranges(*trees[:2]).count() == 0
    found = differing_ranges(trees[0], trees[2])
    widths = {r.level: r["count"] for r in found.groupBy("level").count().collect()}
    assert sorted(widths) == [0, 1, 2, 3] and 1 <= widths[3] <= widths[0] <= 3
    got = as_set(changed_rows(one, two, leaf))
    expected = [(*rows[100], 1, 1), (*rows[2001], 1, 1), (*changed[2000], 2, 1), (*changed[4000], 2, 1)]
    assert got == sorted(expected, key=repr)
    # Rows of other ranges are not looked into.
    assert rows_in_ranges(one, leaf, found).count() == found.where("level = 0").agg(F.sum("rows_1")).first()[0] < 300


def test_digest_trees_of_odd_tables(spark):
    empty = spark.createDataFrame([], "k int, range string, level string")
    some = spark.createDataFrame([(None, "x", None), (None, None, "x"), (5, "x", "x")], empty.schema)
    leaf = key_range("k")
    assert differing_ranges(digest_tree(empty, leaf), digest_tree(empty, leaf)).count() == 0
    assert as_set(changed_rows(empty, some, leaf)) == as_set(some.select("*", F.lit(2), F.lit(1).cast("bigint")))
    # Where a null stands counts.
    moved = spark.createDataFrame([(None, None, "x"), (None, None, "x"), (5, "x", "x")], empty.schema)
    assert as_set(changed_rows(some, moved, leaf)) == sorted([(None, "x", None, 1, 1), (None, None, "x", 2, 1)], key=repr)
    with pytest.raises(ValueError, match="already"):
        changed_rows(some, some, leaf, side="level")


def test_compare_example(spark):
    one = spark.createDataFrame([(1, 10), (2, 20)], "id int, value int")
    two = spark.createDataFrame([(1, 10), (2, 30)], "id int, value int")
    keys = compare_keys(one, two, ["id"]).first()
    assert (keys.rows_only_in_1, keys.rows_only_in_2, keys.rows_in_both) == (0, 0, 2)
    assert as_set(compare_values(one, two, ["id"])) == [("value", 1)]
    assert as_set(compare_samples(one, two, ["id"])) == [(2, "value", "20", "30")]
    shape = compare_shape(one, two).first()
    assert shape.shape_match and shape.columns_match
    assert not compare_shape(one, two.select("value", "id")).first().columns_match


def brute_force(one, two, tolerance):
    """All pairs of rows of equal key, as a merge would form them."""
    pairs = [(a, b) for a, b in itertools.product(one, two) if a[0] == b[0]]
    counts = {}
    for column, i in (("d", 1), ("s", 2)):
        for a, b in pairs:
            x, y = a[i], b[i]
            differs = (x is None) != (y is None) or (
                x is not None and (abs(x - y) > tolerance if column == "d" else x != y)
            )
            counts[column] = counts.get(column, 0) + differs
    only = [sum(1 for r in rows if r[0] not in {o[0] for o in other}) for rows, other in ((one, two), (two, one))]
    return {c: n for c, n in counts.items() if n}, (*only, len(pairs))


@pytest.mark.parametrize("tolerance", [1e-10, 0, 0.3, 2.5])
@pytest.mark.parametrize("seed", [1, 2])
def test_compare_against_brute_force(spark, tolerance, seed):
    rng = random.Random(seed)

    def table():
        # Key 0 is hot, keys from 5 on are mostly single, None is a key like any other.
        keys = [0] * 15 + [None] * 3 + [rng.randrange(1, 30) for _ in range(15)]
        return [(k, rng.choice([None, 0.0, -0.0, 0.25, 0.5, 1.0, 3.0, 1e9]), rng.choice(["x", "y", "", None])) for k in keys]

    one, two = table(), table()
    schema = "k int, d double, s string"
    df1, df2 = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema)
    differences, keys = brute_force(one, two, tolerance)
    got = compare_values(df1, df2, ["k"], tolerance).collect()
    assert {r.column: int(r.differences) for r in got} == differences
    assert tuple(map(int, compare_keys(df1, df2, ["k"]).first())) == keys


def test_compare_unique_keys(spark):
    one = spark.range(100).select("id", (F.col("id") * 1.0).alias("d"), F.lit("s").alias("s"))
    two = one.withColumn("d", F.when(F.col("id") < 10, F.col("d") + 1).otherwise(F.col("d") + 1e-12))
    assert as_set(compare_values(one, two, ["id"])) == [("d", 10)]
    assert [r.id for r in compare_samples(one, two, ["id"]).orderBy("id").collect()] == [0, 1, 2, 3, 4]


def test_compare_rows(spark):
    df = spark.range(20).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("b"))
    same = lambda a, b: compare_rows(a, b).first().data_equal
    assert same(df, df.repartition(5)) and same(df, df.select("b", "a"))
    assert not same(df, df.limit(19)) and not same(df, df.union(df)) and not same(df, df.drop("a"))


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, `b.c` string")
    assert as_set(profile(df)) == [(0, "a", "int", 1, 3), (1, "b.c", "string", 2, 3)]


# --- metrics

NOON = dt.datetime(2024, 1, 1, 12)


def test_run_and_step_metrics(spark):
    runs = spark.createDataFrame(
        [("p", "success", NOON, NOON, 2.0, 0, 0), ("q", "partial", NOON, NOON, 4.0, 10, 9)],
        "pipeline string, status string, started_at timestamp_ntz, ended_at timestamp_ntz, duration_seconds double, "
        "records_processed bigint, records_loaded bigint",
    )
    got = {(r.name, r.tags["pipeline"]): r for r in run_metrics(runs).collect()}
    assert len(got) == 12
    assert got["success_rate", "p"].value == 0.0 and got["success_rate", "q"].value == 0.9
    assert got["pipeline_start", "q"].tags["status"] == "started" and got["records_loaded", "q"].unit == "records"
    steps = spark.createDataFrame(
        [("p", "s", "ok", NOON, 2.0, 10), ("p", "t", "ok", NOON, 0.0, 10)],
        "pipeline string, step string, status string, ended_at timestamp_ntz, duration_seconds double, records_out bigint",
    )
    assert as_set(step_metrics(steps).where("name = 'step_throughput'").select(F.col("tags")["step"], "value")) == [("s", 5.0), ("t", 0.0)]


def test_summary_window(spark):
    rows = [("a", float(i), NOON + dt.timedelta(hours=i), {"pipeline": "p" if i < 3 else "q"}, f"u{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "name string, value double, timestamp timestamp_ntz, tags map<string,string>, unit string")
    now = F.lit(NOON + dt.timedelta(hours=5)).cast("timestamp_ntz")
    r = metrics_summary(df, now, since_hours=4).first()
    # The lower bound belongs to the window.
    assert (r["count"], r["min"], r["max"], r.avg, r.latest, r.unit) == (4, 1.0, 4.0, 2.5, 4.0, "u1")
    assert metrics_summary(df, now, "p").first()["count"] == 3


def test_alert_rules(spark):
    rows = [
        ("records_processed", 0.0, "p"),
        ("success_rate", 0.94, "q"),
        ("success_rate", 0.95, "p"),
        ("pipeline_duration_seconds", 1801.0, "q"),
        ("pipeline_duration_seconds", 1800.0, "p"),
    ]
    df = spark.createDataFrame(rows, "name string, value double, pipeline string").select(
        "name", "value", F.lit(NOON).cast("timestamp_ntz").alias("timestamp"), F.create_map(F.lit("pipeline"), "pipeline").alias("tags")
    )
    got = as_set(alert_candidates(metric_context(df)).select("pipeline", "alert"))
    # No throughput was measured, so that rule is silent.
    assert got == [("p", "no_records_processed"), ("q", "pipeline_duration_high"), ("q", "success_rate_low")]
    assert [r.cooldown_seconds for r in ALERT_RULES] == [3600, 1800, 3600, 1800]
    custom = [AlertRule("slow", "x", "x > 1", "info", "", 1)]
    assert alert_candidates(spark.createDataFrame([(2.0,)], "x double"), custom).first().alert == "slow"


def greedy(times, cooldown):
    fired = []
    for t in sorted(times):
        if not fired or (t - fired[-1]).total_seconds() >= cooldown:
            fired.append(t)
    return fired


@pytest.mark.parametrize("seed, cooldown", [(1, 5), (2, 60), (3, 1000), (4, 0.25)])
def test_cooldown_against_a_walk(spark, seed, cooldown):
    rng = random.Random(seed)
    # One alert holds most candidates; quiet times separate bursts, and instants repeat.
    rows = []
    for alert, n in (("hot", 600), ("mild", 60), ("rare", 1)):
        t = NOON
        for _ in range(n):
            t += dt.timedelta(seconds=rng.choice([0, 1, 2, 5, 5, 300] if rng.random() < 0.2 else [0, 1, 1.5]))
            rows.append((alert, t, float(cooldown)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "alert string, timestamp timestamp_ntz, cooldown_seconds double")
    expected = [(a, t) for a in ("hot", "mild", "rare") for t in greedy({r[1] for r in rows if r[0] == a}, cooldown)]
    assert as_set(alerts_with_cooldown(df)) == sorted(expected, key=repr)


def test_alert_events(spark):
    schema = "pipeline string, timestamp timestamp_ntz, success_rate double, records_processed double"
    context = spark.createDataFrame([("q", NOON, 0.5, 3.0), ("p", NOON, 0.9, None), ("p", NOON + dt.timedelta(seconds=5), 0.1, 0.0)], schema)
    candidates = alert_candidates(context)
    events = {r.name: r for r in alert_events(candidates, alerts_with_cooldown(candidates)).collect()}
    assert (events["success_rate_low"].timestamp, events["success_rate_low"].severity) == (NOON, "critical")
    assert events["success_rate_low"].context == {"success_rate": 0.9}
    assert events["no_records_processed"].message == "A run had no rows"


def test_cooldown_edges(spark):
    schema = "alert string, timestamp timestamp_ntz, cooldown_seconds int"
    later = NOON + dt.timedelta(seconds=10)
    exact = spark.createDataFrame([("a", NOON, 10), ("a", later, 10)], schema)
    assert alerts_with_cooldown(exact).count() == 2
    assert alerts_with_cooldown(spark.createDataFrame([("a", NOON, 11), ("a", later, 11)], schema)).count() == 1
    assert alerts_with_cooldown(spark.createDataFrame([("a", NOON, 0), ("a", NOON, 0)], schema)).count() == 2
    assert alerts_with_cooldown(spark.createDataFrame([], schema)).count() == 0


# --- sensitive data


def test_dropped_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "id int, email int, tender_key int, Home_Phone int")
    assert drop_sensitive_columns(df).columns == ["id", "tender_key", "Home_Phone"]
    assert drop_sensitive_like(df).columns == ["id"]


REDACTED = [
    ("mail a.b+c@x-y.example.org now", "mail [EMAIL REDACTED] now"),
    ("call +55 (123) 456-7890.", "call [PHONE REDACTED]."),
    ("cpf 123.456.789-09", "cpf [CPF REDACTED]"),
    ("bare 12345678909", "bare [PHONE REDACTED]"),
    ("cnpj 12.345.678/0001-95", "cnpj [CNPJ REDACTED]"),
    ("key sk-" + "a1" * 24 + "!", "key [API KEY REDACTED]!"),
    ("Authorization: Bearer abc.def-1", "Authorization: [TOKEN REDACTED]"),
    ("nothing here", "nothing here"),
    (None, None),
]


def test_redact(spark):
    df = spark.createDataFrame([(i, t, 5) for i, (t, _) in enumerate(REDACTED)], "i int, `the text` string, n int")
    once = redact(df)
    assert [r["the text"] for r in once.orderBy("i").collect()] == [e for _, e in REDACTED]
    assert as_set(redact(once)) == as_set(once)
    assert as_set(redact(df, [])) == as_set(df)


def test_redact_credentials(spark):
    text = "user: me\nPassword: hunter2\napi_key=abc client_secret:\n  xyz\nmail a@b.co"
    got = redact_credentials(spark.createDataFrame([(text,)], "t string"), ["t"]).first().t
    assert got == "user: me\nPassword: [REDACTED]\napi_key=[REDACTED] client_secret: [REDACTED]\nmail [EMAIL REDACTED]"


def test_scan(spark):
    text = "a@b.co A@B.CO 123-456-7890 PASSWORD = x SK-" + "Z" * 48
    df = spark.createDataFrame([(1, text), (2, "clean"), (3, None)], "id int, t string")
    got = {r.label: r.matches for r in scan_sensitive(df, "t", "id").collect()}
    assert got == {"Email": 2, "Phone": 1, "API Key": 1, "Credential": 1}


def test_values_of_repeated_keys_keep_all_digits(spark):
    money, more = Decimal("1000000000.0000000000"), Decimal("1000000000.0000000005")
    kinds = "k int, a decimal(38,10), b double, c bigint"
    one = spark.createDataFrame([(1, money, 2e9, 1), (2, money, 2e9, 1), (2, money, 3e9, None), (None, money, 1.0, 3)], kinds)
    two = spark.createDataFrame([(1, more, 2e9, 1), (2, more, 2e9, 1), (None, more, 1.0, 3), (3, more, 1.0, 3)], kinds)
    found = {r.column: int(r.differences) for r in compare_values(one, two, ["k"]).collect()}
    assert found == {"a": 4, "b": 1, "c": 1}
    near = {r.column: int(r.differences) for r in compare_values(one, two, ["k"], tolerance=1e-9).collect()}
    assert near == {"b": 1, "c": 1}


def test_hot_key_forms_no_pairs(spark):
    one = spark.range(3000).selectExpr("0 AS k", "id + 1e9D AS v")
    two = spark.range(3000).selectExpr("0 AS k", "id + 1e9D + 1 AS v")
    assert [int(r.differences) for r in compare_values(one, two, ["k"]).collect()] == [3000 * 3000 - 2999]


def test_samples_of_repeated_keys(spark):
    one = spark.createDataFrame([(1, v) for v in (1, 1, 2, None, 9)], "k int, v int")
    two = spark.createDataFrame([(1, v) for v in (1, 2, 2)], "k int, v int")
    found = [(r.value_1, r.value_2) for r in compare_samples(one, two, ["k"]).collect()]
    assert sorted(found, key=str) == sorted([(None, "1"), (None, "2"), ("1", "2"), ("2", "1"), ("9", "1")], key=str)


def test_rows_of_other_types_are_not_equal(spark):
    df = spark.range(3)
    assert compare_rows(df, df.selectExpr("id")).first()[0]
    assert not compare_rows(df, df.selectExpr("CAST(id AS INT) AS id")).first()[0]


def test_values_are_compared_in_one_join_of_the_tables(spark):
    """Rows are not sorted before the exchange, and each table is read once for its single keys."""
    one = materialize(spark.range(200).selectExpr("id % 190 AS k", "cast(id AS string) AS s"))
    two = materialize(spark.range(200).selectExpr("id % 190 AS k", "cast(id + int(id % 7 = 0) AS string) AS s"))
    found = compare_values(one, two, ["k"])
    assert "SortAggregate" not in plan_of(found)
    pairs = one.join(two.withColumnRenamed("s", "t"), "k").where("s <> t").count()
    assert [int(r.differences) for r in found.collect()] == [pairs]
    samples = compare_samples(one, two, ["k"])
    assert plan_of(samples).count("ReadSchema: struct<k:bigint,s:string>") == 2
    assert len(samples.collect()) == 5


def test_values_are_counted_in_passes_that_leave_nothing(spark, monkeypatch):
    """Keys dealt to passes, few or many rows of a key: equal to all pairs, and no intermediate table is left."""
    monkeypatch.setattr(diff, "PASS_ROWS", 60)
    monkeypatch.setattr(diff, "FORMED", 3)
    rng = random.Random(5)

    def rows(n):
        keys = [0] * 20 + [None] * 5 + [rng.randrange(1, 60) for _ in range(n)]
        return [(k, rng.choice([None, 0.0, -0.0, 0.25, 1e9]), rng.choice(["x", "y", None])) for k in keys]

    one, two = rows(150), rows(170)
    dfs = spark.createDataFrame(one, "k int, d double, s string"), spark.createDataFrame(two, "k bigint, d double, s string")
    assert diff._passes(*dfs, ["k"]) == 7
    # Equal keys of such types have other hashes.
    assert diff._passes(dfs[0], dfs[1].withColumn("k", F.col("k").cast("string")), ["k"]) == 1
    written = lambda: set(Path(scratch_dir(spark).removeprefix("file://")).glob("*"))
    before = written()
    for tolerance in (1e-10, 0.3):
        got = compare_values(*dfs, ["k"], tolerance).collect()
        assert {r.column: int(r.differences) for r in got} == brute_force(one, two, tolerance)[0]
    assert written() == before


def test_few_rows_of_a_key_are_compared_without_counting_values(spark, monkeypatch):
    """Values are only counted where a key repeats often; before, every key held twice was."""
    counted = []
    monkeypatch.setattr(diff, "_equal_pairs", lambda sides, *rest, f=diff._equal_pairs: counted.append(sides.count()) or f(sides, *rest))
    one = spark.range(400).selectExpr("id % 100 AS k", "id AS v")
    assert [int(r.differences) for r in compare_values(one, one, ["k"]).collect()] == [100 * 12] and not counted
    hot = one.union(spark.range(40).selectExpr("7 AS k", "id AS v"))
    pairs = one.alias("a").join(hot.alias("b"), "k").where("a.v <> b.v").count()
    assert [int(r.differences) for r in compare_values(one, hot, ["k"]).collect()] == [pairs] and counted == [48]


@pytest.mark.parametrize("kind", ["decimal(38,10)", "decimal(12,2)", "decimal(38,18)"])
@pytest.mark.parametrize("tolerance", [1e-10, 2.5e-10, 0.01, 0.3])
def test_decimals_keep_all_digits_at_the_tolerance(spark, kind, tolerance):
    """Also those of 38 digits, whose difference fits no decimal."""
    scale = int(kind[:-1].split(",")[1])
    last, apart = Decimal(1).scaleb(-scale), Decimal(repr(tolerance))
    bases = [Decimal(0), Decimal("-7.5"), Decimal("99999999.25")]
    if kind == "decimal(38,10)":
        bases += [Decimal("1e26"), Decimal("9999999999999999999999999990"), Decimal("-9999999999999999999999999990")]
    with localcontext(prec=60):
        whole = apart.quantize(last)
        steps = [Decimal(0), last, whole, whole + last, -whole, -whole - last]
        rows = [(i, a, a + s) for i, (a, s) in enumerate(itertools.product(bases, steps))]
        rows += [(-1, None, Decimal(0)), (-2, None, None), (-3, Decimal(0), None), (-4, bases[-1], bases[0])]
        expected = sum((a is None) != (b is None) or (a is not None and abs(a - b) > apart) for _, a, b in rows)
    text = spark.createDataFrame([(i, *(None if v is None else f"{v:f}" for v in (a, b))) for i, a, b in rows], "k int, a string, b string")
    one, two = (text.select("k", F.col(c).cast(kind).alias("v")) for c in "ab")
    assert [int(r.differences) for r in compare_values(one, two, ["k"], tolerance).collect()] == [expected]
