"""Run metrics as tables: recording, summary, alert rules, cooldown."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.operators.missing import fill_directional
from tabprep.scratch import BUCKET, materialize, range_buckets


def _metric(name: str, value: Column, at: str, tags: dict[str, Column], unit: str) -> Column:
    entries = [part for k, v in tags.items() for part in (F.lit(k), v)]
    return F.struct(
        F.lit(name).alias("name"),
        value.cast("double").alias("value"),
        F.col(at).alias("timestamp"),
        F.create_map(*entries).alias("tags"),
        F.lit(unit).alias("unit"),
    )


def _share(part: str, whole: str) -> Column:
    """Quotient, 0 unless the divisor is positive."""
    ratio = F.col(part).cast("double") / F.col(whole).cast("double")
    return F.when(F.col(whole) > 0, ratio).otherwise(F.lit(0.0))


def run_metrics(runs: DataFrame) -> DataFrame:
    """Metric rows of finished runs.

    ``runs`` has pipeline, status, started_at, ended_at, duration_seconds, records_processed,
    records_loaded.
    """
    pipeline = {"pipeline": F.col("pipeline")}
    finished = {**pipeline, "status": F.col("status")}
    rows = [
        _metric("pipeline_start", F.lit(1), "started_at", {**pipeline, "status": F.lit("started")}, ""),
        _metric("pipeline_end", F.lit(1), "ended_at", finished, ""),
        _metric("pipeline_duration_seconds", F.col("duration_seconds"), "ended_at", finished, "seconds"),
        _metric("records_processed", F.col("records_processed"), "ended_at", pipeline, "records"),
        _metric("records_loaded", F.col("records_loaded"), "ended_at", pipeline, "records"),
        _metric("success_rate", _share("records_loaded", "records_processed"), "ended_at", pipeline, "percent"),
    ]
    return runs.select(F.inline(F.array(*rows)))


def step_metrics(steps: DataFrame) -> DataFrame:
    """Metric rows of finished steps.

    ``steps`` has pipeline, step, status, ended_at, duration_seconds, records_out.
    """
    step = {"pipeline": F.col("pipeline"), "step": F.col("step")}
    rows = [
        _metric("step_duration_seconds", F.col("duration_seconds"), "ended_at", {**step, "status": F.col("status")}, "seconds"),
        _metric("step_throughput", _share("records_out", "duration_seconds"), "ended_at", step, "records/sec"),
    ]
    return steps.select(F.inline(F.array(*rows)))


def metrics_summary(
    metrics: DataFrame,
    now: Column,
    pipeline: str | None = None,
    since_hours: float = 24,
    order_by: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Per metric name of a recent window: count, min, max, avg, latest value, unit of the first.

    ``order_by`` gives the order of recording; all aggregates combine partially.
    """
    recent = metrics.where(F.col("timestamp") >= now - F.make_dt_interval(secs=F.lit(since_hours * 3600)))
    if pipeline is not None:
        recent = recent.where(F.col("tags")["pipeline"] == pipeline)
    recorded = F.struct(*order_by)
    return recent.groupBy("name").agg(
        F.count("*").alias("count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("avg"),
        F.max_by("value", recorded).alias("latest"),
        F.min_by("unit", recorded).alias("unit"),
    )


class AlertRule(NamedTuple):
    """An alert fires where ``condition``, SQL over metric names, holds; a missing metric never does."""

    name: str
    metric: str
    condition: str
    severity: str
    message: str
    cooldown_seconds: int


# Names, conditions, severities and cooldowns of the standard alerts.
ALERT_RULES = (
    AlertRule(
        "pipeline_duration_high",
        "pipeline_duration_seconds",
        "pipeline_duration_seconds > 1800",
        "warning",
        "A run took more than half an hour",
        3600,
    ),
    AlertRule(
        "success_rate_low",
        "success_rate",
        "success_rate < 0.95",
        "critical",
        "More than one run in twenty failed",
        1800,
    ),
    AlertRule(
        "no_records_processed",
        "records_processed",
        "records_processed = 0",
        "warning",
        "A run had no rows",
        3600,
    ),
    AlertRule(
        "step_throughput_low",
        "step_throughput",
        "step_throughput < 100",
        "info",
        "A step handled fewer than 100 rows a second",
        1800,
    ),
)


def metric_context(
    metrics: DataFrame, by: Sequence[str] = ("pipeline", "timestamp"), rules: Sequence[AlertRule] = ALERT_RULES
) -> DataFrame:
    """Metric rows turned to one column per metric the rules look at, one row per ``by``.

    The names are known from the rules, so no pass over the data is spent on finding them.
    """
    names = sorted({r.metric for r in rules})
    flat = metrics.withColumn("pipeline", F.col("tags")["pipeline"])
    return flat.where(F.col("name").isin(names)).groupBy(*by).pivot("name", names).agg(F.max("value"))


def alert_candidates(context: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES) -> DataFrame:
    """One row per context row and rule whose condition holds there."""
    fired = [
        F.when(
            F.expr(r.condition),
            F.struct(
                F.lit(r.name).alias("alert"),
                F.lit(r.severity).alias("severity"),
                F.lit(r.message).alias("message"),
                F.lit(r.cooldown_seconds).alias("cooldown_seconds"),
            ),
        )
        for r in rules
        if r.metric in context.columns
    ]
    return context.select("*", F.inline(F.array_compact(F.array(*fired))))


def alerts_with_cooldown(candidates: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Times at which each alert fires, when a firing silences it for ``cooldown_seconds``.

    ``candidates`` has alert, the time column and cooldown_seconds (one value per alert). Firings
    form a chain: each is followed by the first candidate at or after the end of its cooldown. One
    hot alert may hold most candidates, so its chain is not walked in one task:

    1. Candidates are cut into ranges of (alert, time). Within its range each candidate is given
       the time from which the alert is free again once the chain through it leaves the range.
       Chains soon merge, so these times are few.
    2. Each such time is matched with the first candidate from then on, by a directional fill.
    3. What is left are links from range to range. They are doubled until the chain from the
       first candidate is known, in rounds that grow with the logarithm of the number of ranges.
    4. Every range walks its own part of the chain, from the candidate at which it is entered.
    """
    at = F.col(time_column).cast("timestamp_ntz").alias("at")
    cooldown = F.col("cooldown_seconds").cast("double").alias("cooldown")
    slim = materialize(candidates.select("alert", at, cooldown))
    # Candidates at one instant count once: the first silences the others.
    instants = slim.where(F.col("cooldown") > 0).groupBy("alert", "at").agg(F.max("cooldown").alias("cooldown"))
    nodes = range_buckets(instants, ["alert", "at"], unique=True)
    ranges = nodes.groupBy(BUCKET, "alert")
    chains = materialize(ranges.applyInPandas(_leave_range, "alert string, at timestamp_ntz, onward timestamp_ntz"))

    # A probe sorts before a candidate of the same instant, which it may fire.
    nothing = F.lit(None).cast("timestamp_ntz")
    timeline = chains.select("alert", "at", F.lit(1).alias("kind"), F.col("at").alias("hit"), "onward").unionByName(
        chains.select("alert", F.col("onward").alias("at"))
        .distinct()
        .select("alert", "at", F.lit(0).alias("kind"), nothing.alias("hit"), nothing.alias("onward"))
    )
    filled = fill_directional(timeline, ["hit", "onward"], ["at", "kind"], ["alert"], forward=False, unique=True)
    links = materialize(filled.where((F.col("kind") == 0) & F.col("hit").isNotNull()).drop("kind"))

    first = chains.groupBy("alert").agg(F.min_by(F.struct(F.col("at").alias("hit"), "onward"), "at").alias("f"))
    first = materialize(first.select("alert", "f.*"))
    entered = _follow(first.select("alert", F.col("onward").alias("at")), links.drop("hit"))
    entries = first.select("alert", "hit").unionByName(entered.join(links, ["alert", "at"]).select("alert", "hit"))

    starts = entries.withColumnRenamed("hit", "at").join(nodes, ["alert", "at"])
    starts = materialize(starts.select(BUCKET, "alert", F.col("at").alias("start")))
    walked = nodes.join(starts, [BUCKET, "alert"]).groupBy(BUCKET, "alert")
    fired = walked.applyInPandas(_walk_range, "alert string, at timestamp_ntz")
    # Without a cooldown every candidate fires.
    always = slim.where(F.col("cooldown") <= 0).select("alert", "at")
    kind = candidates.schema[time_column].dataType
    return fired.unionByName(always).select("alert", F.col("at").cast(kind).alias(time_column))


def alert_events(
    candidates: DataFrame,
    fired: DataFrame,
    rules: Sequence[AlertRule] = ALERT_RULES,
    time_column: str = "timestamp",
    source: str = "pipeline",
) -> DataFrame:
    """Log entries of the fired alerts: severity, message and the metrics that set them off.

    Of several candidates at one instant the first by ``source`` speaks for the alert.
    """
    names = [r for r in sorted({r.metric for r in rules}) if r in candidates.columns]
    entries = [part for n in names for part in (F.lit(n), F.col(n).cast("double"))]
    context = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())
    details = F.struct("severity", "message", context.alias("context"))
    spoken = candidates.groupBy("alert", time_column).agg(F.min_by(details, source).alias("d"))
    return fired.join(spoken, ["alert", time_column]).select(
        F.col("alert").alias("name"), "d.severity", "d.message", F.col(time_column).alias("timestamp"), "d.context"
    )


def _follow(reached: DataFrame, links: DataFrame) -> DataFrame:
    """All times reached from the given ones over links ``(alert, at) -> onward``, by doubling."""
    known = materialize(reached)
    while True:
        step = materialize(known.join(links, ["alert", "at"]).select("alert", F.col("onward").alias("at")))
        if step.isEmpty():
            return known
        known = known.unionByName(step)
        further = links.select("alert", F.col("at").alias("onward"), F.col("onward").alias("beyond"))
        links = links.join(further, ["alert", "onward"]).select("alert", "at", F.col("beyond").alias("onward"))
        links = materialize(links)


def _following(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted candidates of a range, the end of the cooldown of each, and the next firing's position."""
    times = np.sort(pdf["at"].to_numpy())
    free = times + np.timedelta64(int(pdf["cooldown"].iloc[0] * 1_000_000), "us")
    return times, free, np.searchsorted(times, free)


def _leaps(following: np.ndarray) -> list[np.ndarray]:
    """Positions after 1, 2, 4, ... firings; the number of candidates stands for beyond the range."""
    leaps = [np.append(following, len(following))]
    while (leaps[-1] < len(following)).any():
        leaps.append(leaps[-1][leaps[-1]])
    return leaps


def _leave_range(pdf: pd.DataFrame) -> pd.DataFrame:
    times, free, following = _following(pdf)
    last = np.arange(len(times))
    for leap in reversed(_leaps(following)):
        last = np.where(leap[last] < len(times), leap[last], last)
    return pd.DataFrame({"alert": pdf["alert"].iloc[0], "at": times, "onward": free[last]})


def _walk_range(pdf: pd.DataFrame) -> pd.DataFrame:
    times, _, following = _following(pdf)
    fired = np.searchsorted(times, pdf["start"].to_numpy()[:1])
    for leap in _leaps(following):
        fired = np.concatenate([fired, leap[fired]])
    fired = np.unique(fired[fired < len(times)])
    return pd.DataFrame({"alert": pdf["alert"].iloc[0], "at": times[fired]})
