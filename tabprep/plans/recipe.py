"""Declarative recipes: named steps over lazy frames, one Spark job per sink."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from tabprep.operators.cleaning import clean_tenders
from tabprep.operators.enrichment import calculated_fields, financial_periods, spreads
from tabprep.operators.validation import validate_tenders, validate_transactions, validation_summary, with_status
from tabprep.sinks.database import write_jdbc
from tabprep.sinks.files import counted, write_csv, write_json, write_parquet, write_quarantine, write_tables
from tabprep.sinks.workbook import write_excel
from tabprep.sources.files import read_any, read_csv
from tabprep.sources.odata import read_odata_pages
from tabprep.sources.workbook import read_excel

Step = Mapping[str, Any]
Custom = Callable[[Mapping[str, DataFrame], Mapping[str, Any]], DataFrame]


@dataclass
class Run:
    """Outcome of a recipe: ``success``, or ``partial`` when an optional step failed."""

    name: str
    status: str = "success"
    steps_completed: list[str] = field(default_factory=list)
    steps_failed: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    metrics: dict[str, float] = field(default_factory=dict)
    summaries: dict[str, DataFrame] = field(default_factory=dict)
    frames: dict[str, DataFrame] = field(default_factory=dict)


def load_config(path: str) -> dict[str, Any]:
    """Recipe from a YAML file."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading a recipe file needs PyYAML; pass a dict instead") from e
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def check_steps(steps: list[Step]) -> list[str]:
    """Problems in the step list: unknown dependencies and cycles."""
    names = {s["name"] for s in steps}
    problems = [
        f"{s['name']}: unknown dependency {d}" for s in steps for d in s.get("depends_on", ()) if d not in names
    ]
    if not problems:
        stuck = [s["name"] for s in steps if s not in _in_order(steps)]
        if stuck:
            problems.append(f"cannot resolve dependencies of: {', '.join(stuck)}")
    return problems


def _in_order(steps: list[Step]) -> list[Step]:
    """Steps after their dependencies, otherwise as listed; steps of a cycle are left out."""
    ordered: list[Step] = []
    waiting = list(steps)
    while True:
        done = {s["name"] for s in ordered}
        ready = next((s for s in waiting if done.issuperset(s.get("depends_on", ()))), None)
        if ready is None:
            return ordered
        ordered.append(ready)
        waiting.remove(ready)


# --- steps by kind


def _extract(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    kind, path = config.get("extractor", "excel"), config["file_path"]
    common = {
        "dtypes": config.get("dtype_overrides"),
        "parse_dates": config.get("parse_dates", ()),
    }
    if kind == "excel":
        return read_excel(
            spark,
            path,
            config.get("sheet_name", 0),
            config.get("header_row", 0),
            config.get("skip_rows", ()),
            columns=config.get("columns"),
            **common,
        )
    if kind == "csv":
        return read_csv(
            spark,
            path,
            config.get("schema"),
            config.get("encoding", "utf-8"),
            config.get("delimiter", ","),
            multi_line=config.get("multi_line", False),
            **common,
        )
    if kind == "odata":
        wanted = {k: config[k] for k in ("filter", "select", "top", "multi_line") if k in config}
        return read_odata_pages(spark, path, **wanted)
    if kind == "file":
        return read_any(spark, path, config.get("multi_line", False))
    raise ValueError(f"unknown extractor {kind!r}")


def _validate(df: DataFrame, config: Mapping[str, Any], run: Run, name: str) -> DataFrame:
    """Report on bad rows and let them pass, or with ``mode: split`` keep only the valid ones.

    ``contract`` says what the rows are checked as: ``tender`` or ``transaction``.
    """
    threshold = config.get("quarantine_threshold", 0.5)
    contract = config.get("contract", "tender")
    if contract not in CONTRACTS:
        raise ValueError(f"unknown contract {contract!r}")
    checked = CONTRACTS[contract](df, threshold)
    run.summaries[name] = validation_summary(checked, threshold)
    if config.get("mode", "report") == "report":
        return df
    if "quarantine_path" in config:
        return write_quarantine(checked, config["quarantine_path"])
    return with_status(checked, "valid")


CONTRACTS = {"tender": validate_tenders, "transaction": validate_transactions}

TRANSFORMS: dict[str, Callable[[DataFrame, Mapping[str, Any]], DataFrame]] = {
    "clean_tender": lambda df, c: clean_tenders(df, c.get("probability", "amount")),
    "calculate_spreads": lambda df, c: spreads(df),
    "add_financial_periods": lambda df, c: financial_periods(
        df, c.get("date_column", "Date"), c.get("fiscal_year_start_month", 1)
    ),
    "add_calculated_fields": lambda df, c: calculated_fields(df, c.get("source_type", "tender")),
}


def _load(df: DataFrame, config: Mapping[str, Any]) -> int:
    kind = config.get("loader", "excel")
    if kind == "database":
        return write_jdbc(
            df,
            config["url"],
            config.get("table_name") or config["table"],
            config.get("schema", "staging"),
            config.get("if_exists", "append"),
            config.get("chunk_size", 10000),
            properties=config.get("properties"),
        )
    path = config["output_path"]
    if kind == "excel":
        return write_excel(df, path, config.get("sheet_name", "Data"))
    if kind == "multi_excel":
        return sum(write_tables({"Data": df}, path).values())
    if kind == "csv":
        return write_csv(
            df,
            path,
            config.get("encoding", "utf-8"),
            config.get("delimiter", ","),
            config.get("date_format", "yyyy-MM-dd"),
        )
    if kind == "parquet":
        return write_parquet(df, path, config.get("compression", "snappy"))
    if kind == "json":
        return write_json(df, path)
    raise ValueError(f"unknown loader {kind!r}")


def run_recipe(
    spark: SparkSession,
    config: Mapping[str, Any],
    dry_run: bool = False,
    custom: Mapping[str, Custom] | None = None,
) -> Run:
    """Run the steps of ``config["transforms"]``.

    Extract and transform steps only build frames; a load step is one Spark job. A step works on
    the frame of its last dependency. ``custom`` holds functions for steps whose type is their
    key. A failing step stops the run unless it is ``optional``; ``dry_run`` builds and analyses
    all frames and writes nothing.
    """
    steps = list(config["transforms"])
    problems = check_steps(steps)
    if problems:
        raise ValueError("; ".join(problems))

    run = Run(config.get("name", "recipe"))
    started = time.monotonic()
    read: dict[str, Observation] = {}
    written: list[str] = []
    kept: list[DataFrame] = []
    loaded = 0
    sinks = [s["depends_on"][-1] for s in steps if s.get("type") == "load" and s.get("depends_on")]
    try:
        for step in _in_order(steps):
            name, kind, settings = step["name"], step.get("type", "transform"), step.get("config") or {}
            try:
                if kind == "extract":
                    frame, seen = counted(_extract(spark, settings))
                    read[name] = seen
                elif kind == "transform":
                    frame = _transform(_input(run, step), settings, run, name)
                elif kind == "load":
                    frame = _input(run, step)
                    if not dry_run:
                        loaded += _load(frame, settings)
                        written.append(name)
                elif custom and kind in custom:
                    frame = custom[kind](run.frames, settings)
                else:
                    raise ValueError(f"unknown step type {kind!r}")
                if kind != "load":
                    if sinks.count(name) > 1 and not dry_run:
                        # Several sinks read this step: compute it once.
                        frame = frame.persist()
                        kept.append(frame)
                    run.frames[name] = frame
                run.steps_completed.append(name)
            except Exception as e:
                run.steps_failed.append(name)
                run.errors.append(f"{name}: {e}")
                if not step.get("optional", False):
                    run.status = "failed"
                    raise
                run.status = "partial"
    finally:
        for frame in kept:
            frame.unpersist()
    if not dry_run:
        # An observation only gets its value from a sink that reads the frame.
        sources = _sources(steps, written)
        run.metrics["records_processed"] = sum(read[s].get["records"] for s in sources if s in read)
        run.metrics["records_loaded"] = loaded
    run.metrics["duration_seconds"] = time.monotonic() - started
    run.metrics["steps_completed"] = len(run.steps_completed)
    run.metrics["steps_failed"] = len(run.steps_failed)
    return run


def _input(run: Run, step: Step) -> DataFrame:
    dependency = (step.get("depends_on") or [None])[-1]
    if dependency not in run.frames:
        raise ValueError(f"step {step['name']} has no input frame")
    return run.frames[dependency]


def _sources(steps: list[Step], written: list[str]) -> set[str]:
    """Steps at the start of the chains of last dependencies that end in the given sinks.

    A custom step may or may not use its inputs, so a chain ends there too.
    """
    by_name = {s["name"]: s for s in steps}
    found = set()
    for name in written:
        step = by_name[name]
        while step.get("type", "transform") in ("load", "transform") and step.get("depends_on"):
            step = by_name[step["depends_on"][-1]]
        found.add(step["name"])
    return found


def _transform(df: DataFrame, settings: Mapping[str, Any], run: Run, name: str) -> DataFrame:
    transform = settings.get("transform")
    if transform == "validate":
        return _validate(df, settings, run, name)
    if transform not in TRANSFORMS:
        raise ValueError(f"unknown transform {transform!r}")
    return TRANSFORMS[transform](df, settings)
