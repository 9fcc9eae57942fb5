"""R2: run the registry over the feed tables and write one table per result.

Isolation rules: no events table -> nothing runs; an analysis whose input is
missing is skipped with a status; a failing analysis does not stop the
others, nor does one that exceeds ``time_limit``: its jobs alone are cancelled,
by their tag.  Analyses are submitted from ``parallel`` threads, each in a
scheduler pool of its own, so small ones do not queue behind a large one (with
``spark.scheduler.mode`` FAIR).

Each result's plan executes once (the write); its row count is then read from
the written table's footers, and the new table replaces the old one only when
complete.  Shared bases (one pass over a feed for many analyses) and the small
inputs of ``STAGED_INPUTS`` are written under the shared checkpoint location and
removed at the end.  Results with lookup keys are written sorted on them.  The
run record (one row per analysis) is written last, so it describes what actually
happened.
"""

from __future__ import annotations

import datetime as dt
import inspect
import logging
import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from eventlens.operators import ANALYSES
from eventlens.operators.common import hourly_mentions
from eventlens.operators.mentions import escalation_hours
from eventlens.operators.rollup import event_codes, event_measures
from eventlens.session import remove_path, scratch_path, write_and_read
from eventlens.sources.sinks import RUN_RECORD, read_result, run_record, write_result
from eventlens.sources.slots import retain_since
from eventlens.sources.tables import load_table

log = logging.getLogger(__name__)

# --- fixed values: the lookup keys the reference indexes its results on ---
RESULT_KEYS = {
    "conflict_heatmap": ["event_date", "country_code"],
    "top_countries_events": ["event_date", "rank"],
    "sentiment_trend": ["country_code", "event_date"],
    "top_organizations": ["event_date", "rank"],
}
# --- end of fixed values ---


def clustered(name: str, result: DataFrame) -> DataFrame:
    """Sort each output file on the result's lookup keys (a local sort, no
    shuffle), so Parquet min/max statistics let readers skip row groups on
    those keys: the table-format counterpart of an index."""
    keys = RESULT_KEYS.get(name)
    return result.sortWithinPartitions(*keys) if keys else result


# Columns each analysis family reads; inputs are pruned to these before an
# optional persist (a cache of full feed rows would hold every column).
INPUT_COLUMNS = {
    "events": [
        "GLOBALEVENTID", "SQLDATE", "DATEADDED", "QuadClass", "GoldsteinScale", "AvgTone",
        "NumMentions", "NumSources", "EventCode", "EventBaseCode", "EventRootCode",
        "ActionGeo_CountryCode", "Actor1CountryCode", "Actor2CountryCode",
        "Actor1EthnicCode", "Actor2EthnicCode", "Actor1Religion1Code", "Actor2Religion1Code",
        "Actor1Type1Code", "Actor2Type1Code",
    ],
    "mentions": ["GLOBALEVENTID", "MentionTimeDate", "MentionSourceName"],
    "gkg": ["DATE", "V2Themes", "Locations", "V2Organizations"],
}


def load_inputs(
    spark: SparkSession,
    table_root: str,
    retain_hours: float | None = None,
    now: dt.datetime | str | None = None,
) -> dict[str, DataFrame | None]:
    """The feed tables; with ``retain_hours`` only slots not older than
    ``now - retain_hours`` (pruned on the partition columns, not deleted)."""
    if retain_hours is None:
        return {t: load_table(spark, table_root, t) for t in INPUT_COLUMNS}
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    at = dt.datetime.fromisoformat(str(now)) - dt.timedelta(hours=retain_hours)
    since = at.strftime("%Y%m%d%H%M%S")
    tables = {t: load_table(spark, table_root, t, since=since) for t in INPUT_COLUMNS}
    return {
        t: None if df is None else retain_since(df, now, hours=retain_hours)
        for t, df in tables.items()
    }


def run_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    out_root: str,
    fmt: str = "parquet",
    write_empty: bool = True,
    persist_inputs: bool = False,
    analyses: Sequence = ANALYSES,
    params: Mapping[str, dict] | None = None,
    share_bases: bool = True,
    bases: Mapping[str, DataFrame] | None = None,
    parallel: int = 4,
    time_limit: float | None = None,
) -> list[dict]:
    """Run ``analyses`` on ``tables``; returns one status dict per analysis.

    With ``share_bases`` the roll-ups of events (``event_measures``,
    ``event_codes``) and the hourly (event x hour) base of 09/17 are built once
    and staged in the shared checkpoint folder: two passes over events serve
    fourteen analyses, one over mentions serves two.  ``bases`` are already
    written ones by parameter name (an incremental run's merged partials).
    ``time_limit`` is in seconds per analysis, from its own start.
    """
    params = params or {}
    if tables.get("events") is None:
        raise RuntimeError("no events table: load data first")

    inputs: dict[str, DataFrame | None] = {}
    for name, df in tables.items():
        if df is not None and persist_inputs:
            df = df.select(*INPUT_COLUMNS.get(name, df.columns)).persist()
        inputs[name] = df

    staging: list[str] = []
    shared = dict(bases or {})
    if share_bases:
        wanted = _wanted_bases(analyses, params) - set(shared)
        shared |= _shared_bases(spark, inputs, wanted, staging, parallel)

    def prepared(name: str, fn: Callable, required: Sequence[str]) -> DataFrame:
        kwargs = dict(params.get(name, {}))
        accepted = inspect.signature(fn).parameters
        for base_name, base in shared.items():
            if _takes_base(base_name, accepted, kwargs):
                kwargs[base_name] = base
        if name in STAGED_INPUTS:
            parameter, table, build = STAGED_INPUTS[name]
            if parameter in accepted and parameter not in kwargs:
                own = {k: v for k, v in kwargs.items() if k in inspect.signature(build).parameters}
                kwargs[parameter] = _stage(spark, build(inputs[table], **own), parameter, staging)
        return clustered(name, fn(*[inputs[t] for t in required], **kwargs))

    def run_one(name: str, fn: Callable, required: Sequence[str], proceed: Callable[[], bool]) -> dict:
        missing = [t for t in required if inputs.get(t) is None]
        if missing:
            return {"status": "skipped", "message": f"missing input: {', '.join(missing)}"}
        result = prepared(name, fn, required)
        if write_empty:
            write_result(result, out_root, name, fmt, proceed)
            rows = read_result(spark, out_root, name, fmt).count()
        else:
            # Keep the previous result when the new one is empty: run
            # the plan once, into staging, and copy a non-empty result.
            result = _stage(spark, result, f"result-{name}", staging)
            rows = result.count()
            if rows:
                write_result(result, out_root, name, fmt, proceed)
        return {"status": "ok" if rows else "empty", "rows": rows}

    try:
        jobs = {name: (lambda proceed, a=(name, fn, required): run_one(*a, proceed)) for name, fn, required in analyses}
        outcomes = run_concurrently(spark, jobs, parallel, time_limit)
    finally:
        for df in inputs.values():
            if df is not None and persist_inputs:
                df.unpersist()
        for path in staging:
            try:
                remove_path(spark, path)
            except Exception as exc:
                log.warning("staging folder %s not removed: %s", path, exc)

    statuses = [{"analysis": name, **outcomes[name]} for name, _, _ in analyses]
    write_result(run_record(spark, statuses, dt.datetime.now(dt.timezone.utc)), out_root, RUN_RECORD, fmt)
    return statuses


def run_concurrently(
    spark: SparkSession,
    jobs: Mapping[str, Callable[[Callable[[], bool]], dict]],
    parallel: int = 4,
    time_limit: float | None = None,
) -> dict[str, dict]:
    """Run named driver functions in up to ``parallel`` threads; their dicts.

    Each runs in a scheduler pool and under a job tag of its own.  One that
    raises gives ``status`` failed.  One that exceeds ``time_limit`` seconds is
    failed at once: the jobs of its tag are cancelled, its slot is free for the
    next, and the function handed to it (may I still publish?) says no from then on.
    """
    sc = spark.sparkContext
    run_id = uuid.uuid4().hex[:8]
    waiting = list(jobs)
    running: dict[str, tuple[float, threading.Event]] = {}
    given_up: set[str] = set()
    outcomes: dict[str, dict] = {}
    changed = threading.Condition()

    def tag(name: str) -> str:
        return f"analysis-{run_id}-{name}"

    def work(name: str, stopped: threading.Event) -> None:
        started = time.perf_counter()
        try:
            sc.setLocalProperty("spark.scheduler.pool", name)
            sc.addJobTag(tag(name))
            outcome = jobs[name](lambda: not stopped.is_set())
        except Exception as exc:  # isolate: one failure leaves the others
            log.error("analysis %s failed: %s", name, exc)
            outcome = {"status": "failed", "message": str(exc)[:1000]}
        with changed:
            outcomes.setdefault(name, {**outcome, "seconds": round(time.perf_counter() - started, 3)})
            running.pop(name, None)
            changed.notify()

    with changed:
        while len(outcomes) < len(jobs):
            while waiting and len(running) < max(1, parallel):
                name, stopped = waiting.pop(0), threading.Event()
                running[name] = (time.perf_counter(), stopped)
                threading.Thread(target=inheritable_thread_target(spark)(work), args=(name, stopped), daemon=True).start()
            changed.wait(timeout=0.2 if time_limit or given_up else None)
            for name, (started, stopped) in list(running.items()):
                if time_limit and time.perf_counter() - started > time_limit:
                    stopped.set()
                    given_up.add(name)
                    running.pop(name)
                    outcomes[name] = {"status": "failed", "message": f"time limit of {time_limit:g} s exceeded",
                                      "seconds": round(time.perf_counter() - started, 3)}
            for name in given_up:  # again and again: it may submit another job
                sc.cancelJobsWithTag(tag(name))
    return outcomes


def _stage(spark: SparkSession, df: DataFrame, name: str, staging: list[str]) -> DataFrame:
    path = scratch_path(spark, f"base-{name}")
    staging.append(path)
    return write_and_read(df, path)


# Analyses that take a small intermediate as a written table, so that the planner
# knows its size: parameter, input table, builder.
STAGED_INPUTS = {"escalation_events": ("hours", "mentions", escalation_hours)}

# Parameters a base is built with; an analysis called with its own value of one
# must not be handed the base.
BASE_PARAMETERS = {"daily": {"quad"}}

# Bases staged by a pass over one feed.
STAGED_BASES = {
    "measures": ("events", event_measures), "codes": ("events", event_codes), "hourly": ("mentions", hourly_mentions),
}


def _takes_base(base: str, accepted: Mapping, kwargs: Mapping) -> bool:
    return base in accepted and base not in kwargs and not BASE_PARAMETERS.get(base, set()) & set(kwargs)


def _wanted_bases(analyses: Sequence, params: Mapping[str, dict]) -> set[str]:
    """The bases that a chosen analysis will be handed."""
    return {
        base for name, fn, _ in analyses for base in STAGED_BASES
        if _takes_base(base, inspect.signature(fn).parameters, params.get(name, {}))
    }


def _shared_bases(spark: SparkSession, inputs: Mapping[str, DataFrame | None], wanted: set[str],
                  staging: list[str], parallel: int) -> dict[str, DataFrame]:
    """Stage the wanted bases; a base that fails to build is left to each analysis."""
    jobs = {
        name: (lambda _, b=build, t=table, n=name: {"base": _stage(spark, b(inputs[t]), n, staging)})
        for name, (table, build) in STAGED_BASES.items() if inputs.get(table) is not None and name in wanted
    }
    found = run_concurrently(spark, jobs, parallel)
    return {name: o["base"] for name, o in found.items() if "base" in o}


def run_from_tables(
    spark: SparkSession,
    table_root: str,
    out_root: str,
    retain_hours: float | None = None,
    now: dt.datetime | str | None = None,
    **kwargs,
) -> list[dict]:
    """Load the feed tables under ``table_root`` (S8, optionally S7) and run everything."""
    return run_all(spark, load_inputs(spark, table_root, retain_hours, now), out_root, **kwargs)
