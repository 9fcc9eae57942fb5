"""Print the physical plans of the nineteen analyses over feed tables in the
layout ingest writes (typed, slot-partitioned Parquet), as Markdown.

    python -m eventlens.plans.explain > PLANS.md

A few sample rows are written to a fresh folder under the checkpoint location
so the scans are real Parquet scans (pruned ``ReadSchema``, ``PushedFilters``).
Broadcasts by estimated size are off, as such small tables would all be
broadcast; 09 is shown as the runner plans it, over written hours, also with the
hours under the broadcast threshold.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventlens import operators as ops
from eventlens.schemas import table_schema
from eventlens.session import build_session, scratch_path, write_and_read
from eventlens.sources.tables import load_table, write_slots


def sample_tables(spark: SparkSession, root: str) -> dict:
    for table in ("events", "mentions", "gkg"):
        schema = table_schema(table, with_load_columns=False)
        row = tuple(None for _ in schema.fields)
        rows = spark.createDataFrame([row], schema)
        write_slots(rows.selectExpr("*", "'20240101120000' AS ts"), root, table)
    return {t: load_table(spark, root, t) for t in ("events", "mentions", "gkg")}


def plan_text(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    # the sample folder is machine-local; show the table instead
    return re.sub(r"InMemoryFileIndex\(\d+ paths\)\[[^\]]*/(\w+)(?:-[0-9a-f]{12})?\]", r"InMemoryFileIndex[<\1 table>]", text)


def main(out=sys.stdout) -> None:
    spark = build_session(app_name="eventlens-explain")
    feeds = sample_tables(spark, scratch_path(spark, "explain"))
    hours = write_and_read(ops.escalation_hours(feeds["mentions"]), scratch_path(spark, "hours"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out.write("# Physical plans over the ingested table layout\n\n")
    out.write("Generated by `python -m eventlens.plans.explain` (Spark "
              f"{spark.version}, AQE on; plans before runtime re-optimisation; no broadcast by size).\n")

    def section(title, df):
        out.write(f"\n## {title}\n\n```\n{plan_text(df).rstrip()}\n```\n")

    for name, fn, needs in ops.ANALYSES:
        kwargs = {"hours": hours} if name == "escalation_events" else {}
        section(name, fn(*[feeds[t] for t in needs], **kwargs))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    few = ops.escalation_events(None, feeds["events"], hours=F.broadcast(hours))
    section("escalation_events, hours under the broadcast threshold", few)


if __name__ == "__main__":
    main()
