"""Read-out: the views over the result tables the runner wrote.

This is the read side of the batch (what a dashboard would fetch): each view
reads whole result tables and returns a small, bounded DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlens.plans.view_queries import VIEWS
from eventlens.plans.views import result_summary
from eventlens.sources.sinks import RUN_RECORD, read_result


def result_views(spark: SparkSession, out_root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """``view name -> DataFrame`` over the written results under ``out_root``."""
    cache: dict[str, DataFrame] = {}

    def result(name: str) -> DataFrame:
        if name not in cache:
            cache[name] = read_result(spark, out_root, name, fmt)
        return cache[name]

    views = {}
    for view, (needs, shape) in VIEWS.items():
        if view == "view_result_summary":
            views[view] = result_summary({n: result(n) for n in needs}, run_record=result(RUN_RECORD))
        else:
            views[view] = shape({n: result(n) for n in needs})
    return views
