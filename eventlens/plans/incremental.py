"""R2 with S4: a run that reads only the files landed since the last one.

The analyses need sums and counts that add up over landed files (``rollup``).
``update_partials`` keeps these partial aggregates per part (slot and landed
file) in one ``PartStore`` per feed: it compares the parts of a feed table with
the store's index, reads only new and replaced parts, writes their partials as
one batch and commits an index in which each part names the batch of its live
rows.  A file delivered again thus replaces its partials, a part that is gone
loses them, and a run that fails before the commit leaves the last state.

``run_incremental`` then merges the partials and runs the analyses on them.  The
merge reads all partials, which are far smaller than the 104 columns of the feeds:
the largest are one row per (event, hour) and per (event, source) of a file, and
the three columns of events that 09 and 15 look up.

``fold_partials`` joins the batches of many runs into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators import ANALYSES
from eventlens.operators import rollup
from eventlens.operators.common import hourly_mentions
from eventlens.plans.runner import run_all
from eventlens.session import remove_path, scratch_path, write_and_read
from eventlens.sources.parts import PART, PartStore, new_batch, staged_parts
from eventlens.sources.tables import load_table, table_parts

# feed -> partial -> builder over the feed's rows, kept apart by part
PARTIALS = {
    "events": {"measures": rollup.event_measures, "codes": rollup.event_codes, "keys": rollup.event_keys},
    "mentions": {"hours": rollup.mention_hours, "sources": rollup.mention_sources},
    "gkg": {"themes": rollup.theme_counts, "organizations": rollup.organization_counts},
}


def partial_store(spark: SparkSession, partial_root: str, feed: str) -> PartStore:
    return PartStore(spark, f"{partial_root.rstrip('/')}/{feed}")


def _partial_schema(spark: SparkSession, feed: str, partial: str):
    from eventlens.schemas import table_schema

    empty = spark.createDataFrame([], table_schema(feed)).withColumn("load_file", F.lit(""))
    return PARTIALS[feed][partial](empty, PART).schema


def changed_parts(spark: SparkSession, table_root: str, partial_root: str, feed: str) -> tuple[DataFrame, DataFrame] | None:
    """The parts of a feed table now, and those of them that its partials do
    not hold as they are; None when there is no table."""
    found = table_parts(spark, table_root, feed)
    if found is None:
        return None
    now = staged_parts(found)
    known = partial_store(spark, partial_root, feed).index()
    changed = now if known is None else staged_parts(now.join(known, [*PART, "signature"], "left_anti"))
    return now, changed


def update_partials(spark: SparkSession, table_root: str, partial_root: str,
                    feeds: Sequence[str] = tuple(PARTIALS)) -> dict[str, int]:
    """Bring the partials up to the feed tables; parts read per feed."""
    read = {}
    for feed in feeds:
        found = changed_parts(spark, table_root, partial_root, feed)
        if found is None:
            continue
        now, changed = found
        store = partial_store(spark, partial_root, feed)
        known = store.index()
        read[feed] = changed.count()
        if known is not None and not read[feed] and now.count() == known.count():
            continue
        batch = new_batch()
        if read[feed]:
            rows = load_table(spark, table_root, feed, parts=changed, keep_part=True)
            for name, build in PARTIALS[feed].items():
                store.write_batch(build(rows, PART), batch, name)
        index = changed.withColumn("batch", F.lit(batch))
        if known is not None:
            index = index.unionByName(now.join(known, [*PART, "signature"]).select(*PART, "signature", "batch"))
        store.commit(index)
    return read


def partial(spark: SparkSession, partial_root: str, feed: str, name: str) -> DataFrame | None:
    """The live rows of one partial, with their part; None before any update."""
    store = partial_store(spark, partial_root, feed)
    if store.index() is None:
        return None
    return store.live(_partial_schema(spark, feed, name), name)


def fold_partials(spark: SparkSession, partial_root: str, feeds: Sequence[str] = tuple(PARTIALS)) -> None:
    """Write all live partials of a feed as one batch, instead of one per run."""
    for feed in feeds:
        store = partial_store(spark, partial_root, feed)
        index = store.index()
        if index is None:
            continue
        batch = new_batch()
        for name in PARTIALS[feed]:
            live = store.live(_partial_schema(spark, feed, name), name)
            store.write_batch(live.hint("rebalance"), batch, name)
        store.commit(index.withColumn("batch", F.lit(batch)))


def run_incremental(
    spark: SparkSession, table_root: str, partial_root: str, out_root: str, analyses: Sequence = ANALYSES, **kwargs,
) -> list[dict]:
    """Update the partials, then run the analyses on them: the results of
    ``run_from_tables``, reading only what landed since the last run.  Further
    arguments as for ``run_all``."""
    feeds = [f for f in PARTIALS if f == "events" or any(f in required for _, _, required in analyses)]
    update_partials(spark, table_root, partial_root, feeds)

    live = {name: partial(spark, partial_root, feed, name) for feed in feeds for name in PARTIALS[feed]}
    staging: list[str] = []

    def staged(rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"merged-{name}")
        staging.append(path)
        return write_and_read(rows, path)

    bases = {}
    if live.get("measures") is not None:
        bases["measures"] = staged(rollup.merge_measures(live["measures"]), "measures")
        bases["codes"] = staged(rollup.merge_codes(live["codes"]), "codes")
    if live.get("hours") is not None:
        bases["hourly"] = staged(hourly_mentions(None, rollup.merge_hours(live["hours"])), "hourly")
        bases["sources"] = rollup.merge_sources(live["sources"])
    if live.get("themes") is not None:
        bases["themes"] = rollup.merge_themes(live["themes"])
        bases["organizations"] = rollup.merge_organizations(live["organizations"])
    # what an analysis still takes of a feed itself: the ids 09 and 15 look up
    tables = {"events": live.get("keys"), "mentions": live.get("hours"), "gkg": live.get("themes")}
    try:
        return run_all(spark, tables, out_root, analyses=analyses, share_bases=False, bases=bases, **kwargs)
    finally:
        for path in staging:
            remove_path(spark, path)
