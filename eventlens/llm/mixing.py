"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree of columns (domain, language, source).  Each
node divides its budget among its children by weight; a child cannot take more
than its subtree's capacity (its tokens times ``max_epochs``), and what it
cannot take goes to its siblings by weight.  Only what all siblings together
cannot take is missing from the parent's capacity and so goes to the parent's
siblings.  The level at which children stop growing is closed form: over the
children by capacity per weight, the largest (budget - capacity before) /
(weight from here on).

A leaf with budget b and n tokens yields b div n whole epochs of its documents
and, in the seeded order of the following epoch, the shortest prefix that
reaches the remaining b mod n tokens.  The order is by md5 of seed, epoch and
id.  The prefix is found from token sums of 65,536 ranges of that order; only
the range in which it ends is ordered row by row, so no leaf is sorted whole.

Tokens are white-space-separated words.  Nulls: null tree columns count as
``''``, a null text has no tokens, a null id orders as ``'null'``.  Repeated
rows are selected one by one.  A leaf without tokens, or of weight 0, yields
nothing; an empty table an empty result.  Further columns may bear any name;
those named like the three that are added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.shared import staged

MAX_EPOCHS = 4
SEED = 17
RANGE_DIGITS = 4
MIX_COLUMNS = ("mix_epoch", "mix_tokens", "mix_budget")


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def weight_of(column: Column, weights: dict[str, float] | None) -> Column:
    """The weight of a child: the listed one, 1 for any other value."""
    out = F.lit(1.0)
    for value, weight in (weights or {}).items():
        out = F.when(column == value, F.lit(float(weight))).otherwise(out)
    return out


def _divide(nodes: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """Add ``given``: each child's part of its parent's ``budget``."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = by.orderBy(F.col("cap") / F.col("w"), *nodes.columns[: len(parent) + 1])
    level = (budget - F.coalesce(F.sum("cap").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
             ) / F.sum("w").over(before.rowsBetween(0, Window.unboundedFollowing))
    return (
        nodes.withColumn("level", level)
        .withColumn("given", F.least(F.col("cap"), F.col("w") * F.max("level").over(by)))
        .drop("level")
    )


def leaf_budgets(leaves: DataFrame, tree: list[str], total: float | Column,
                 weights: dict[str, dict[str, float]] | None = None,
                 max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``tree`` columns, ``tokens`` and ``budget`` of every leaf.

    ``leaves``: ``tree`` columns and ``tokens``.  ``total`` is the root's
    budget.  The tables here hold one row per tree node, never rows of data.
    """
    weights = weights or {}
    given = None
    for depth in range(1, len(tree) + 1):
        path, parent = tree[:depth], tree[: depth - 1]
        nodes = (
            leaves.where("tokens > 0").groupBy(*path)
            .agg(F.sum(F.col("tokens") * float(max_epochs)).alias("cap"))
            .withColumn("w", weight_of(F.col(path[-1]), weights.get(path[-1])))
            .where("w > 0")
        )
        if given is None:
            budget = total if isinstance(total, Column) else F.lit(float(total))
            given = _divide(nodes, parent, budget)
        else:
            up = given.select(*parent, F.col("given").alias("__up"))
            given = _divide(nodes.join(up, parent), parent, F.col("__up")).drop("__up")
    return leaves.join(given.select(*tree, "given"), tree).select(
        *tree, "tokens", F.floor(F.col("given") + F.lit(1e-6)).cast("long").alias("budget"))


def mix(docs: DataFrame, tree: dict[str, Column], total_share: float = 1.0,
        weights: dict[str, dict[str, float]] | None = None, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The selected rows: all columns of ``docs``, and ``mix_epoch``,
    ``mix_tokens`` and ``mix_budget`` (the leaf's).

    ``tree``: name and expression of each level, from the root down.
    ``total_share``: the budget as a multiple of all tokens of ``docs``.
    """
    # the whole row as one value, so no column of docs can clash with ours
    levels = [f"level_{i}" for i in range(len(tree))]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        *(F.coalesce(v.cast("string"), F.lit("")).alias(k) for k, v in zip(levels, tree.values(), strict=True)),
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
        words_in(F.col(f"`{text_col}`")).alias("tokens"),
    )
    leaves = staged(rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    named = {k: (weights or {}).get(name) for k, name in zip(levels, tree, strict=True)}
    plan = leaf_budgets(leaves, levels, total * total_share, named, max_epochs)
    plan = staged(plan.select(
        *levels, "budget", F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")), "plan")

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"),
                              F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    part = F.substring("order", 1, RANGE_DIGITS)
    keyed = rows.join(plan, levels).withColumn("order", order).withColumn("part", part)
    sums = keyed.groupBy(*levels, "part", "rest").agg(F.sum("tokens").alias("t"))
    running = Window.partitionBy(*levels).orderBy("part")
    ends = (
        sums.withColumn("before", F.sum("t").over(running) - F.col("t"))
        .where("before < rest").groupBy(*levels)
        .agg(F.max("part").alias("last"), F.max_by("before", "part").alias("before"))
    )
    ends = staged(ends, "prefixes")
    keyed = keyed.join(ends, levels, "left")
    sure = F.col("whole") + F.when(F.col("part") < F.col("last"), 1).otherwise(0)
    whole = keyed.where(sure > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), (sure - 1).cast("int"))))
    ordered = Window.partitionBy(*levels).orderBy("order", "id", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edge = (
        keyed.where(F.col("part") == F.col("last"))
        .withColumn("reached", F.col("before") + F.sum("tokens").over(ordered) - F.col("tokens"))
        .where("reached < rest").withColumn("epoch", F.col("whole").cast("int"))
    )
    out = [*(F.col("row")[c].alias(c) for c in docs.columns if c not in MIX_COLUMNS),
           *(F.col(c).alias(n) for c, n in zip(("epoch", "tokens", "budget"), MIX_COLUMNS, strict=True))]
    return whole.select(*out).unionByName(edge.select(*out))
