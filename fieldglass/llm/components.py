"""Connected components of a graph given as a table of edges, by contraction.

In a round every vertex with a smaller neighbour hooks to its smallest one; hooks are followed to their ends by doubling, and the
edges between the ends form the next, smaller graph. A hub costs nothing extra: minima are combined before the shuffle,
and the joins have one row per vertex on one side, so a skewed side can be split. Every step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize


def _followed(hooks: DataFrame) -> DataFrame:
    """``(vertex, root)`` with each hook chain replaced by its end."""
    while True:
        up = hooks.select(F.col("vertex").alias("middle"), F.col("root").alias("end"))
        longer = hooks.join(up, hooks["root"] == up["middle"], "left")
        longer = materialize(longer.select("vertex", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "hooks")
        if longer.where("moved").isEmpty():
            return longer.drop("moved")
        hooks = longer.drop("moved")


def _relabelled(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """``column`` replaced by its root where it has one."""
    to = hooks.select(F.col("vertex").alias("_v"), F.col("root").alias("_r"))
    others = [F.col(c) for c in df.columns if c != column]
    return df.join(to, F.col(column) == F.col("_v"), "left").select(F.coalesce("_r", column).alias(column), *others)


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, root)`` for every vertex of an edge that is not the smallest of its component; ``root`` is the smallest.

    ``edges`` has two LONG columns ``a`` and ``b``; loops, repeated edges and either direction are fine, nulls are no edges.
    """
    live = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    labels = None
    while not live.isEmpty():
        hooks = _followed(live.groupBy(F.col("b").alias("vertex")).agg(F.min("a").alias("root")))
        labels = hooks if labels is None else materialize(_relabelled(labels, "root", hooks).select("vertex", "root").unionByName(hooks), "labels")
        moved = _relabelled(_relabelled(live, "a", hooks).select("a", "b"), "b", hooks)
        live = materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    return labels if labels is not None else live.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
