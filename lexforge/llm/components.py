"""Connected components by contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, drop_table


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id in links (a, b); a component's name is its smallest id.

    In each round every id takes the first of its neighbours and itself, in an order hashed anew for the round, and then
    the label of that label. Hashing makes the labels fall by a constant factor a round whatever the ids look like, so
    chains take log steps; links still apart after the last round are an error. Links are renamed to labels; those
    inside a label go, so later rounds read only what is still apart. Every round is written to a table, so no lineage
    grows.
    """
    edges = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    for r in range(rounds + 1):
        if edges.isEmpty():
            break
        if r == rounds:
            raise RuntimeError(f"connected_components: links are left after {rounds} rounds")
        turn = lambda c: F.struct(F.xxhash64(F.lit(r), c).alias("h"), F.col(c).alias("l"))  # noqa: B023, E731
        ends = edges.select(F.col("a").alias("id"), F.col("b").alias("m")).union(edges.select("b", "a"))
        hooks = ends.groupBy("id").agg(F.min(turn("m")).alias("m")).select("id", F.least(turn("id"), "m")["l"].alias("l"))
        on = hooks.select(F.col("id").alias("l"), F.col("l").alias("ll"))
        step = cut(hooks.join(on, "l").select("id", F.col("ll").alias("l")))
        left, right = (step.select(F.col("id").alias(c), F.col("l").alias(f"l{c}")) for c in "ab")
        apart = edges.join(left, "a").join(right, "b").where("la <> lb")
        apart = cut(apart.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
        if labels is None:
            labels = step
        else:
            via = step.select(F.col("id").alias("l"), F.col("l").alias("ll"))
            new = cut(labels.join(via, "l", "left").select("id", F.coalesce("ll", "l").alias("l")))
            drop_table(labels)
            drop_table(step)
            labels = new
        drop_table(edges)
        edges = apart
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    names = labels.groupBy("l").agg(F.min("id").alias("component"))
    out = cut(labels.join(names, "l").select("id", "component"))
    drop_table(labels)
    return out
