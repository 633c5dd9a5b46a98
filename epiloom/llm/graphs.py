"""Connected components of an edge table, by contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.session import materialize

JOINS_A_PLAN = 6  # of the rounds' parents, before the result is written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of an edge; a component is named by one of its nodes.

    Node numbers are 64-bit. In each round every node merges into the neighbour (or itself) with the
    smallest hash of that round, so a long chain shrinks by a constant factor as a star does; only
    minima travel, so a hub's edges combine before the shuffle. Each round starts from written tables.
    The rounds' parents are followed at the end, from the last and smallest table to the first.
    """
    rest = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    rest = materialize(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    parents: list[DataFrame] = []
    for turn in range(max_rounds):
        if not rest.take(1):
            break
        both = rest.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), "b")).alias("near"))
        parent = materialize(
            near.select("node", F.when(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("b")) < F.col("near"), F.col("node")).otherwise(F.col("near.b")).alias("parent")),
            "parents",
        )
        parents.append(parent)
        moved = (
            rest.join(parent.select(F.col("node").alias("a"), F.col("parent").alias("x")), "a")
            .join(parent.select(F.col("node").alias("b"), F.col("parent").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        rest = materialize(moved.distinct(), "edges")
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    if not parents:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = parents.pop().withColumnRenamed("parent", "component")
    while parents:
        # a parent without edges left is no node of the next round: it names its component
        above = labels.withColumnRenamed("node", "parent")
        labels = parents.pop().join(above, "parent", "left").select("node", F.coalesce("component", "parent").alias("component"))
        if len(parents) % JOINS_A_PLAN == 0:
            labels = materialize(labels, "labels")
    return labels
