"""Connected components of a table of links, by contracting it round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from glyphmill.llm.plan import stored


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for links ``(a, b)``: the smallest id each id is connected with.

    In every round each id moves to the smallest id among its neighbours and itself, links
    follow, and those that become loops or copies of each other go. Only the links left enter
    the next round, so rounds get smaller fast; the smallest id of a component never moves and is
    what remains of it. The driver asks only whether any link is left.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = stored(links.where("a <> b").select(low, high).distinct(), "links")
    roots = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = stored(
            both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("to")),
            "moves",
        )
        if roots is None:
            roots = moves.withColumnRenamed("to", "root")
        else:
            further = moves.withColumnRenamed("id", "root")
            roots = stored(roots.join(further, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "roots")
        first = moves.select(F.col("id").alias("a"), F.col("to").alias("a_to"))
        second = moves.select(F.col("id").alias("b"), F.col("to").alias("b_to"))
        moved = edges.join(first, "a").join(second, "b").where("a_to <> b_to")
        edges = stored(moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return roots
