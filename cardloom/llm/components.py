"""Connected components of a table of links, by contraction.

Each round every node takes the smallest of itself and its neighbours as its
parent, parents are followed one step further, and links are drawn anew between
parents.  The links left shrink quickly, hubs included, because the smallest
neighbour is a partial aggregate.

Defined results: a link in both directions, twice or from a node to itself changes
nothing, and neither do nulls; no links give no nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for each node of ``links`` (columns a, b): the least node it reaches."""
    ordered = lambda x: x.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    left = written(ordered(links), f"{name}-links")
    labels = left.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    first = True
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        # written, as a join can split a hot parent only if both sides come from a table or a shuffle
        parent = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent")), f"{name}-parent")
        above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("label"))
        step = written(parent.join(above, "parent").select("node", "label"), f"{name}-step")
        if first:
            labels = step
        else:
            further = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = written(labels.join(further, "label", "left").select("node", F.coalesce("next", "label").alias("label")), f"{name}-labels")
        for end in ("a", "b"):
            left = left.join(step.select(F.col("node").alias(end), F.col("label").alias(f"to_{end}")), end)
        left = written(ordered(left.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), f"{name}-links")
        first = False
    return labels
