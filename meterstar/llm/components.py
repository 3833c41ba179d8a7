"""Connected components of an edge table, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.scratch import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the same within a component,
    and only there.

    Each round lets every node follow its smallest neighbour (or itself), shortens the
    chains that gives, and contracts the graph to the ends of the chains; the edges that are
    left join different ends. Every round is a few joins of key columns: the neighbours of a
    node are summed up to their minimum, never gathered.
    """
    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = staged(
            both.groupBy("a").agg(F.min("b").alias("b"))
            .select(F.col("a").alias("node"), F.least("a", "b").alias("root")),
            "parents",
        )
        # A parent is smaller than its child, so chains end; follow them to their ends.
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            joined = staged(
                parent.join(up, "root").select("node", "root", "next"), "chains"
            )
            parent = joined.select("node", F.col("next").alias("root"))
            if joined.filter("root <> next").isEmpty():
                break
        levels.append(parent)
        ends = [parent.select(F.col("node").alias(c), F.col("root").alias(f"{c}_end")) for c in "ab"]
        edges = staged(
            edges.join(ends[0], "a").join(ends[1], "b")
            .select(F.col("a_end").alias("a"), F.col("b_end").alias("b"))
            .filter("a <> b").distinct(),
            "edges",
        )
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # The ends of one level are the nodes of the next; those missing there are finished.
    result = levels[0]
    for level in levels[1:]:
        up = level.select(F.col("node").alias("root"), F.col("root").alias("next"))
        result = result.join(up, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root")
        )
    return result


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes, the smallest node reachable by the edges; of few edges, in one task."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new
