"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import stored


def connected_components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Label every node of ``links`` (a long, b long) with the smallest node it can reach.

    Returns (node, component), one row per node that has a link; self links,
    repeated links and null ends are ignored, and no links give no rows.

    Each round hooks every node to its smallest neighbour, follows those
    pointers to their ends, and contracts the graph to them, so the number of
    nodes at least halves per component in practice and a round reads only
    what the last one left.  Each round's tables are written to the shared
    folder.  Nothing is collected but one flag per round.
    """
    both = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stored(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")))
        parent = _follow(parent)
        new = (
            edges.join(parent.select("a", F.col("p").alias("pa")), "a")
            .join(parent.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b")
            .filter("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        edges = stored(new)
        if labels is None:
            labels = parent.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            step = parent.select(F.col("a").alias("component"), "p")
            labels = stored(labels.join(step, "component", "left").select("node", F.coalesce("p", "component").alias("component")))
    else:
        raise RuntimeError("components did not settle")
    if labels is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return labels


def _follow(parent: DataFrame) -> DataFrame:
    """Replace each pointer by the end of its chain, doubling the reach each time."""
    while True:
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
        jumped = stored(parent.join(up, "p").select("a", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")))
        parent = jumped.select("a", "p")
        if jumped.filter("moved").isEmpty():
            return parent
