"""Connected components and lookups over tables that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.sources.stage import Stage

# A key is hot from this share of all rows on; so at most 1 / HOT_SHARE keys are, which may be broadcast.
HOT_SHARE = 0.005


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with a table that has each ``key`` once and counts its rows in ``weight``.

    Rows of hot keys meet a broadcast of these few keys; all others are shuffled.
    """
    least = max(1000, int(total * HOT_SHARE))
    hot = table.filter(F.col(weight) >= least)
    if not hot.limit(1).count():
        return rows.join(table, key)
    rest = table.filter(F.col(weight) < least)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(cold.join(rest, key))


def components(edges: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(node, component) of every node of the undirected stored ``edges`` (a, b): the least node reachable.

    Every round, a node takes the least label of its neighbours and then the label of that label, so paths
    shrink geometrically. Each round's labels are a stored table; only a count of changes is sent to the
    driver.
    """
    directed = 2 * edges.count()
    both = stage.save(f"{name}-edges", edges.select("a", "b").union(edges.select("b", "a")).distinct(), directed)
    labels = stage.save(
        f"{name}-0",
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")),
        directed,
    )
    turn = 0
    while True:
        turn += 1
        seen = labels.select(F.col("node").alias("b"), F.col("component").alias("m"))
        nearest = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("m").alias("m"))
        taken = labels.join(nearest, "node").select("node", "component", F.least("component", "m").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = stage.save(
            f"{name}-{turn}",
            taken.join(jump, "next").select("node", F.least("next", "far").alias("component"), (F.col("component") != F.least("next", "far")).alias("moved")),
            directed,
        )
        labels = moved.select("node", "component")
        if not moved.filter("moved").limit(1).count():
            return labels
