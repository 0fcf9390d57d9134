"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import stored


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes with an edge; a component's name is its least node.

    ``edges`` has columns a and b. In each round a node takes the least name among its
    neighbours, then the name its namesake has, so names travel twice as far with every
    round; each round is written to the shared folder. Rounds end when no name changes.
    """
    both = edges.select("a", "b").filter("a != b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    names = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"), "names")
    while True:
        near = (
            both.join(names, both["b"] == names["node"])
            .groupBy("a").agg(F.min("component").alias("near")).withColumnRenamed("a", "node")
        )
        hooked = names.join(near, "node").select("node", F.least("component", "near").alias("hooked"), F.col("component").alias("old"))
        jumps = names.select(F.col("node").alias("hooked"), F.col("component").alias("next"))
        new = stored(
            hooked.join(jumps, "hooked").select("node", F.least("hooked", "next").alias("component"), (F.least("hooked", "next") < F.col("old")).alias("changed")),
            "names",
        )
        if not new.filter("changed").limit(1).count():
            return names
        names = new.select("node", "component")
