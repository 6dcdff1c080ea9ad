"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.session import stage, stages_dropped


def components(edges: DataFrame) -> DataFrame:
    """`node, component` for the nodes of `edges` (columns `a`, `b`); a component is its least node.

    Each round hooks every component to its least neighbour and shortens the chains that arise until
    each points at its root, then contracts the edges. Chains shorten by doubling, so long ones cost few
    rounds, and only components that still have edges are touched again. Tables between rounds are written to the shared folder; nothing is collected but counts.
    """
    spark = edges.sparkSession
    with stages_dropped(spark) as keep:
        edges = stage(
            edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        labels = None
        while not edges.isEmpty():
            both = edges.union(edges.select("b", "a"))
            # The least neighbour, where it is less than the node itself; such hooks cannot form cycles.
            hooks = both.groupBy("a").agg(F.min("b").alias("up"))
            hooks = hooks.select(F.col("a").alias("node"), F.least("a", "up").alias("root"))
            hooks = stage(hooks, "hooks")
            moved = 1
            while moved:
                up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
                jumped = hooks.join(up, "root").select(
                    "node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")
                )
                jumped = stage(jumped, "hooks")
                moved = jumped.where("moved").limit(1).count()
                hooks = jumped.drop("moved")
            if labels is None:
                labels = hooks.withColumnRenamed("root", "component")
            else:
                labels = stage(
                    labels.join(hooks.withColumnRenamed("node", "component"), "component", "left")
                    .select("node", F.coalesce("root", "component").alias("component")),
                    "labels",
                )
            # Edges between the roots of their ends.
            a = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
            b = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
            edges = stage(
                edges.join(a, "a").join(b, "b").where("ra <> rb")
                .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                .distinct(),
                "edges",
            )
        if labels is None:
            labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        return keep(stage(labels, "components"))
