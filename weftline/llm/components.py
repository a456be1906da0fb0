"""Connected components of a link table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import Scratch, materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of ``links``; ``root`` is the smallest node reachable.

    Every round gives each node the smallest label among its neighbours' and then the label
    of its label, so labels travel twice as far each time; a round's labels are written to the
    shared folder, and rounds end when no label changes.  Nothing is collected.  The tables go
    with ``scratch`` if there is one.
    """
    materialized = scratch.write if scratch else materialize
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x <> y")
    both = materialized(both.distinct(), "links")
    label = materialized(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("l")), "labels")
    while True:
        near = both.join(label.select(F.col("x").alias("y"), F.col("l").alias("near")), "y")
        near = near.groupBy("x").agg(F.min("near").alias("near"))
        step = label.join(near, "x").select("x", "l", F.least("l", "near").alias("m"))
        jump = label.select(F.col("x").alias("m"), F.col("l").alias("ml"))
        step = step.join(jump, "m").select("x", "l", F.least("m", "ml").alias("m"))
        step = materialized(step, "labels")
        label = step.select("x", F.col("m").alias("l"))
        if step.where("l <> m").isEmpty():
            return label.select(F.col("x").alias("node"), F.col("l").alias("root"))
