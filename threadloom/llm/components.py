"""Connected components by minimum labels, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written


def components(edges: DataFrame) -> DataFrame:
    """``edges``: (_x, _y). A row (_node, _comp) for each node, ``_comp`` its component's least node.

    Every round takes the least label among neighbours and then that label's own, so the number of rounds grows as the
    logarithm of a component's diameter or about so. Each round is written, labels and edges stay on the executors, and
    a node with many neighbours is aggregated on the map side.
    """
    both = written(edges.select("_x", "_y").union(edges.select("_y", "_x")).toDF("_node", "_other").where("_node <> _other").distinct(), "edges")
    label = written(both.groupBy("_node").agg(F.min("_other").alias("_m")).select("_node", F.least("_node", "_m").alias("_comp")), "labels")
    while True:
        near = both.join(label.select(F.col("_node").alias("_other"), "_comp"), "_other").groupBy("_node").agg(F.min("_comp").alias("_m"))
        low = label.join(near, "_node").select("_node", F.col("_comp").alias("_old"), F.least("_comp", "_m").alias("_low"))
        jump = label.select(F.col("_node").alias("_low"), F.col("_comp").alias("_far"))
        new = written(low.join(jump, "_low", "left").select("_node", "_old", F.least("_low", F.coalesce("_far", "_low")).alias("_comp")), "labels")
        label = new.select("_node", "_comp")
        if new.where("_old <> _comp").isEmpty():
            return label
