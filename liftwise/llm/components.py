"""Connected components of a link table, in Spark only (nothing of it reaches the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from liftwise.llm.common import hold


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(node, root): each linked node and the smallest node of its component, roots included.

    Edges point from the larger to the smaller node. A round links all smaller neighbours of
    a node to the smallest one, then replaces every target by its own smallest neighbour. It
    ends when every node has one target and no target has one itself. The window runs over a
    node's smaller neighbours; a root with many nodes is only ever a join's target, where
    adaptive skew handling splits it. Every round is written, so lineage stays short.
    """
    pairs = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo")
    e = hold(pairs.groupBy("hi", "lo").agg(F.lit(1).alias("one")).select("hi", "lo"), name)
    w = Window.partitionBy("hi")
    while True:
        near = e.withColumn("least", F.min("lo").over(w))
        both = F.array(F.struct(F.col("hi"), F.col("least").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")))
        linked = near.select(F.explode(both).alias("x")).select("x.hi", "x.lo").where("hi <> lo")
        linked = hold(linked.groupBy("hi").agg(F.min("lo").alias("lo"), F.collect_set("lo").alias("all")), name)
        step = linked.select("hi", F.explode("all").alias("lo"))
        parent = linked.select(F.col("hi").alias("mid"), F.col("lo").alias("up"))
        jumped = step.join(parent, step.lo == parent.mid, "left").select("hi", F.coalesce("up", "lo").alias("to"), F.col("up").isNotNull().cast("int").alias("moved"))
        nxt = hold(jumped.groupBy("hi", "to").agg(F.max("moved").alias("moved")), name)
        left = nxt.agg(F.count("*").alias("n"), F.sum("moved").alias("moved"), F.countDistinct("hi").alias("nodes")).first()
        e = nxt.select("hi", F.col("to").alias("lo"))
        if not left.moved and left.n == left.nodes:
            break
    roots = e.groupBy("lo").agg(F.lit(1).alias("one")).select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots)
