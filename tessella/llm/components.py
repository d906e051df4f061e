"""Connected components over an edge table, without collecting edges or labels anywhere.

Each round hooks trees onto the smallest grandparent label seen across an edge and halves the
height of every tree (pointer jumping). All steps are equi-joins and ``min`` aggregates, so a hub
with a third of all edges is combined on the map side; joins on a hub's label have one row on the
other side and are split by adaptive execution. Rounds grow with the logarithm of the diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import shared_dir


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)``: root is the smallest node of the component.

    Nodes without an edge are absent. Self-links and repeated edges are allowed; null ends are
    ignored. An empty table gives an empty table.
    """
    shared_dir(edges.sparkSession)
    both = (
        edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("w"))
        .filter("u is not null and w is not null and u != w")
    )
    both = both.union(both.select(F.col("w").alias("u"), F.col("u").alias("w"))).distinct().checkpoint()
    state = both.groupBy("u").agg(F.min("w").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("f")).checkpoint()
    before = None
    for _ in range(max_rounds):
        total = state.agg(F.sum(F.col("f").cast("decimal(38,0)")).alias("s")).first()["s"]
        if total == before:
            break
        before = total
        parent = state.select(F.col("v").alias("pv"), F.col("f").alias("gf"))
        jumped = state.join(parent, F.col("f") == F.col("pv")).select("v", "f", "gf")
        seen = (
            both.join(jumped.select(F.col("v").alias("w"), "gf"), "w")
            .groupBy("u").agg(F.min("gf").alias("m"))
        )
        hooked = jumped.join(seen.withColumnRenamed("u", "v"), "v", "left")
        moves = hooked.select(F.explode(F.array(
            F.struct(F.col("v").alias("v"), F.least("gf", "m").alias("f")),
            F.struct(F.col("f").alias("v"), F.least("gf", "m").alias("f")),
        )).alias("x")).select("x.*")
        state = moves.groupBy("v").agg(F.min("f").alias("f")).checkpoint()
    else:
        raise RuntimeError("components did not settle")
    return state.select(F.col("v").alias("node"), F.col("f").alias("root"))
