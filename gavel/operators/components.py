"""Connected components of an edge table, by alternating star contraction.

Each round joins neighbours to the least id they know (large star), then hands the least id on among smaller
neighbours (small star); the number of edges never grows, ids only fall, and a chain of n vertices needs about log n rounds. Every
round is written to the shared checkpoint folder, so lineage stays short and lost executors cost one round. Nothing but
one change counter a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component): every vertex of the edges with the least id of its component. Loops and repeated edges are fine."""
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u <> v").distinct()
    e = cut(e)
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours of u to its least
        large = both.filter("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = cut(e)
        now = e.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.lit(0)).alias("h")).first()
        if last == (now["n"], now["h"]):
            break
        last = (now["n"], now["h"])
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
