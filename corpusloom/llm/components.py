"""Connected components by alternating large-star and small-star rounds.

Each round only takes minima per node and joins them back, so a hub's neighbours are never gathered into one array;
the edges of each round are written to the shared folder, which ends their lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._common import cut, discard


#: Edges of a node that one task may hold; a node of more is a hub.
HUB = 100_000


def _to_minimum(edges: DataFrame, hub: int) -> DataFrame:
    """(u, v) -> (u, v, m): the least neighbour of u, or u itself.

    The edges of hubs stay where they are: the hubs' minima, at most one for each hub edges, are broadcast to them.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k"))
    hubs = F.broadcast(least.where(F.col("k") > hub).select(F.col("u").alias("hub"), F.col("m").alias("hub_m")))
    marked = edges.join(hubs, F.col("u") == F.col("hub"), "left")
    far = marked.where("hub is not null").select("u", "v", F.col("hub_m").alias("m"))
    near = marked.where("hub is null").select("u", "v").join(least.where(F.col("k") <= hub).select("u", "m"), "u")
    return near.unionByName(far).withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame, hub: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_minimum(both, hub).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, hub: int) -> DataFrame:
    down = _to_minimum(edges, hub)
    moved = down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(down.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v", hub: int = HUB) -> DataFrame:
    """node, root: the least node reachable, for each node that has an edge to another.

    Self loops and nulls are ignored; no edges give no rows. A node of over hub edges, or of a millionth of all edges if
    that is more, is a hub.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct()
    now, path = cut(now, "edges")
    state, hub = None, max(hub, now.count() // 1_000_000)
    while True:
        after, new = cut(_small_star(_large_star(now, hub), hub), "edges")
        discard(spark, path)
        now, path = after, new
        row = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if (row[0], row[1]) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = (row[0], row[1])
