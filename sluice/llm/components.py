"""Connected components of an edge table by alternating star contraction.

Each round is two group-and-join steps, so no neighbour list is ever gathered; a hub's edges are
pre-aggregated by the partial minimum and, in the joins, split by Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``edges`` (two id columns) to (node, component): the smallest id reachable from each node
    that has an edge to another node. Repeated edges, loops and either order are fine; edges with
    a null end are left out; no edges give no rows."""
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .where("u <> v")
        .distinct(),
        "edges",
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
