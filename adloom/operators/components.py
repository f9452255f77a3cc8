"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.session import cut, free


def _nearest(edges: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours. Aggregated before the shuffle, so hubs cost one row a task."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """(node, component) for every node of an edge list; component is the least node id.

    Each round is two aggregations and two joins on the edges that are left; no
    node's neighbourhood is ever gathered in one place. Loops and repeated
    edges are allowed, rows with a NULL end are dropped, and an empty edge list gives an
    empty result. Raises if it hasn't converged after max_rounds (rounds grow
    with the logarithm of the longest chain).
    """
    e = edges.select(F.least(a, b).cast("long").alias("p"), F.greatest(a, b).cast("long").alias("q"))
    e = cut(e.where("p < q").distinct())
    last = None
    for _ in range(max_rounds):
        both = e.select(F.col("p").alias("u"), F.col("q").alias("v")).unionAll(e.select(F.col("q").alias("u"), F.col("p").alias("v")))
        large = both.join(_nearest(both), "u").where("v > u and v <> m").select(F.col("m").alias("p"), F.col("v").alias("q")).distinct()
        up = large.select(F.col("q").alias("u"), F.col("p").alias("v"))
        near = _nearest(up)
        small = (
            up.join(near, "u")
            .select(F.explode(F.array(F.struct(F.col("m").alias("p"), F.col("v").alias("q")), F.struct(F.col("m").alias("p"), F.col("u").alias("q")))).alias("x"))
            .select("x.p", "x.q")
            .where("p <> q")
            .distinct()
        )
        done, e = e, cut(small)
        free(done)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("p", "q").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components: not converged after {max_rounds} rounds")
    members = e.select(F.col("q").alias("node"), F.col("p").alias("component"))
    return members.unionAll(e.select(F.col("p").alias("node"), F.col("p").alias("component")).distinct())
