"""Connected components of an edge table by alternating large-star and small-star steps, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from closebook.llm.common import measured

MOST_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for every id in the edges; the component is its least id.

    Rounds end when a step changes nothing; their number grows with the logarithm of the longest chain. Every
    round's edges are written to the shared folder, so that lost executors repeat one round at most.
    """
    return _settled(*_pairs(edges, a, b))


def merged(comps: DataFrame | None, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The components of all edges so far, given those (``comps``) of the earlier ones: only what edges join anew moves."""
    if comps is None:
        return measured(components(edges, a, b), "components")[0]
    place = lambda end: comps.select(F.col("id").alias(end), F.col("component").alias(f"{end}_component"))
    ends = edges.select(a, b).join(place(a), a, "left").join(place(b), b, "left")
    pairs, seen = _pairs(ends.select(F.coalesce(f"{a}_component", a).alias("a"), F.coalesce(f"{b}_component", b).alias("b")), "a", "b")
    if not seen["n"]:
        return comps
    moved = measured(_settled(pairs, seen), "moved")[0]
    now = moved.select(F.col("id").alias("component"), F.col("component").alias("now"))
    old = comps.join(now, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
    new = moved.join(comps.select("id"), "id", "left_anti").select("id", "component")
    return measured(old.unionAll(new), "components")[0]


def _stored(pairs: DataFrame) -> tuple[DataFrame, dict]:
    return measured(pairs, "edges", n=F.count("*"), mark=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))


def _pairs(edges: DataFrame, a: str, b: str) -> tuple[DataFrame, dict]:
    """The distinct edges, from the greater to the lesser end, and their number and mark."""
    both = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u != v")
    return _stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _settled(pairs: DataFrame, state: dict) -> DataFrame:
    """``id, component`` of the ids in stored edges."""
    for _ in range(MOST_ROUNDS if state["n"] else 0):
        # Large star: every neighbour above joins the least of a node's neighbourhood.
        ways = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # Small star: a node and its lesser neighbours join the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        before = state
        pairs, state = _stored(small)
        if state == before:
            break
    else:
        if state["n"]:
            raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return pairs.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
