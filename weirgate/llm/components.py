"""Connected components by alternating stars: each round is two joins, and no component meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import stage


def _to_least(edges: DataFrame, upwards: bool) -> DataFrame:
    """Tie the larger (upwards) or smaller neighbours of each node to the least of its neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if upwards else both.where("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    ties = near.where("b > a") if upwards else near
    out = ties.join(least, "a").select(F.col("b").alias("x"), "m")
    if not upwards:
        out = out.union(least.select(F.col("a").alias("x"), "m"))
    return out.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``links`` (a, b) become (id, component): the least id that each linked id reaches.

    The links shrink to one edge from every id to the least of its component; each round is written to the
    shared folder. Repeated links, both directions and loops are allowed; null ends link nothing.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = links.where("a is not null and b is not null and a <> b").select(a.alias("a"), b.alias("b")).distinct()
    edges = stage(edges, "edges")
    before = None
    for _ in range(most_rounds):
        total = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if total == before or not total[0]:
            break
        before = total
        edges = stage(_to_least(_to_least(edges, True), False), "edges")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
