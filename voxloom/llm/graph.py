"""Connected components by alternating large-star and small-star steps, as DataFrame joins.

Each step sends a node's neighbours to their least neighbour. Nothing is collected but two numbers
a round that tell whether the edges still change, and no node's neighbours are ever gathered in a
list: the least one is a pre-aggregated minimum. Each step's edges are a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, stage


def _state(edges: DataFrame) -> tuple:
    # a decimal sum: adding 64-bit hashes must not overflow in ANSI mode
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _to_least(edges: DataFrame, least: DataFrame, keep: str) -> DataFrame:
    """Edges from each kept neighbour of a node to the node's least one."""
    return edges.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _round(e: DataFrame) -> DataFrame:
    """A large-star and a small-star step, as a new table.

    The least neighbours are tables too, so that the join with the edges of a node that very many
    others hang on is broadcast where they are few, and split where they are many.
    """
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    large = stage(_to_least(both, least, "v > u").distinct(), "edges")
    lower = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
    small = stage(_to_least(large, lower, "v <> m").unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
    for t in (least, large, lower):
        discard(t)
    return small


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows ``(id, component)`` for every node with an edge; the component is its least node.

    Edges with a null end and loops are ignored; repeated edges and either direction are fine.
    Without edges the result is empty.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    e = stage(e.where("_a is not null and _b is not null and u <> v").select("u", "v").distinct(), "edges")
    state = _state(e)
    while state[0]:
        new = _round(e)
        discard(e)
        e, old = new, state
        state = _state(e)
        if state == old:
            break
    root = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(root)
