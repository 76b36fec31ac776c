"""Connected components by alternating large-star and small-star edge rewrites."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_split
from ..sources.scratch import materialize, shared_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node u links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = join_split(both, least, "u", unique=True).where("v > u")
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node u links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    out = join_split(down, least, "u", unique=True).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    """Number of edges and two sums of their hashes: equal for equal edge sets."""
    h = F.xxhash64("u", "v")
    r = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftrightunsigned(h, 20).cast("decimal(38,0)")).alias("a"),
        F.sum(F.pmod(h, F.lit(1_000_003)).cast("long")).alias("b"),
    ).head()
    return r["n"], r["a"], r["b"]


def connected_components(pairs: DataFrame, a: str, b: str, nodes: DataFrame | None = None, rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node, in the order of the column's type, linked with it directly or indirectly.

    pairs: links in any direction, repeated or not; a null end makes no link, the other end still is a node. A link of a node with itself
    makes a node. nodes: one column of further nodes; a node without links is its own component. Empty input: no rows.

    Large-star and small-star joins alternate until a round changes no edge, O(log^2 n) rounds. Minima combine map-side; the join back to
    a node with many edges goes by `join_split`, so no task holds a hub's neighbourhood. Each round ends in checkpoint(), in the
    shared folder. Raises if `rounds` are not enough."""
    spark = pairs.sparkSession
    shared_dir(spark)
    p = materialize(pairs.select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), "links")
    every = p.select(F.col("u").alias("node")).union(p.select(F.col("v").alias("node")))
    if nodes is not None:
        every = every.union(nodes.select(F.col(nodes.columns[0]).alias("node")))
    every = every.where(F.col("node").isNotNull()).distinct()
    edges = p.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = edges.distinct().checkpoint()
    before = _print(edges)
    for _ in range(rounds):
        edges = _small_star(_large_star(edges)).checkpoint()
        now = _print(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # now every edge leads from a node to its component's smallest node, once
    return every.join(edges.select(F.col("u").alias("node"), F.col("v").alias("_c")), "node", "left").select(
        "node", F.coalesce("_c", "node").alias("component")
    )
