"""Connected components of a graph by large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common as C


def _star(links: DataFrame, large: bool, many: bool) -> DataFrame:
    """One round: the neighbours of each node that are larger (or, in a small star, no larger) move to its least neighbour.

    many: whether the links are too many for one task, so that those of a hot node have to be spread.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    # the least neighbour comes from an aggregate with partial minima, so a node with very many neighbours costs no large window
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = C.lookup(both, least, "u", C.hot_keys(both, "u")) if many else both.join(least, "u")
    if large:
        return met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    moved = met.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(met.select(F.col("u").alias("a"), F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes with a link to another node; root is the least node of the component.

    links: any number of rows; nulls and links of a node to itself are left out. Rounds are of the order of the logarithm of the
    longest path; each is checkpointed reliably. The result is checked to have converged.
    """
    now = cut_lineage(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sign = None
    for _ in range(rounds):
        many = (sign or (now.count(),))[0] > C.HOT_MOST
        now = cut_lineage(_star(_star(now, True, many), False, many))
        # a star forest: the links don't change any more
        then, sign = sign, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if sign == then:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"no convergence in {rounds} rounds")
