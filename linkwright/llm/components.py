"""Distributed connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Work

#: Edges of one written file.
ROWS = 200_000


def connected(work: Work, edges: DataFrame, name: str) -> DataFrame:
    """edges: a, b (long). Returns (id, comp) for every node of an edge; comp is the smallest id reachable.

    Each round links the larger neighbours of every node to its smallest one (large star), then the
    smaller ones (small star); the rounds grow with the logarithm of the graph's size. Both sides of
    the hub join are written tables, so a node with very many edges is split by the skew join; the
    small stars start from few edges a node. No edge or label reaches the driver, only a row count
    and a checksum, observed as the edges are written. Self loops and repeated edges are ignored; no edges give an empty table.
    """

    def seal(df: DataFrame, k: int) -> tuple[DataFrame, tuple[int, int]]:
        told = Observation()
        # Of few edges, few files: rounds are many and each reads them.
        df = df if before is None else df.coalesce(max(8, -(-before[0] // ROWS)))
        out = work.save(df.observe(told, F.count("*").alias("n"), F.coalesce(F.sum(F.hash("u", "v").cast("decimal(20,0)")), F.lit(0)).alias("s")), f"{name}-e{k}")
        return out, (told.get["n"], told.get["s"])

    before = None
    stars, before = seal(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), 0)
    k = 0
    while before[0]:
        k += 1
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = work.save(least.coalesce(max(8, -(-2 * before[0] // ROWS))), f"{name}-m{k}")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("vs"))
        linked = small.select("m", F.explode(F.concat(F.array("u"), "vs")).alias("u")).where("u <> m").select("u", F.col("m").alias("v"))
        stars, now = seal(linked, k)
        for old in (f"{name}-m{k}", f"{name}-e{k - 1}"):
            work.drop(old)
        if now == before:
            break
        before = now
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots)
