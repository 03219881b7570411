"""Approximate nearest neighbours by inner product: an LSH forest of sorted hash strings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, by_group, int64, table

#: Bits of a hash string: one word, longer than any useful prefix of a block.
BITS = 64


@dataclass(frozen=True)
class Forest:
    """trees: sorted arrays of hash strings per block. share: of a block's vectors, those that a query
    climbs to at least before it is scored (synchronously in all trees). block: vectors of a block,
    and queries that meet it at once. seed: of the hyperplanes."""

    k: int = 20
    trees: int = 24
    share: float = 0.6
    block: int = 2048
    seed: int = 20


def planes(dim: int, config: Forest) -> np.ndarray:
    return np.random.default_rng(config.seed).standard_normal((config.trees, BITS, dim))


def codes(x: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Hash strings (trees, rows): the sides of the hyperplanes, first bit highest."""
    out = np.empty((len(normals), len(x)), np.uint64)
    shifts = np.arange(BITS - 1, -1, -1, dtype=np.uint64)
    for t, n in enumerate(normals):
        out[t] = ((x @ n.T > 0).astype(np.uint64) << shifts).sum(1, dtype=np.uint64)
    return out


class Block:
    """The forest of one block. The vectors get one more coordinate that makes their norms equal, so
    that the angle to a query orders them as the inner product does."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, config: Forest):
        self.ids, self.x, self.config = ids, x, config
        square = (x * x).sum(1)
        level = np.column_stack([x, np.sqrt(np.maximum(square.max() - square, 0))])
        self.normals = planes(level.shape[1], config)
        strings = codes(level, self.normals)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, 1)

    def _ranges(self, sought: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the strings that share a prefix of this length with each sought one are, by tree."""
        rest = np.where(length > 0, (np.uint64(1) << (np.uint64(BITS) - np.maximum(length, 1).astype(np.uint64))) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
        low = np.stack([np.searchsorted(t, s & ~rest, "left") for t, s in zip(self.strings, sought, strict=True)])
        high = np.stack([np.searchsorted(t, s | rest, "right") for t, s in zip(self.strings, sought, strict=True)])
        return low, high

    def candidates(self, queries: np.ndarray) -> Iterator[np.ndarray]:
        """Of each query the rows of its candidates. It descends every tree to its longest matching prefix
        and climbs all trees together until enough rows share a prefix with it. Counts only grow on the
        way up, so the climb is bisected first by how many entries match and then goes on bit by bit
        while too few of them are distinct rows."""
        n = len(self.ids)
        wanted = max(min(n, 2 * self.config.k), int(np.ceil(self.config.share * n)))
        sought = codes(np.column_stack([queries, np.zeros(len(queries))]), self.normals)
        least, most = np.zeros(len(queries), np.int64), np.full(len(queries), BITS, np.int64)
        while (least < most).any():
            length = (least + most + 1) // 2
            low, high = self._ranges(sought, length)
            enough = (high - low).sum(0) >= wanted
            least, most = np.where(enough, length, least), np.where(enough, most, length - 1)
        open_, found = np.arange(len(queries)), [np.empty(0, np.int64)] * len(queries)
        while len(open_):
            low, high = self._ranges(sought[:, open_], least[open_])
            for k, q in enumerate(open_):
                seen = np.zeros(n, bool)
                for t, order in enumerate(self.order):
                    seen[order[low[t, k] : high[t, k]]] = True
                found[q] = np.nonzero(seen)[0]
            open_ = open_[[len(found[q]) < wanted and least[q] > 0 for q in open_]]
            least[open_] -= 1
        yield from found

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for own, q, rows in zip(query_ids, queries, self.candidates(queries), strict=True):
            rows = rows[self.ids[rows] != own]
            score = self.x[rows] @ q
            best = np.lexsort([self.ids[rows], -score])[: self.config.k]
            yield self.ids[rows[best]], score[best]


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, is_query: Column, config: Forest = Forest()) -> DataFrame:
    """vectors: vec_id (long), embedding (array of numbers); is_query: which rows ask. Returns query_id,
    rank (from 1), vec_id, score: of each query the k largest inner products found, in double
    precision, ties to the smaller vec_id, its own vec_id left out; all others if there are fewer.

    Every row is in the index: blocks by a hash of vec_id, each with its own forest, so that they build
    and search independently; a task holds one block and one set of queries.
    Nulls: rows with null vec_id, and vectors that are null, zero or hold null or non-finite components,
    take no part; nor do vectors of another length than most. Repeated rows: of one vec_id the row with
    the smallest vector counts. Empty input, or no query, gives no rows. Other columns are ignored.
    """
    work = Work(spark, "forest")
    v = F.col("embedding").cast("array<double>")
    sound = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    sound = work.save(sound, "sound")
    lengths = sound.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).orderBy(F.desc("n"), "dim").first()
    result = "query_id long, rank int, vec_id long, score double"
    if lengths is None or not lengths["q"]:
        return spark.createDataFrame([], result)
    dim, blocks, asked = lengths["dim"], -(-lengths["n"] // config.block), -(-lengths["q"] // config.block)
    sound = sound.where(F.size("v") == dim)

    def place(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n))

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    base = sound.select("vec_id", "v", F.lit(False).alias("asks"), place(blocks, 0).alias("b")).select("*", all_of(asked).alias("q"))
    asking = sound.where("asks").select("vec_id", "v", "asks", place(asked, 1).alias("q")).select("vec_id", "v", "asks", all_of(blocks).alias("b"), "q")

    def search(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, asks = group.column("vec_id").to_numpy(), group.column("asks").to_numpy(zero_copy_only=False)
        x = group.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        parts = []
        for own in (~asks, asks):
            i, y = ids[own], x[own]
            order = np.lexsort([*y.T[::-1], i])
            i, y = i[order], y[order]
            first = np.concatenate([[True], i[1:] != i[:-1]]) if len(i) else np.empty(0, bool)
            parts.append((i[first], y[first]))
        (ids, x), (query_ids, queries) = parts
        if not len(ids) or not len(queries):
            return
        found = list(Block(ids, x, config).nearest(query_ids, queries))
        yield pa.RecordBatch.from_arrays([int64(query_ids), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], ["query_id", "ids", "scores"])

    per_block = work.save(by_group(base.unionByName(asking), ["b", "q"], search, "query_id long, ids array<long>, scores array<double>"), "per-block")

    def best(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, scores = group.column("ids").combine_chunks().flatten().to_numpy(), group.column("scores").combine_chunks().flatten().to_numpy()
        top = np.lexsort([ids, -scores])[: config.k]
        yield pa.RecordBatch.from_arrays([int64(np.full(len(top), group.column("query_id")[0].as_py())), pa.array(np.arange(1, len(top) + 1, dtype=np.int32)), int64(ids[top]), pa.array(scores[top])], ["query_id", "rank", "vec_id", "score"])

    return by_group(per_block, ["query_id"], best, result)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark, table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)
