"""Exact top-k inner product search with a KD-tree for each shard.

Vectors become integers (floor(scale * x)), so scores are exact.  Vectors are dealt to shards
by a hash of their id; a shard's tree splits at the median of the widest dimension and keeps
the tight bounding box of every node.  A box bounds the inner product with a query from above
(each dimension takes the end of the box that the query's sign prefers), and a best-first
traversal opens boxes by falling bound until the bound is below the kth score.

Round 1 searches each query's home shard, the one its own vector is in.  Round 2 searches all
other shards and starts from the kth score of round 1, so most boxes stay closed.  Queries
grow with the vectors, so neither side is broadcast: a task holds the tree of one shard and
streams the queries of one part past it in blocks.

Defined results
---------------
* null vectors, empty ones and those with a null or non-finite component take no part; a null
  id takes no part either.
* a query is compared with vectors of its own length only.
* repeated rows: each is a candidate of its own; all rows with the query's id are excluded,
  and a repeated query id is asked once, with its smallest vector.  Ties in score go to the
  smaller id.
* further columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.common import written


@dataclass(frozen=True)
class Search:
    """``shard_rows`` bounds a tree on average, ``part_queries`` the queries that pass one tree in a task."""

    k: int = 5
    scale: int = 256
    shard_rows: int = 8192
    part_queries: int = 20_000
    leaf_rows: int = 128


class Tree:
    """A KD-tree with tight boxes over integer vectors, for inner products."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int):
        order = np.arange(len(ids))
        self.spans, self.children, low, high = [], [], [], []
        stack = [(0, len(ids), -1)]
        while stack:
            a, b, parent = stack.pop()
            part = vectors[order[a:b]]
            node = len(self.spans)
            if parent >= 0:
                self.children[parent].append(node)
            self.spans.append((a, b))
            self.children.append([])
            low.append(part.min(0))
            high.append(part.max(0))
            wide = int(np.argmax(high[-1] - low[-1]))
            if b - a > leaf_rows and high[-1][wide] > low[-1][wide]:
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, wide], half)]
                stack += [(a, a + half, node), (a + half, b, node)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = np.stack(low), np.stack(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that a vector in each node's box scores, per query and node."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, bounds: np.ndarray, own: int, k: int, floor: float) -> list[tuple[float, int]]:
        """The k best (score, -id) that score at least ``floor``; the query's own id is left out."""
        best: list[tuple[float, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < floor:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= floor:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            a, b = self.spans[node]
            scores = self.vectors[a:b] @ query
            for i in np.flatnonzero(scores >= floor).tolist():
                found = (float(scores[i]), -int(self.ids[a + i]))
                if found[1] == -own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
                if len(best) == k:
                    floor = max(floor, best[0][0])
        return best


def integer_vectors(table: DataFrame, cfg: Search) -> DataFrame:
    """(vec_id, vector) of the rows that take part; vectors as whole numbers in doubles."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    vector = F.col("embedding").cast("array<double>")
    return (table.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).select("vec_id", vector.alias("vector"))
            .where(F.forall("vector", finite))
            .select("vec_id", F.transform("vector", lambda x: F.floor(x * cfg.scale).cast("double")).alias("vector")))


def _shards(table: DataFrame, n_shards: int) -> DataFrame:
    """Adds ``dim`` and ``shard``; rows of one dim and shard meet in one tree."""
    return table.withColumn("dim", F.size("vector")).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).cast("int"))


def _search(vectors: DataFrame, asked: DataFrame, n_parts: int, n_tasks: int, cfg: Search) -> DataFrame:
    """(query_id, score, vec_id): for each row of ``asked`` (query_id, query, floor, dim, shard, part)
    the best of the tree of its shard.  Rows of a tree come first in a task, then its queries."""
    every_part = vectors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    stream = (every_part.select("dim", "shard", "part", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "vector",
                                F.lit(float("-inf")).alias("floor"))
              .unionByName(asked.select("dim", "shard", "part", F.lit(1).alias("kind"), F.col("query_id").alias("id"),
                                        F.col("query").alias("vector"), "floor"))
              .repartition(n_tasks, "dim", "shard", "part").sortWithinPartitions("dim", "shard", "part", "kind", "id"))

    def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
        return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "part", "kind")], 1)
        cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], 1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if b > a:
                yield tuple(keys[a].tolist()), batch.slice(a, b - a)

    def run(batches):
        at, rows, tree = None, [], None
        for batch in batches:
            found = []
            for (dim, shard, part, kind), block in groups(batch):
                if (dim, shard, part) != at:
                    at, rows, tree = (dim, shard, part), [], None
                ids, values = block.column("id").to_numpy(), matrix(block, dim)
                if kind == 0:
                    rows.append((ids, values))
                    continue
                if not rows:
                    continue
                if tree is None:
                    tree = Tree(*(np.concatenate(c) for c in zip(*rows, strict=True)), cfg.leaf_rows)
                floors = block.column("floor").to_numpy()
                for i in range(0, len(ids), 256):
                    bounds = tree.bounds(values[i:i + 256])
                    for j, (own, query, floor) in enumerate(zip(ids[i:i + 256].tolist(), values[i:i + 256], floors[i:i + 256].tolist(), strict=True)):
                        found += [(own, score, -less) for score, less in tree.search(query, bounds[j], own, cfg.k, floor)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64(), pa.float64(), pa.int64()], strict=True)],
                    names=["query_id", "score", "vec_id"])

    return stream.mapInArrow(run, "query_id long, score double, vec_id long")


def top_k(table: DataFrame, is_query: Column, cfg: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``table`` (vec_id, embedding) with the highest
    inner product with each row that ``is_query`` selects."""
    vectors = written(integer_vectors(table, cfg), "vectors")
    n_shards = max(1, -(-vectors.count() // cfg.shard_rows))
    vectors = _shards(vectors, n_shards)
    queries = vectors.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "vector")).alias("q"))
    queries = written(queries.select(F.col("vec_id").alias("query_id"), F.col("q.vector").alias("query"), F.col("q.dim").alias("dim")), "queries")
    n_parts = max(1, -(-queries.count() // cfg.part_queries))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(n_parts)).cast("int"))
    home = F.pmod(F.xxhash64("query_id"), F.lit(n_shards)).cast("int")

    n_tasks = n_shards * n_parts
    near = written(_search(vectors, queries.withColumn("shard", home).withColumn("floor", F.lit(float("-inf"))), n_parts, n_tasks, cfg), "home")
    kth = near.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    floor = F.when(F.col("n") >= cfg.k, F.col("least")).otherwise(F.lit(float("-inf")))
    others = F.filter(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: s != home)
    asked = queries.join(kth, "query_id", "left").withColumn("floor", floor).withColumn("shard", F.explode(others))
    far = _search(vectors, asked, n_parts, n_tasks, cfg)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (near.union(far).withColumn("rank", rank).where(F.col("rank") <= cfg.k)
            .select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score")))
