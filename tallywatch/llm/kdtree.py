"""Exact top-k search by inner product: a KD-tree per shard, searched best first."""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywatch.llm.words import ready

LEAF = 64
QUERY_BLOCK = 256
SHARD_ROWS = 8192
#: Queries that meet a shard in one task, about.
ASKED_ROWS = 8192
HITS = "query_id long, vec_id long, score long"
NONE = np.iinfo(np.int64).min


class Tree:
    """Vectors split at medians of the widest dimension; each node has a tight box and the smallest id below it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.ids, self.vectors = ids, vectors
        self.most = np.abs(vectors).max(initial=0.0)
        self.low, self.high, self.least, self.child, self.rows = [], [], [], [], []
        self._build(np.arange(len(ids)), leaf)
        self.low, self.high, self.least = np.array(self.low), np.array(self.high), np.array(self.least)

    def _build(self, rows: np.ndarray, leaf: int) -> int:
        todo = [(rows, -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            me = len(self.child)
            if parent >= 0:
                self.child[parent][side] = me
            v = self.vectors[rows]
            low, high = v.min(axis=0), v.max(axis=0)
            self.low.append(low), self.high.append(high), self.least.append(self.ids[rows].min())
            wide = int(np.argmax(high - low))
            if len(rows) <= leaf:
                self.child.append(None), self.rows.append(rows)
                continue
            # Equal vectors can't be split by value; they are split by id, and the least id prunes them.
            order = np.lexsort((self.ids[rows], v[:, wide]))
            half = len(rows) // 2
            self.child.append([0, 0]), self.rows.append(None)
            todo += [(rows[order[half:]], me, 1), (rows[order[:half]], me, 0)]
        return 0

    def search(self, query: np.ndarray, own: int, k: int, floor: int) -> list[tuple[int, int]]:
        """The k best (score, id) but the query's own row; equal scores go to smaller ids. `floor`: the kth score known from
        elsewhere; what lies below it can't be among the best."""
        positive = query > 0
        width = len(query)
        # Below 2**53 sums of whole doubles are exact; beyond, scores are summed as integers and bounds get the rounding error on top.
        exact = width * self.most * np.abs(query).max(initial=0.0) < 2.0**53
        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top

        def bound(nodes):
            corner = np.where(positive, self.high[nodes], self.low[nodes])
            return corner @ query if exact else corner @ query + np.abs(corner) @ np.abs(query) * (width * 2.0**-50)

        heap = [(-bound([0])[0], self.least[0], 0)]
        while heap:
            negative, least, node = heapq.heappop(heap)
            worst = best[0] if len(best) == k else (floor, -np.iinfo(np.int64).max)
            if (-negative, -least) < worst:
                if -negative < worst[0]:
                    break
                continue
            if self.child[node] is not None:
                pair = self.child[node]
                for b, c in zip(bound(pair), pair):
                    if b >= worst[0]:
                        heapq.heappush(heap, (-b, self.least[c], c))
                continue
            rows = self.rows[node]
            score = self.vectors[rows] @ query if exact else whole(self.vectors[rows], query)
            for j in np.flatnonzero(score >= worst[0]):
                i = int(self.ids[rows[j]])
                if i == own:
                    continue
                entry = (int(score[j]), -i)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -i) for s, i in best]


def whole(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers."""
    if (np.abs(vectors) @ np.abs(query) >= 2.0**62).any():
        raise OverflowError("inner products do not fit a long")
    return vectors.astype(np.int64) @ query.astype(np.int64)


def integers(embedding: str = "embedding"):
    """floor(256 * x) of every component as double; null for a vector that is null or holds a null or non-finite component."""
    e = F.col(embedding)
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(e.isNotNull() & ~bad, F.transform(e, lambda x: F.floor(x.cast("double") * 256.0).cast("double")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, asked_rows: int = ASKED_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products over all rows but its own.

    Both sides: vec_id, v (array of doubles holding whole numbers). Rows are dealt by hash into shards of about `shard_rows`;
    First every query searches one shard; the kth score it finds goes with the query to the other shards, where every box below it
    is passed by. The shards' best k are merged. A task holds a shard and a block of about `asked_rows` queries, so that it does
    not grow with the tables; the shard is sent, and its tree built, once for each block.

    Scores are exact up to 2**62, beyond which the job ends with an error. Of query rows with one vec_id the least vector is the query.

    Null v or null vec_id: takes no part. Vectors of another length than most: padded with zeros at the end (the inner product
    runs over common components). Rows of equal vec_id: each counts as a candidate; none of them is a candidate of their own query.
    Ties go to the smaller vec_id. Fewer than k candidates: all. Empty tables: no rows.
    """
    ready(vectors.sparkSession)
    v = vectors.where("v is not null and vec_id is not null").select("vec_id", "v")
    q = queries.where("v is not null and vec_id is not null").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    shards = max(1, -(-v.count() // shard_rows))
    dealt = v.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    home = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(shards)).cast("int")
    first = _search(dealt, q.select("query_id", "q", F.lit(NONE).alias("floor"), home.alias("shard")), k)
    if shards == 1:
        return _best(first, k)
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s"))
    floors = floors.select("query_id", F.when(F.col("n") >= k, F.col("s")).otherwise(F.lit(NONE)).alias("floor"))
    known = q.join(floors, "query_id", "left").select("query_id", "q", F.coalesce("floor", F.lit(NONE)).alias("floor"), home.alias("home"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
    blocks = max(1, -(-q.count() // asked_rows))
    rest = _search(dealt, known.select("query_id", "q", "floor", F.explode(others).alias("shard")), k, blocks)
    return _best(first.unionByName(rest), k)


def _search(dealt: DataFrame, asked: DataFrame, k: int, blocks: int = 1) -> DataFrame:
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if len(rows) and len(queries):
            tree = Tree(rows["vec_id"].to_numpy(), matrix(rows["v"]))
            width = tree.vectors.shape[1]
            for low in range(0, len(queries), QUERY_BLOCK):
                block = queries.slice(low, QUERY_BLOCK)
                q = matrix(block["q"])
                q = np.pad(q, ((0, 0), (0, max(0, width - q.shape[1]))))[:, :width]
                for i, own, floor in zip(range(len(block)), block["query_id"].to_pylist(), block["floor"].to_pylist()):
                    found += [(own, i_, s) for s, i_ in tree.search(q[i], own, k, floor)]
        columns = list(zip(*found)) or [()] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(blocks)).cast("int"))
    return dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, HITS)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    length = flat.value_lengths().to_numpy(zero_copy_only=False)
    width = int(length.max()) if len(length) else 0
    values = flat.flatten().to_numpy(zero_copy_only=False)
    if len(length) and (length == width).all():
        return values.reshape(len(length), width).astype(np.float64)
    out = np.zeros((len(length), width))
    at = np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(np.arange(len(length)), length), at] = values
    return out


def _best(hits: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
