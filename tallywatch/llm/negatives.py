"""Hard negatives by a vertical scan: dimensions are read one group after another, in each anchor's order of descending magnitude, and
rows that the rest can't lift into an answer are dropped on the way."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywatch.llm.words import ready
from tallywatch.session import settle

SHARD_ROWS = 16_384
#: Anchors that meet a shard in one task, about.
ASKED_ROWS = 4096
#: Dimensions that are read before bounds are taken anew.
STEP = 8
EXACT, LONG = 1 << 53, (1 << 63) - 1
POSITIVES = "asked long, row long, id long, score long"
NEGATIVES = "asked long, place int, id long, score long"


class Columns:
    """A shard's vectors by dimension, with each dimension's least and largest value."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.by_dimension = np.ascontiguousarray(vectors.T)
        self.low, self.high = self.by_dimension.min(axis=1), self.by_dimension.max(axis=1)

    def steps(self, anchor: np.ndarray, rows: np.ndarray):
        """After each group of dimensions: the rows left, their partial scores, and what the dimensions not read can add at least and
        at most. The consumer sends back which rows stay. After the last group the scores are exact."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        least, most = (np.concatenate((np.cumsum(e[::-1])[::-1], [0])) for e in (ends.min(axis=0), ends.max(axis=0)))
        score = np.zeros(len(rows), self.by_dimension.dtype)
        for at in range(0, len(order), STEP):
            dims = order[at:at + STEP]
            read = self.by_dimension[dims] if len(rows) == len(self.ids) else self.by_dimension[dims[:, None], rows]
            score = score + anchor[dims] @ read
            stay = yield rows, score, least[min(at + STEP, len(order))], most[min(at + STEP, len(order))]
            if not stay.all():
                rows, score = rows[stay], score[stay]
        yield rows, score, 0, 0

    def nearest(self, anchor: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(row, score) of the k best of these rows, ties to the smaller id."""
        scan, stay = self.steps(anchor, rows), None
        while True:
            rows, score, least, most = scan.send(stay)
            if least == 0 == most:
                break
            stay = np.ones(len(rows), bool) if len(rows) <= k else score + most >= _kth(score, k) + least
        return [(int(rows[j]), score[j]) for j in _first(score, self.ids[rows], k)]

    def within(self, anchor: np.ndarray, rows: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """For each window (low, high) of scores, both inside: (id, score) of its k best rows, ties to the smaller id."""
        scan, stay = self.steps(anchor, rows), None
        while True:
            rows, score, least, most = scan.send(stay)
            if least == 0 == most:
                break
            stay = np.zeros(len(rows), bool)
            for low, high in windows:
                # Rows surely inside set the least score that can still count.
                sure = score[(score + least >= low) & (score + most <= high)]
                floor = max(low, _kth(sure, k) + least) if len(sure) >= k else low
                stay |= (score + most >= floor) & (score + least <= high)
        out = []
        for low, high in windows:
            inside = np.flatnonzero((score >= low) & (score <= high))
            out.append([(int(self.ids[rows[inside[j]]]), score[inside[j]]) for j in _first(score[inside], self.ids[rows[inside]], k)])
        return out


def _kth(score: np.ndarray, k: int):
    """The k-th highest of at least k scores."""
    return sorted(score)[-k] if score.dtype == object else np.partition(score, len(score) - k)[len(score) - k]


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by smaller id."""
    best = np.flatnonzero(score >= _kth(score, k)) if len(score) > k else np.arange(len(score))
    if score.dtype == object:
        return np.array(sorted(best, key=lambda j: (-score[j], ids[j]))[:k], dtype=np.int64)
    return best[np.lexsort((ids[best], -score[best]))][:k]


def _whole(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of whole numbers, padded with zeros to `width`."""
    flat = column.combine_chunks()
    length = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(length), width))
    at = np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(np.arange(len(length)), length), at] = values
    return out


def _exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides as doubles where every sum is exact, else as Python's integers."""
    if rows.size and anchors.size and float(np.abs(rows).max()) * float(np.abs(anchors).max()) * rows.shape[1] >= EXACT:
        return tuple(np.array([[int(x) for x in v] for v in side], dtype=object).reshape(side.shape) for side in (rows, anchors))
    return rows, anchors


def _long(score) -> int:
    return max(-LONG - 1, min(LONG, int(score)))


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   shard_rows: int = SHARD_ROWS, asked_rows: int = ASKED_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both sides: vec_id, label, v (array of doubles holding whole numbers); anchors are some of the rows. An anchor's positives are its
    first rows of the same label; for each of them the first rows of other labels are returned whose score n satisfies
    low * p <= 100 * n <= high * p, p being the positive's. Higher scores come first, ties by smaller vec_id.

    Rows are dealt by label into shards of about `shard_rows` (a large label has many). An anchor looks for positives in the shards that
    hold its label, its positives' windows then go to the shards that hold another. Within a shard a column of values is kept for each
    dimension; each anchor reads them in its own order and drops rows between groups of dimensions, so most columns are read for few
    rows. A task holds one shard and about `asked_rows` anchors. All pairs of an anchor and a row of another label are covered.

    Null vec_id, label or v: takes no part. Rows of an anchor's vec_id are never its positives or negatives; of repeated rows each counts,
    as anchor, too. Unlike lengths: padded with zeros. Scores beyond a double's whole numbers are computed in Python's integers, beyond
    a long they count as the largest or smallest long. No positives, or none above 0 and no score of 0: no rows. Empty tables: no rows."""
    ready(vectors.sparkSession)
    taking = "vec_id is not null and label is not null and v is not null"
    rows = vectors.where(taking).select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), "v")
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    shards, width = max(1, -(-shape.n // shard_rows)), max(1, shape.width or 1)
    dealt = settle(rows.repartitionByRange(shards, "label", F.xxhash64("id"), "id").select("*", F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("row")))
    held = settle(dealt.select("shard", "label").distinct())
    asked = anchors.where(taking).select(F.monotonically_increasing_id().alias("asked"), F.col("vec_id").cast("long").alias("own"), F.col("label").cast("string").alias("label"), "v")
    asked = settle(asked)
    blocks = max(1, -(-asked.count() // asked_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("asked"), F.lit(blocks)).cast("int"))

    def meet(questions: DataFrame, run, schema: str) -> DataFrame:
        # A shard goes only to the blocks that ask it.
        wanted = questions.select("shard", F.col("block").alias("turn")).distinct()
        return dealt.join(wanted, "shard").groupBy("shard", "turn").cogroup(questions.groupBy("shard", "block")).applyInArrow(run, schema)

    def sides(shard: pa.Table, block: pa.Table):
        found, asking = _exact(_whole(shard["v"], width), _whole(block["v"], width))
        return Columns(shard["id"].to_numpy(), np.array(shard["label"].to_pylist(), dtype=object), found), asking

    def find_positives(shard: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if len(shard) and len(block):
            columns, asking = sides(shard, block)
            numbers, own, labels = shard["row"].to_numpy(), block["own"].to_numpy(), block["label"].to_pylist()
            same = {label: np.flatnonzero(columns.labels == label) for label in set(labels)}
            for j, number in enumerate(block["asked"].to_pylist()):
                candidates = same[labels[j]]
                candidates = candidates[columns.ids[candidates] != own[j]]
                found += [(number, int(numbers[r]), int(columns.ids[r]), _long(s)) for r, s in columns.nearest(asking[j], candidates, positives)]
        return _table(found, ["asked", "row", "id", "score"], [pa.int64()] * 4)

    def find_negatives(shard: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if len(shard) and len(block):
            columns, asking = sides(shard, block)
            labels, own = block["label"].to_pylist(), block["own"].to_numpy()
            other = {label: np.flatnonzero(columns.labels != label) for label in set(labels)}
            for j, (number, scores) in enumerate(zip(block["asked"].to_pylist(), block["scores"].to_pylist())):
                candidates = other[labels[j]]
                candidates = candidates[columns.ids[candidates] != own[j]]
                windows = [(-(-low * p // 100), high * p // 100) for p in scores]
                for place, hits in enumerate(columns.within(asking[j], candidates, windows, negatives)):
                    found += [(number, place, i, _long(s)) for i, s in hits]
        return _table(found, ["asked", "place", "id", "score"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()])

    first = meet(asked.join(held, "label"), find_positives, POSITIVES)
    rank = F.row_number().over(W.partitionBy("asked").orderBy(F.desc("score"), "id", "row"))
    first = first.withColumn("rank", rank).where(F.col("rank") <= positives)
    chosen = settle(first.groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p")))
    questions = asked.join(chosen, "asked").withColumn("scores", F.transform("p", lambda p: p.score))
    pure = held.groupBy("shard").agg(F.count("*").alias("labels"), F.first("label").alias("label")).where("labels = 1").drop("labels")
    questions = questions.drop("p").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(pure, ["shard", "label"], "left_anti")
    hits = meet(questions, find_negatives, NEGATIVES)
    rank = F.row_number().over(W.partitionBy("asked", "place").orderBy(F.desc("score"), "id")).cast("int")
    hits = hits.withColumn("rank", rank).where(F.col("rank") <= negatives)
    who = asked.select("asked", F.col("own").alias("anchor_id")).join(chosen, "asked")
    p = F.get("p", F.col("place"))
    return hits.join(who, "asked").select("anchor_id", p.id.alias("positive_id"), "rank", F.col("id").alias("negative_id"), p.score.alias("positive_score"),
                                          F.col("score").alias("negative_score"))


def _table(found: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*found)) or [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)
