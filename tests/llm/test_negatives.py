"""Hard negatives against a plain loop."""
import random

import numpy as np
import pytest

from tallywatch.llm import kdtree, negatives

SCHEMA = "vec_id long, label int, v array<double>, shard int, block int, asked long"


def plain(rows, every, positives=5, best=5):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None]
    score = lambda a, b: sum(int(x) * int(y) for x, y in zip(a[2], b[2]))
    out = []
    for a in rows:
        if a[0] % every:
            continue
        others = [(-score(a, r), r[0], r[1]) for r in rows if r[0] != a[0]]
        for p, i, _ in sorted(o for o in others if o[2] == a[1])[:positives]:
            fit = sorted((n, j) for n, j, label in others if label != a[1] and 80 * -p <= 100 * -n <= 100 * -p)
            out += [(a[0], i, rank + 1, j, -p, -n) for rank, (n, j) in enumerate(fit[:best])]
    return sorted(out)


def random_rows(seed, n, dims, size, labels=4):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(labels), [float(rng.randint(-size, size)) for _ in range(dims)], 1, 2, 3) for i in range(n)]
    hot = [float(rng.randint(0, size)) for _ in range(dims)]
    # A third of the rows share a vector; ties, zeros, nulls, repeated rows and ids, unlike lengths.
    rows += [(n + i, i % 2, hot, 1, 2, 3) for i in range(n // 2)]
    rows += [(2 * n, 0, [0.0] * dims, 1, 2, 3), (2 * n + 1, None, hot, 1, 2, 3), (2 * n + 2, 1, None, 1, 2, 3), (None, 1, hot, 1, 2, 3), (0, 1, hot, 1, 2, 3), (0, 1, hot, 1, 2, 3),
             (2 * n + 3, 1, hot[:dims // 2], 1, 2, 3), (2 * n + 4, labels + 5, hot, 1, 2, 3)]
    return rows


@pytest.mark.parametrize("shard_rows,asked_rows", [(10_000, 10_000), (40, 5)])
@pytest.mark.parametrize("seed,dims,size", [(1, 20, 30), (2, 3, 2), (3, 12, 10**9)])
def test_rows_equal_a_plain_loop(spark, seed, dims, size, shard_rows, asked_rows):
    rows = random_rows(seed, 160, dims, size)
    df = spark.createDataFrame(rows, SCHEMA)
    got = negatives.hard_negatives(df, df.where("vec_id % 10 = 0"), shard_rows=shard_rows, asked_rows=asked_rows)
    want = plain(rows, 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_scan_drops_rows_before_the_last_dimension():
    rng = np.random.default_rng(1)
    spread = np.geomspace(1, 0.01, 64)
    vectors = np.floor(rng.normal(size=(5000, 64)) * spread * 256)
    shard = negatives.Columns(np.arange(5000), np.zeros(5000), vectors)
    read = []
    scan = shard.steps

    def counted(anchor, rows):
        inner, stay = scan(anchor, rows), None
        while True:
            step = inner.send(stay)
            read.append(len(step[0]))
            stay = yield step
    shard.steps = counted
    got = shard.nearest(vectors[0], np.arange(1, 5000), 5)
    score = vectors[1:] @ vectors[0]
    order = np.lexsort((np.arange(1, 5000), -score))[:5]
    assert [(int(j) + 1, score[j]) for j in order] == got
    assert read[0] == 4999 and sum(read) < 0.8 * 4999 * len(read) and read[-1] < 500


def test_empty_tables_and_no_positives(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(0, 1, [1.0, 2.0], 0, 0, 0), (1, 2, [1.0, 2.0], 0, 0, 0)], SCHEMA)
    assert negatives.hard_negatives(none, none).count() == 0
    assert negatives.hard_negatives(some, none).count() == 0
    assert negatives.hard_negatives(some, some).count() == 0


def test_null_and_not_finite_components(spark):
    rows = [(1, [1.0, None]), (2, [1.0, float("nan")]), (3, [float("inf"), 1.0]), (4, None), (5, [-0.001, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {r.vec_id: r.v for r in df.select("vec_id", kdtree.integers().alias("v")).collect()} == {1: None, 2: None, 3: None, 4: None, 5: [-1.0, 128.0]}
