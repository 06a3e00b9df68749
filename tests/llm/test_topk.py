import math
import random

import pytest

from shoplens.llm import topk

DDL = "vec_id long, embedding array<float>"


def expected(rows, every, k):
    own = []
    for i, x in rows:
        if i is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        own.append((i, [math.floor(64 * v) for v in x]))
    out = []
    for a, (i, x) in enumerate(own):
        if i % every:
            continue
        scored = [
            (-sum(p * q for p, q in zip(x, y)), j) for b, (j, y) in enumerate(own) if a != b
        ]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def vectors(seed, n, size, shift=0.0):
    rng = random.Random(seed)
    # eighths are exact as floats, and many scores tie
    return [(k, [rng.randrange(-16, 17) / 8 + shift for _ in range(size)]) for k in range(n)]


@pytest.mark.parametrize(
    ("n", "size", "shift", "k", "shard", "block"),
    [(400, 6, 0, 5, 64, 8), (700, 3, 0, 20, 300, 40), (300, 4, -3, 7, 100, 5), (500, 5, 3, 3, 4096, 4096),
     (30, 4, 0, 20, 7, 1), (15, 4, 0, 20, 4096, 4096)],
)
def test_equals_brute_force(spark, n, size, shift, k, shard, block):
    rows = vectors(n, n, size, shift)
    df = spark.createDataFrame(rows, DDL).repartition(3)
    found = topk.search(df, 10, k, shard_rows=shard, query_rows=block)
    assert sorted(map(tuple, found.collect())) == expected(rows, 10, k)


def test_odd_rows(spark):
    rows = vectors(1, 150, 4) + [
        (None, [1.0] * 4), (1000, None), (1001, [1.0, None, 1.0, 1.0]),
        (1010, [math.nan, 1.0, 1.0, 1.0]), (1020, [math.inf, 1.0, 1.0, 1.0]), (1030, []),
        (1040, [0.0] * 4), (1050, [2.0]), (1060, [1.0] * 9), (-20, [-1.0] * 4),
    ]
    # a third of the rows are the same, id included
    rows += [(2000, [2.0, 2.0, 2.0, 2.0])] * 70
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 as rank", "2 as row", "3 as block")
    found = topk.search(df, 10, 4, shard_rows=50, query_rows=10)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == expected(rows, 10, 4)


def test_empty(spark):
    df = spark.createDataFrame([], DDL)
    assert topk.search(df).collect() == []
    one = spark.createDataFrame([(20, [1.0])], DDL)
    assert topk.search(one).collect() == []
