import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import embeddings

VECTORS = "vec_id long, embedding array<float>"


def expected(rows, least):
    """Links and components by brute force."""
    ok = {}
    for k, (vec_id, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, np.float32).astype(float)
            ok[k] = (vec_id, x / np.linalg.norm(x))
    near = {
        a: [b for b in ok if a != b and len(ok[a][1]) == len(ok[b][1])
            and ok[a][1] @ ok[b][1] >= least]
        for a in ok
    }
    out = []
    for k, (vec_id, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for b in near.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out.append((vec_id, len(near.get(k, ())), min(rows[s][0] for s in seen)))
    return sorted(out)


def clustered(seed, groups, size, noise, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(int(rng.integers(1, size))):
            v = centre + noise * rng.standard_normal(dim)
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)]))
    return rows


@pytest.mark.parametrize(("noise", "block"), [(0.05, 1024), (0.22, 1024), (0.22, 4)])
def test_links_and_components_equal_those_of_all_pairs(spark, noise, block):
    rows = clustered(3, 40, 12, noise)
    docs = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as component", "2 as copies")
    found = embeddings.near_duplicates(docs, 0.9, window=64, block=block).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == expected(rows, 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_bad_vectors_link_with_nothing_and_copies_with_each_other(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [1.0, None]), (6, [inf, 1.0]),
        (9, [1.0, 0.0]), (8, [1.0, 0.0]), (10, [2.0, 0.0]), (11, [1.0, 0.0, 0.0]),
        (12, [1e30, 1e30]), (13, [1e-30, 1e-30]), (14, [-1.0, 0.0]), (14, [-1.0, 0.0]),
    ]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in found)
    assert got == expected(rows, 0.9)
    assert embeddings.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_recall_over_a_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = embeddings.near_duplicates(table, 0.9).agg(F.sum("n_links")).first()[0]
    x = np.array([r.embedding for r in table.collect()], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = int((x @ x.T >= 0.9).sum()) - len(x)
    assert 0.99 * links <= found <= links


def test_more_vectors_take_more_passes():
    counts = [embeddings.passes_for(n, 0.9, 512) for n in (0, 100, 10**5, 10**7)]
    assert counts == sorted(counts) and counts[0] >= 2
