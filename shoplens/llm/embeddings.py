"""Near-duplicate vectors by sorted projection passes.

In each pass the vectors are ordered by the concatenated signs of random projections, and each is
compared with the neighbours in a bounded window of that order. The links verified in any pass are
united into components. Links are then counted exactly inside each component: a component whose
vectors all lie within half the angle of its first vector is linked throughout; any other one is
compared block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from shoplens.llm.components import components
from shoplens.llm.storage import Scratch

SIGNS = 48
WINDOW = 512
BLOCK = 1024
MISSED = 1e-4
ROWS_PER_PARTITION = 32768
SEED = 77


def units(raw: pd.Series) -> np.ndarray:
    """Unit vectors, in double precision, of vectors of one length stored as bytes."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def passes_for(n: int, least: float, window: int) -> int:
    """Passes after which a pair of cosine ``least`` is missed with probability ``MISSED``."""
    bits = max(0.0, math.log2(max(n, 1) / window))
    together = (1 - math.acos(least) / math.pi) ** bits
    return 2 + math.ceil(math.log(MISSED) / math.log(1 - min(together, 0.9)))


def _keys(n_passes: int):
    weights = np.uint64(1) << np.arange(SIGNS, dtype=np.uint64)[::-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                x = units(own["vec"])
                for k in range(n_passes):
                    lines = np.random.default_rng((SEED, k)).standard_normal((dim, SIGNS))
                    key = ((x @ lines > 0) * weights).sum(axis=1, dtype=np.uint64)
                    yield own.assign(turn=k, key=key.astype(np.int64))

    return run


def _linked(x: np.ndarray, least: float) -> np.ndarray:
    """For each row, the first row of its connected part."""
    near = x @ x.T >= least
    part = np.arange(len(x))
    while True:
        lower = np.where(near, part[None, :], len(x)).min(axis=1)
        lower = np.minimum(lower, part)
        lower = lower[lower]
        if (lower == part).all():
            return part
        part = lower


def _neighbours(least: float, window: int):
    """Compares each row with ``window`` rows before and after it in its pass, at the least."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat((held, batch), ignore_index=True)
            for _, own in rows.groupby(["turn", "dim"], sort=False):
                ids, x = own["vec_id"].to_numpy(), units(own["vec"])
                for k in range(0, max(len(own) - window, 1), window):
                    part = _linked(x[k : k + 2 * window], least)
                    moved = np.flatnonzero(part != np.arange(len(part)))
                    if len(moved):
                        yield pd.DataFrame({"a": ids[k + moved], "b": ids[k + part[moved]]})
            held = rows.iloc[-window:]

    return run


@F.pandas_udf(DoubleType())
def _cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.zeros(len(a))
    for dim, at in a.map(len).groupby(a.map(len).to_numpy()).groups.items():
        assert dim
        out[at] = (units(a[at]) * units(b[at])).sum(axis=1)
    return pd.Series(out)


def _block_counts(least: float):
    """Links between two blocks of a component, for the rows of either side."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                x, y = (units(pd.Series([m["vec"] for m in side])) for side in (r.rows_a, r.rows_b))
                near = x @ y.T >= least
                a, b = ([m["copies"] for m in side] for side in (r.rows_a, r.rows_b))
                ids = [m["vec_id"] for m in r.rows_a]
                counts = near @ np.array(b)
                if r.block_a != r.block_b:
                    ids = ids + [m["vec_id"] for m in r.rows_b]
                    counts = np.concatenate((counts, near.T @ np.array(a)))
                yield pd.DataFrame({"vec_id": ids, "near": counts})

    return run


def _exact_counts(members: DataFrame, classes: DataFrame, least: float, block: int) -> DataFrame:
    """``vec_id, near``: the vectors linked with each class, its own copies included."""
    firsts = classes.select(F.col("vec_id").alias("component"), F.col("vec").alias("first"))
    close = members.join(firsts, "component").withColumn("cosine", _cosine("vec", "first"))
    shape = close.groupBy("component").agg(
        F.min("cosine").alias("farthest"), F.sum("copies").alias("size"), F.count("*").alias("n")
    )
    half_angle = math.sqrt((1 + least) / 2) + 1e-9
    whole = shape.filter(F.col("farthest") >= half_angle).select("component", "size")
    whole = members.join(whole, "component").select("vec_id", F.col("size").alias("near"))
    loose = shape.filter(F.col("farthest") < half_angle)
    loose = loose.select("component", F.ceil(F.col("n") / block).alias("blocks"))
    blocks = (
        members.join(loose, "component")
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
        .groupBy("component", "block")
        .agg(F.collect_list(F.struct("vec_id", "copies", "vec")).alias("rows"))
    )
    left = blocks.toDF("component", "block_a", "rows_a")
    right = blocks.toDF("component", "block_b", "rows_b")
    counted = (
        left.join(right, "component")
        .filter("block_a <= block_b")
        .mapInPandas(_block_counts(least), "vec_id long, near long")
        .groupBy("vec_id")
        .agg(F.sum("near").alias("near"))
    )
    return whole.unionByName(counted)


def near_duplicates(
    vectors: DataFrame, least: float = 0.9, window: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding)``.

    Two vectors of one length are linked if their cosine, in double precision, is at least
    ``least`` (above 0). Vectors that are NULL, empty, zero or hold NULL or non-finite components
    are linked with nothing. Equal vectors are one class, compared once; rows that repeat a
    ``vec_id`` are vectors of their own under that id. The number of passes follows from the number
    of classes, so that a component is rarely missed; inside the components found, the counts are
    exact.
    """
    scratch = Scratch(vectors.sparkSession)
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))
    bare = vectors.select("vec_id", F.when(usable, x).alias("x"))
    stored = scratch.store(bare.mapInPandas(_as_bytes, "vec_id long, dim int, vec binary"), "rows")
    classes = scratch.store(
        stored.filter("vec is not null")
        .groupBy("vec", "dim")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")),
        "classes",
    )
    n = classes.count()
    n_passes = passes_for(n, least, window)
    links = (
        classes.select("vec_id", "dim", "vec")
        .mapInPandas(_keys(n_passes), "vec_id long, dim int, vec binary, turn int, key long")
        .repartitionByRange(max(1, n * n_passes // ROWS_PER_PARTITION), "turn", "dim", "key")
        .sortWithinPartitions("turn", "dim", "key")
        .mapInPandas(_neighbours(least, window), "a long, b long")
    )
    found = components(links, scratch).toDF("vec_id", "component")
    members = classes.join(found, "vec_id")
    near = _exact_counts(members, classes, least, block)
    per_class = (
        classes.join(found, "vec_id", "left").join(near, "vec_id", "left")
        .select(
            "vec", F.coalesce("near", "copies").alias("near"),
            F.coalesce("component", "vec_id").alias("component"),
        )
    )
    result = stored.join(per_class, "vec", "left")
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce(F.col("near") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )


def _as_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        vec = [None if v is None else np.asarray(v, np.float64).tobytes() for v in batch["x"]]
        dim = [None if v is None else len(v) // 8 for v in vec]
        out = pd.DataFrame({"vec_id": batch["vec_id"], "vec": vec})
        yield out.assign(dim=pd.array(dim, "Int32"))[["vec_id", "dim", "vec"]]
