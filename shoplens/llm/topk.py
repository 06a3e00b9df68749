"""Exact search for the rows with the largest inner products, by MaxScore.

A vector's terms are its dimensions. In a shard of candidates, a term's postings are the components
of that dimension, positive and negative ones, in blocks of candidates; a block's bounds are its
largest and smallest component. A query's component adds to a score at most its product with the
bound of its own sign. Terms whose bounds together cannot reach the k-th best score known are
non-essential: a candidate to which only these add is out. The essential postings are traversed, and
what can still compete is probed in the other dimensions, largest bound first, until it no longer
does. The bar rises from block to block; long vectors, which are likely to score high, come first.
The shards' best are merged.

Vectors are dense, so a block's postings are the columns of a matrix. Many queries traverse them at
once as a product of matrices, in which each query's non-essential components are 0.

Shards of candidates meet blocks of queries by number. Both are of bounded size.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shoplens.llm.storage import Scratch

SCALE = 64
TOP = 20
SHARD_ROWS = 1 << 14
QUERY_ROWS = 1024
# components of this size or more are outside of what is compared; see ``search``
LARGEST = 1 << 25
# candidates of the first block, which gives a bar; later ones double up to the other size
FIRST_ROWS, BLOCK_ROWS = 64, 1024
# terms that are probed before a pair is looked at again
PROBED = 6
# the share of pairs beyond which they are probed as matrices
MANY = 0.02
# queries that traverse postings together
TOGETHER = 256
FOUND = "query long, query_row long, vec_id long, score long"


class Postings:
    """The candidates of a shard, and for each block of them its bounds."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((ids, -np.square(vectors.astype(float)).sum(axis=1)))
        self.ids, self.rows, self.vectors = ids[order], rows[order], vectors[order]
        self.blocks, at, size = [], 0, FIRST_ROWS
        while at < len(ids):
            self.blocks.append((at, min(at + size, len(ids))))
            at, size = at + size, min(size * 2, BLOCK_ROWS)
        self.high = [np.maximum(self.vectors[a:b].max(axis=0, initial=0), 0) for a, b in self.blocks]
        self.low = [np.minimum(self.vectors[a:b].min(axis=0, initial=0), 0) for a, b in self.blocks]
        self.largest = int(np.abs(self.vectors).max(initial=0))

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """For several queries, ``query, position, score`` of their ``k`` best but the rows ``own``."""
        reach = int(np.abs(queries).max(initial=0)) * self.largest * max(queries.shape[1], 1)
        # doubles hold all sums exactly, and multiply much faster
        kind = np.float64 if reach < 1 << 53 else np.int64
        queries, vectors = queries.astype(kind), self.vectors.astype(kind, copy=False)
        best = tuple(np.zeros(0, np.int64) for _ in range(3))
        for (a, b), high, low in zip(self.blocks, self.high, self.low, strict=True):
            block = self._competing(queries, vectors[a:b], high, low, self._bars(best, len(queries), k))
            query, at, score = block
            other = self.rows[at + a] != own[query]
            best = self._best(best, (query[other], at[other] + a, score[other].astype(np.int64)), k)
        return best

    @staticmethod
    def _bars(best, n: int, k: int) -> np.ndarray:
        """The k-th best score of each query; where there are fewer, anything may compete."""
        query, _, score = best
        bars = np.full(n, np.iinfo(np.int64).min // 2)
        # they are ordered by query, best first
        ends = np.cumsum(np.bincount(query, minlength=n))
        full = np.bincount(query, minlength=n) == k
        bars[full] = score[ends[full] - 1]
        return bars

    @staticmethod
    def _competing(queries, vectors, high, low, bars):
        """The candidates of a block that reach the bar, with their scores."""
        bounds = np.where(queries > 0, queries * high, queries * low)
        rising = np.argsort(bounds, axis=1, kind="stable")
        # what the terms up to each one can give together
        together = np.cumsum(np.take_along_axis(bounds, rising, axis=1), axis=1)
        spare = (together < bars[:, None]).sum(axis=1)
        rank = np.empty_like(rising)
        np.put_along_axis(rank, rising, np.arange(rising.shape[1])[None, :], axis=1)

        def reach_of(terms):
            """What the first so many terms of each query can give."""
            last = np.take_along_axis(together, np.maximum(terms - 1, 0)[:, None], axis=1)[:, 0]
            return np.where(terms > 0, last, 0)

        partial = (queries * (rank >= spare[:, None])) @ vectors.T
        left = reach_of(spare)
        # equal scores compete, as the smaller id wins
        competing = partial >= (bars - left)[:, None]
        if competing.mean() > MANY:
            # so many pairs are probed together in all but the terms with the smallest bounds
            few = np.minimum(spare, PROBED)
            partial += (queries * ((rank >= few[:, None]) & (rank < spare[:, None]))) @ vectors.T
            spare, left = few, reach_of(few)
            competing = partial >= (bars - left)[:, None]
        query, at = np.nonzero(competing)
        score, rest = partial[query, at], left[query]
        for step in range(0, int(spare.max(initial=0)), PROBED):
            # the next terms of each pair's query, from that with the largest bound down
            place = spare[query, None] - 1 - step - np.arange(PROBED)
            term = np.take_along_axis(rising[query], np.maximum(place, 0), axis=1)
            row = query[:, None]
            score += np.where(place >= 0, queries[row, term] * vectors[at[:, None], term], 0).sum(1)
            rest -= np.where(place >= 0, bounds[row, term], 0).sum(1)
            stays = score + rest >= bars[query]
            query, at, score, rest = (x[stays] for x in (query, at, score, rest))
        return query, at, score

    def _best(self, held, fresh, k: int):
        query, at, score = (np.concatenate(x) for x in zip(held, fresh, strict=True))
        order = np.lexsort((self.ids[at], -score, query))
        query, at, score = query[order], at[order], score[order]
        begins = np.searchsorted(query, query)
        first = np.arange(len(query)) - begins < k
        return query[first], at[first], score[first]


def _matrix(group: pd.DataFrame, width: int) -> np.ndarray:
    """The components of a group's rows; those that a shorter vector lacks are 0."""
    out = np.zeros((len(group), width), np.int64)
    for k, own in enumerate(group["terms"]):
        out[k, : len(own)] = own
    return out


def _searched(width: int, k: int):
    def run(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(shard):
            return pd.DataFrame(columns=["query", "query_row", "vec_id", "score"])
        postings = Postings(
            shard["vec_id"].to_numpy(np.int64), shard["row"].to_numpy(np.int64),
            _matrix(shard, width),
        )
        vectors = _matrix(queries, width)
        ids, rows = (queries[c].to_numpy(np.int64) for c in ("vec_id", "row"))
        parts = []
        for a in range(0, len(queries), TOGETHER):
            own = slice(a, a + TOGETHER)
            query, at, scores = postings.top(vectors[own], rows[own], k)
            parts.append(
                pd.DataFrame(
                    {
                        "query": ids[own][query], "query_row": rows[own][query],
                        "vec_id": postings.ids[at], "score": scores,
                    }
                )
            )
        return pd.concat(parts, ignore_index=True)

    return run


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, terms``: whole-number components of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("int"))
    # NaN is larger than every number
    sound = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < LARGEST // scale))
    return vectors.filter(F.col("vec_id").isNotNull() & sound).select("vec_id", whole.alias("terms"))


def search(
    vectors: DataFrame,
    every: int = 20,
    k: int = TOP,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each row whose id ``every`` divides.

    Components are ``floor(scale * x)``; the score is their inner product. All rows but the query's
    own are candidates; ties go to the smaller ``vec_id``. There are fewer results only if there are
    fewer rows. Components that a shorter vector lacks are 0, so an empty vector scores 0.

    A NULL vector and one with a NULL or non-finite component take no part, as do rows without
    ``vec_id``, which could not be named, and components of 2^25 after scaling or more, whose
    sums might not fit 64 bits. Rows that repeat a ``vec_id`` are candidates and queries each,
    and a query leaves out its own row only. Other columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = usable(vectors, scale).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.store(rows, "vectors")
    asked = F.col("vec_id") % every == 0
    n, n_asked, width = rows.agg(
        F.count("*"), F.count_if(asked), F.greatest(F.max(F.size("terms")), F.lit(1))
    ).first()
    shards, blocks = max(-(-n // shard_rows), 1), max(-(-n_asked // query_rows), 1)

    def dealt(parts: int):
        return F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")

    def all_of(parts: int):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    candidates = rows.withColumn("shard", dealt(shards)).withColumn("block", all_of(blocks))
    queries = rows.filter(asked).withColumn("block", dealt(blocks)).withColumn(
        "shard", all_of(shards)
    )
    found = (
        queries.groupBy("shard", "block").cogroup(candidates.groupBy("shard", "block"))
        .applyInPandas(_searched(width, k), FOUND)
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
    )
