"""Near-duplicate documents by circulant MinHash, confirmed on whole shingle sets.

One permutation scatters the shingles, a second one, read at K successive circular shifts, gives
all K coordinates of the signature (Li and Li, 2022). Documents that agree on a band of it meet in
a bucket. Links are confirmed on the full sets. A bucket's documents are not paired with each other:
they are compared with a centre, twice, and components are formed. Where a bucket still holds
several components, all its pairs across components are compared: one by one in small buckets, as
blocks of sets in large ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

from shoplens.llm.components import components
from shoplens.llm.memory import release
from shoplens.llm.storage import Scratch
from shoplens.llm.words import STEP, mixed, shingles

BANDS = 32
CENTRES = 2
ROWS = 6
UNIVERSE_BITS = 18
SLICE = 2048
PORTION_CHARS = 4 << 20
SMALL_BUCKET = 32
QUERY_ELEMENTS = 1 << 17
ROW_ELEMENTS = 1 << 18
COMPARED_ROWS = 128
SEED = 20240


@cache
def _shifts(coordinates: int) -> np.ndarray:
    """Row ``i`` holds the second permutation at ``i`` under all circular shifts."""
    size = 1 << UNIVERSE_BITS
    order = np.random.default_rng(SEED).permutation(size).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(
        np.concatenate((order, order[: coordinates - 1])), coordinates
    )


def signature(own: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash signature of a non-empty set of 64-bit hashes."""
    shifts = _shifts(coordinates)
    places = mixed(own ^ STEP) >> np.uint64(64 - UNIVERSE_BITS)
    least = shifts[places[:SLICE]].min(axis=0)
    for k in range(SLICE, len(places), SLICE):
        np.minimum(least, shifts[places[k : k + SLICE]].min(axis=0), out=least)
    return least


def bands(least: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """One hash per band; bands of different number never share one but by chance."""
    parts = least.reshape(n_bands, rows).astype(np.uint64)
    total = np.arange(n_bands, dtype=np.uint64)
    for k in range(rows):
        total = mixed(total * STEP + parts[:, k])
    return total.view(np.int64)


def _portions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches in parts of bounded text, so that what is made of them stays small too."""
    for batch in batches:
        sizes = np.cumsum([len(t) if t else 0 for t in batch["text"]]) // PORTION_CHARS
        for _, portion in batch.groupby(sizes):
            yield portion
        release()


def _sketches(n_words: int, n_bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _portions(batches):
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                own = shingles(text, n_words)
                found = bands(signature(own, n_bands * rows), n_bands, rows) if len(own) else None
                out.append((doc_id, len(own), xxh3_128_digest(own.tobytes()), found))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "content", "bands"])

    return run


def _sets(n_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _portions(batches):
            own = [shingles(t, n_words).view(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "own": own})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the similarity ``least[0] / least[1]``."""
    first = sets.select(F.col("doc_id").alias("a"), F.col("own").alias("own_a"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("own").alias("own_b"))
    joined = pairs.join(first, "a").join(second, "b").select(
        "a", "b",
        F.size(F.array_intersect("own_a", "own_b")).cast("long").alias("shared"),
        (F.size("own_a") + F.size("own_b")).cast("long").alias("both"),
    )
    enough = F.col("shared") * least[1] >= (F.col("both") - F.col("shared")) * least[0]
    return joined.filter(enough).select("a", "b")


def _pairs(members: DataFrame, others: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs of a bucket's ``members`` and the one or more ``others`` of different components."""
    small = F.least("n_shingles", "c.n_shingles").cast("long")
    large = F.greatest("n_shingles", "c.n_shingles").cast("long")
    return (
        members.join(others, "bucket")
        .filter("component <> c.component")
        .filter(small * least[1] >= large * least[0])
        .select(
            F.greatest("doc_id", "c.doc_id").alias("a"), F.least("doc_id", "c.doc_id").alias("b")
        )
        .distinct()
    )


def _with_centres(members: DataFrame, turn: int, least: tuple[int, int]) -> DataFrame:
    """Every member with one of its bucket: of most copies at first, by chance later."""
    first = -F.col("copies") if turn == 0 else F.lit(0)
    at = F.struct(first, F.xxhash64("doc_id", F.lit(turn)), "doc_id", "component", "n_shingles")
    return _pairs(members, members.groupBy("bucket").agg(F.min(at).alias("c")), least)


def _outside(members: DataFrame, group: str) -> DataFrame:
    """The members that are not in the largest component of their group."""
    sizes = members.groupBy(group, "component").count()
    largest = sizes.groupBy(group).agg(
        F.max_by("component", F.struct("count", "component")).alias("largest")
    )
    return members.join(largest, group).filter("component <> largest").drop("largest")


def _compared(least: tuple[int, int]):
    """Links between two blocks of sets: one for each row of the first and each component."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"a": [], "b": []})
        columns = np.intersect1d(np.concatenate(queries["own"]), np.concatenate(rows["own"]))

        def matrix(own) -> np.ndarray:
            out = np.zeros((len(own), len(columns)), np.float32)
            for k, items in enumerate(own):
                at = np.searchsorted(columns, items)
                at = np.minimum(at, max(len(columns) - 1, 0))
                out[k, at[columns[at] == items] if len(columns) else []] = 1
            return out

        first = matrix(queries["own"])
        n, component = queries["n_shingles"].to_numpy(), queries["component"].to_numpy()
        release()
        out = []
        for k in range(0, len(rows), COMPARED_ROWS):
            some = rows.iloc[k : k + COMPARED_ROWS]
            shared = np.rint(first @ matrix(some["own"]).T).astype(np.int64)
            union = n[:, None] + some["n_shingles"].to_numpy()[None, :] - shared
            linked = shared * least[1] >= union * least[0]
            linked &= component[:, None] != some["component"].to_numpy()[None, :]
            at = np.nonzero(linked)
            found = pd.DataFrame(
                {"a": queries["doc_id"].to_numpy()[at[0]], "b": some["doc_id"].to_numpy()[at[1]],
                 "component": some["component"].to_numpy()[at[1]]}
            )
            out.append(found.drop_duplicates(["a", "component"])[["a", "b"]])
        return pd.concat(out)

    return run


def _links_of_rest(
    members: DataFrame, sets: DataFrame, scratch: Scratch, least: tuple[int, int]
) -> DataFrame:
    """All links between members of one bucket that are in different components.

    In small buckets the members outside the largest component are paired with the others. Large
    buckets that share documents are one group each, whose sets are compared block by block.
    """
    sizes = members.groupBy("bucket").count()
    small = members.join(sizes.filter(F.col("count") <= SMALL_BUCKET), "bucket")
    other = F.struct("doc_id", "component", "n_shingles").alias("c")
    pairs = _pairs(small, _outside(small, "bucket").select("bucket", other), least)
    links = _verified(pairs, sets, least)

    large = members.join(sizes.filter(F.col("count") > SMALL_BUCKET), "bucket")
    if large.isEmpty():
        return links
    meeting = large.groupBy("bucket").agg(F.min("doc_id").alias("b"))
    meeting = large.join(meeting, "bucket").select(F.col("doc_id").alias("a"), "b")
    group = components(meeting, scratch, "meeting").toDF("doc_id", "group")
    columns = ["doc_id", "n_shingles", "component"]
    grouped = scratch.store(large.select(*columns).distinct().join(group, "doc_id"), "grouped")
    queries = _outside(grouped, "group")

    def shape(rows: DataFrame, elements: int, name: str) -> DataFrame:
        blocks = F.ceil(F.sum("n_shingles") / elements).cast("int")
        return rows.groupBy("group").agg(blocks.alias(name))

    shapes = shape(queries, QUERY_ELEMENTS, "n_q").join(shape(grouped, ROW_ELEMENTS, "n_r"), "group")

    def dealt(rows: DataFrame, own: str, all_own: str, other: str, all_other: str) -> DataFrame:
        return (
            rows.join(shapes, "group")
            .withColumn(own, F.pmod(F.xxhash64("doc_id"), F.col(all_own)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(all_other) - 1)))
            .join(sets, "doc_id")
            .select(*[F.col(c).alias(c) for c in ("group", "q", "r", *columns, "own")])
        )

    key = ["group", "q", "r"]
    compared = (
        dealt(queries, "q", "n_q", "r", "n_r").groupBy(*key)
        .cogroup(dealt(grouped, "r", "n_r", "q", "n_q").groupBy(*key))
        .applyInPandas(_compared(least), "a long, b long")
    )
    return links.unionAll(compared)


def near_duplicates(
    docs: DataFrame,
    n_words: int = 5,
    least: tuple[int, int] = (4, 5),
    n_bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text)``.

    Documents are linked if the Jaccard similarity of their sets of ``n_words``-word shingles is at
    least ``least[0] / least[1]``. ``component_id`` is the smallest ``doc_id`` reachable by links,
    ``kept`` marks it. A text of fewer words is one shingle; NULL and empty texts have none and are
    linked with nothing. Equal sets are one class, of which only the smallest id is compared.
    Rows that repeat a ``doc_id`` are separate documents; where their texts differ, one of them is
    compared. A document with a NULL id has the component of an equal one or NULL, and is kept then.
    A similarity of s is missed with probability (1 - s^rows)^n_bands: 6e-5 at 0.8, 3e-7 at 0.85.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select("doc_id", "text")
    sketches = scratch.store(
        texts.mapInPandas(
            _sketches(n_words, n_bands, rows),
            "doc_id long, n_shingles long, content binary, bands array<long>",
        ),
        "sketches",
    )
    filled = sketches.filter("n_shingles > 0")
    classes = filled.groupBy("content").agg(
        F.min("doc_id").alias("doc_id"),
        F.count("*").alias("copies"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
    )
    hashed = classes.select("doc_id", "copies", "n_shingles", F.explode("bands").alias("bucket"))
    shared = hashed.groupBy("bucket").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).filter("low < high").select("bucket")
    buckets = scratch.store(hashed.join(shared, "bucket").distinct(), "buckets")
    needed = buckets.select("doc_id").distinct()
    sets = scratch.store(
        texts.join(needed, "doc_id", "left_semi")
        .dropDuplicates(["doc_id"])
        .mapInPandas(_sets(n_words), "doc_id long, own array<long>"),
        "sets",
    )

    links = spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    found = links.select(F.col("a").alias("doc_id"), F.col("b").alias("component"))
    for turn in range(CENTRES + 1):
        members = buckets.join(found, "doc_id", "left").withColumn(
            "component", F.coalesce("component", "doc_id")
        )
        mixed_buckets = members.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).filter("low < high").select("bucket")
        members = scratch.store(members.join(mixed_buckets, "bucket"), "members")
        if members.isEmpty():
            break
        if turn < CENTRES:
            new = _verified(_with_centres(members, turn, least), sets, least)
        else:
            new = _links_of_rest(members, sets, scratch, least)
        links = scratch.store(links.unionAll(new), "links")
        found = components(links, scratch, "edges").toDF("doc_id", "component")
        found = scratch.store(found, "found")
    scratch.drop("sets", "buckets", "members", "links", "edges", "meeting", "grouped")

    joined = sketches.join(
        classes.select("content", F.col("doc_id").alias("first")), "content", "left"
    ).withColumn("first", F.when(F.col("n_shingles") > 0, F.col("first")).otherwise(F.col("doc_id")))
    result = joined.join(found.withColumnRenamed("doc_id", "first"), "first", "left")
    component = F.coalesce("component", "first")
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept")
    )
