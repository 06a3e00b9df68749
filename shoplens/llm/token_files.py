"""Token ids as files of wavelet matrices.

A shard holds the ids of a range of documents in ascending ``doc_id`` order, as one or more wavelet
matrices of about ``CHUNK`` ids: bare bit planes. What answers access, rank and select is built from
all planes of a matrix when it is read, and takes about 8 bytes a bit; it is not in the file. No document is cut. Each shard is a compressed Parquet file with a
row per matrix, so that it can lie wherever Spark writes.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shoplens.llm.tokens import encoder
from shoplens.llm.wavelet import WaveletMatrix, planes_of, values_of

END_ID = 2
CHUNK = 1 << 20
# planes hardly shrink and never repeat
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.enable.dictionary": "false",
}
FILE_SCHEMA = (
    "shard int, chunk int, n_tokens long, n_bits int, planes array<binary>, doc_ids array<long>, "
    "lengths array<long>"
)


def matrix_row(ids: np.ndarray) -> dict:
    """A file row's planes of some ids."""
    n_bits = max(1, int(ids.max(initial=0)).bit_length())
    narrow = ids.astype(np.uint16 if n_bits <= 16 else np.uint32)
    planes = [np.packbits(p).tobytes() for p in planes_of(narrow, n_bits)]
    return {"n_tokens": len(ids), "n_bits": n_bits, "planes": planes}


def _planes(row) -> list[np.ndarray]:
    return [
        np.unpackbits(np.frombuffer(p, np.uint8), count=row.n_tokens).view(bool)
        for p in row.planes
    ]


def ids_of(row) -> np.ndarray:
    """All ids of a file row."""
    return values_of(_planes(row), np.uint16 if row.n_bits <= 16 else np.uint32)


def matrix_of(row) -> WaveletMatrix:
    """A file row for access, rank and select."""
    return WaveletMatrix(_planes(row), row.n_tokens)


def _encoded(path: str | None, end_id: int, chunk: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, n = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        doc_ids: list[int] = []
        size = 0

        def row() -> pd.DataFrame:
            matrix = matrix_row(np.frombuffer(b"".join(held), "<u4"))
            lengths = [len(own) // 4 for own in held]
            rest = {"doc_ids": doc_ids, "lengths": lengths}
            return pd.DataFrame([{"shard": shard, "chunk": n, **matrix, **rest}])

        for batch in batches:
            texts = encoder(path).encode(list(batch["text"]))
            for doc_id, own in zip(batch["doc_id"], texts, strict=True):
                held.append(own + end)
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                size += len(held[-1])
                if size >= 4 * chunk:
                    yield row()
                    n, held, doc_ids, size = n + 1, [], [], 0
        if held:
            yield row()

    return run


def write(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
    chunk: int = CHUNK,
) -> None:
    """Writes the ids of ``docs(doc_id, text)`` with ``end_id`` after each document.

    Documents are dealt to shards by ranges of ``doc_id``; equal ids are ordered by text, NULL ids
    come first. NULL and empty texts consist of the end id. Other columns are ignored; an empty
    table gives files without rows.
    """
    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInPandas(_encoded(tokenizer, end_id, chunk), FILE_SCHEMA)
        .write.options(**FILE_OPTIONS)
        .parquet(path)
    )


def _with_starts(files: DataFrame) -> DataFrame:
    """``shard, chunk, first``: the ids before each matrix."""
    sizes = files.select("shard", "chunk", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(
        Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.join(shards, "shard").select(
        "shard", "chunk", (F.col("before") + F.coalesce(inside, F.lit(0))).alias("first")
    )


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            raw = ids_of(row).astype("<u4")
            ends = np.cumsum(row.lengths)
            starts = ends - row.lengths
            found = pd.DataFrame(
                {
                    "doc_id": pd.array(list(row.doc_ids), "Int64"),
                    "inside": starts,
                    "n_tokens": row.lengths,
                    "ids_crc32": [crc32(raw[a:b]) for a, b in zip(starts, ends, strict=True)],
                }
            )
            yield found.assign(shard=row.shard, chunk=row.chunk)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files of ``write``.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is taken over its ids as
    unsigned little-endian 32-bit integers.
    """
    files = spark.read.parquet(path)
    docs = files.mapInPandas(
        _documents,
        "doc_id long, inside long, n_tokens long, ids_crc32 long, shard int, chunk int",
    )
    return docs.join(_with_starts(files), ["shard", "chunk"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def _found(token: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                matrix = matrix_of(row)
                value = np.array([token])
                count = 0
                if token < 1 << row.n_bits:
                    count = int(matrix.rank(value, np.array([row.n_tokens]))[0])
                at = matrix.select(token, np.arange(count)) if count else np.empty(0, np.int64)
                ends = np.cumsum(row.lengths)
                doc = np.searchsorted(ends, at, side="right")
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(list(row.doc_ids), "Int64")[doc],
                        "position": at - (ends - row.lengths)[doc],
                    }
                )

    return run


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``doc_id, position`` wherever a token id stands, found by rank and select."""
    return spark.read.parquet(path).mapInPandas(_found(token), "doc_id long, position long")
