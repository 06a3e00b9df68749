"""Best-fit packing of token sequences by the sum of squares.

A document goes into the open sequence that leaves the sum of the squared numbers of open sequences
per residual gap smallest; a new one is opened where none has room. Long pieces come first. Pieces
are dealt evenly to groups of bounded size, which are packed side by side; the emptiest sequences
of each group are opened again and packed once more by fewer groups, until there is one.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.storage import Scratch
from shoplens.llm.tokens import CACHED_WORDS, encoder

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 1 << 16
REOPENED = 32
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, bin long, offset long, reopened boolean"


def _pieces(path: str | None, capacity: int, end_id: int, with_ids: bool, cached: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            texts = encoder(path, cached).encode(list(batch["text"]))
            for doc_id, own in zip(batch["doc_id"], texts, strict=True):
                ids = own + end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    row = (doc_id, k // (4 * capacity), k // 4, len(part) // 4, crc32(part))
                    out.append((*row, np.frombuffer(part, "<u4")) if with_ids else row)
            columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
            found = pd.DataFrame(out, columns=[*columns, "ids"] if with_ids else columns)
            yield found.astype({"doc_id": "Int64"})

    return run


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
    tokenizer: str | None = None, with_ids: bool = False, cached: int = CACHED_WORDS,
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids, the end id included."""
    schema = PIECES + (", ids array<long>" if with_ids else "")
    run = _pieces(tokenizer, capacity, end_id, with_ids, cached)
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each length, in the order given.

    A sequence of gap g that takes s changes the sum by 2 (n[g - s] - n[g] + 1), or by 1 - 2 n[g]
    where it becomes full. Of equal changes the smaller gap is taken.
    """
    open_, n = [[] for _ in range(capacity + 1)], np.zeros(capacity + 1, np.int64)
    out, n_bins = np.empty(len(lengths), np.int64), 0
    for k, s in enumerate(lengths.tolist()):
        gaps = s + np.flatnonzero(n[s:])
        if len(gaps):
            change = 2 * (n[gaps - s] - n[gaps] + 1)
            if gaps[0] == s:
                change[0] = 1 - 2 * n[s]
            gap = int(gaps[change.argmin()])
            n[gap] -= 1
            bin_ = open_[gap].pop()
        else:
            gap, bin_ = capacity, n_bins
            n_bins += 1
        out[k] = bin_
        if gap > s:
            open_[gap - s].append(bin_)
            n[gap - s] += 1
    return out


def _packed(capacity: int, reopened: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = group.sort_values(
            ["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True
        )
        own["bin"] = sum_of_squares(own["length"].to_numpy(), capacity)
        own["offset"] = own.groupby("bin")["length"].cumsum() - own["length"]
        filled = own.groupby("bin")["length"].sum()
        emptiest = filled[filled < capacity].nsmallest(reopened).index
        own["reopened"] = own["bin"].isin(emptiest)
        own["bin"] += key[0] << 32
        return own[[c.split()[0] for c in PLACED.split(", ")]]

    return run


def pack(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
    group_pieces: int = GROUP_PIECES, reopened: int = REOPENED, cached: int = CACHED_WORDS,
) -> DataFrame:
    """Where each piece of ``docs(doc_id, text)`` is placed.

    Columns: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. ``end_id`` follows
    each document; NULL and empty texts consist of it. Only documents of more than ``capacity`` ids
    are cut, and only their last piece may be shorter. Sequences are gapless from offset 0. Rows
    that repeat a ``doc_id`` are documents of their own; ties in length are ordered by ``doc_id``
    and piece. Other columns are ignored, an empty table gives no rows. ``cached`` is how many words
    a worker keeps the ids of, at some 200 bytes each; it changes no result.
    """
    scratch = Scratch(docs.sparkSession)
    rest = scratch.store(pieces(docs, capacity, end_id, tokenizer, cached=cached), "pieces")
    n = rest.count()
    groups, level, done = max(1, -(-n // group_pieces)), 0, None
    while True:
        dealt = rest.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
        last = groups == 1
        run = _packed(capacity, 0 if last else reopened)
        placed = scratch.store(dealt.groupBy("group").applyInPandas(run, PLACED), f"level{level}")
        final = placed.filter("not reopened").withColumn(
            "sequence_id", F.col("bin") + F.lit(level << 56)
        ).drop("bin", "reopened")
        done = final if done is None else done.unionAll(final)
        if last:
            break
        rest = placed.filter("reopened").select("doc_id", "piece", "start", "length", "ids_crc32")
        groups, level = -(-groups // 16), level + 1
    scratch.drop("pieces")
    return done.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def sequences(docs: DataFrame, placed: DataFrame, **options) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, for ``placed`` of ``pack``."""
    own = pieces(docs, with_ids=True, **options).select("doc_id", "piece", "ids_crc32", "ids")
    own = own.dropDuplicates(["doc_id", "piece", "ids_crc32"])
    own = own.toDF("own_doc", "own_piece", "own_crc32", "ids")
    joined = placed.join(
        own,
        F.col("doc_id").eqNullSafe(F.col("own_doc"))
        & (F.col("piece") == F.col("own_piece"))
        & (F.col("ids_crc32") == F.col("own_crc32")),
    )
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
