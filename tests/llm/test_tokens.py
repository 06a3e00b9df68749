import zlib
from collections import Counter

import numpy as np
import pytest

from shoplens.llm import packing, token_files
from shoplens.llm.tokens import encoder
from shoplens.session import scratch_path

DOCS = "doc_id long, text string"
ODD = [
    "İstanbul É Ⅷ ΑΣ ΣΑΣ don't I'LL a<|endoftext|>b <|ENDOFTEXT|>", "x\x1cw\x85q 12 3,4 漢字　か K ﬁ",
    "​ ́x  ﻿ é École", "end. of, lines., a.b ..., straße. École, ñandú.",
    "one " * 5000, "",
]


def ids_of(text, end):
    own = encoder().ids.tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*own, end], "<u4")


def test_words_encode_like_whole_texts():
    got = encoder().encode([*ODD, None])
    assert got == [ids_of(t, 0)[:-1].tobytes() for t in [*ODD, None]]


def table(spark, partitions=3):
    rows = [(k * 3 % 17, t) for k, t in enumerate(ODD)] + [(40, None), (30, "a"), (30, "A b"), (None, "q")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as shard", "2 as start")
    return docs.repartition(partitions), rows


@pytest.mark.parametrize("chunk", [4, 1 << 20])
def test_files_give_back_every_id(spark, chunk):
    docs, rows = table(spark)
    path = scratch_path(spark, "tokens")
    token_files.write(docs, path, chunk=chunk)
    got = [tuple(r) for r in token_files.read_documents(spark, path).orderBy("start").collect()]
    at, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(text, 2)
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    one = int(ids_of("one", 2)[0])
    places = token_files.occurrences(spark, path, one).collect()
    assert len(places) == sum((ids_of(t, 2) == one).sum() for _, t in rows)
    assert token_files.occurrences(spark, path, 10**6).count() == 0


def test_an_empty_table_gives_no_ids(spark):
    path = scratch_path(spark, "tokens")
    token_files.write(spark.createDataFrame([], DOCS), path)
    assert token_files.read_documents(spark, path).count() == 0


def check_packed(rows, docs, capacity):
    want = Counter()
    for doc_id, text in rows:
        ids = ids_of(text, 1)
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want[doc_id, k // capacity, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in docs) == want
    ends = {}
    for r in sorted(docs, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= capacity
    return len(ends), -(-sum(ends.values()) // capacity)


def test_pieces_fill_sequences_without_gaps(spark):
    docs, rows = table(spark)
    placed = packing.pack(docs, capacity=64)
    check_packed(rows, placed.collect(), 64)
    texts = {r.sequence_id: r.ids for r in packing.sequences(docs, placed, capacity=64).collect()}
    assert sum(map(len, texts.values())) == sum(len(ids_of(t, 1)) for _, t in rows)
    assert packing.pack(docs.limit(0)).count() == 0


def test_many_groups_waste_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs = spark.createDataFrame(rows, DOCS)
    used, least = check_packed(rows, packing.pack(docs, group_pieces=40).collect(), 4096)
    assert used <= least + 3


def test_sum_of_squares_takes_the_smallest_change():
    # gaps 4 and 4 and 6 open: 4 falls into one of the two of gap 4, making it full
    assert packing.sum_of_squares(np.array([6, 6, 4, 4]), 10).tolist() == [0, 1, 1, 0]
    assert packing.sum_of_squares(np.array([10, 10]), 10).tolist() == [0, 1]
    assert len(packing.sum_of_squares(np.array([], int), 10)) == 0
