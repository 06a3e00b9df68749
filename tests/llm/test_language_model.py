import math
from collections import Counter

import numpy as np
import pytest

from shoplens.llm.elias_fano import EliasFano, Trie, pack, unpack
from shoplens.llm.language_model import score
from shoplens.llm.words import words

DOCS = "doc_id long, text string, train boolean"


def expected(rows, mass):
    texts = {i: [*words(t), b"\n"] for i, t, _ in rows}
    one, two, n_docs = Counter(), Counter(), 0
    for i, _, train in rows:
        if train:
            one.update(texts[i])
            two.update(zip([b"\t", *texts[i]], texts[i]))
            n_docs += 1
    n, v = sum(one.values()), len(one)
    follows = {**one, b"\t": n_docs}
    out = {}
    for i, own in texts.items():
        p = [(one[w] + 1) / (n + v + 1) for w in own]
        before = [b"\t", *own[:-1]]
        model = sum(
            math.log10((two[b, w] + mass * q) / (follows.get(b, 0) + mass))
            for b, w, q in zip(before, own, p)
        )
        known = sum(one[w] > 0 for w in own)
        out[i] = (len(own), known, n, sum(map(math.log10, p)), model)
    return out


@pytest.mark.parametrize("shards", [1, 7])
def test_scores_equal_counts_by_hand(spark, shards):
    rows = [
        (1, "the cat sat on the mat", True), (2, "The cat\tran  the the the", True),
        (3, "a dog sat on the cat", False), (4, None, True), (5, "", None), (6, "zz " * 300, False),
        (7, "naïve Äpfel ünd the", True), (None, "the cat", True),
    ]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as shard", "2 as source").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in score(docs, shards, mass=3.0).collect()}
    want = expected(rows, 3.0)
    assert got.keys() == want.keys()
    for i, (n, known, total, base, model) in want.items():
        assert got[i][:3] == (n, known, total)
        assert got[i][3] == pytest.approx(base, abs=1e-9)
        assert got[i][4] == pytest.approx(model, rel=1e-3)


def test_without_training_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b", False)], DOCS)
    row = score(docs, 2).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0)
    assert score(docs.limit(0), 2).count() == 0


def test_held_out_texts_are_more_likely_than_by_their_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr(
        "doc_id", "text", "crc32(cast(doc_id as string)) % 7 <> 2 as train"
    )
    found = score(docs, 8).join(docs.filter("not train"), "doc_id").toPandas()
    assert found["score"].sum() > found["base_score"].sum()


@pytest.mark.parametrize(
    ("universe", "n"), [(1 << 40, 1000), (5000, 1000), (1 << 63, 5000), (10, 4), (64, 0), (1, 1)]
)
def test_elias_fano(universe, n):
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, universe, n).astype(np.uint64))
    own = EliasFano(unpack(pack(EliasFano.arrays(values, universe))))
    assert (own.access(np.arange(n)) == values).all()
    asked = np.concatenate((rng.integers(0, universe, 300).astype(np.uint64), values[:100]))
    at, equal = own.successor(asked)
    assert (at == np.searchsorted(values, asked)).all()
    assert (equal == np.isin(asked, values)).all()


def test_trie_finds_what_it_holds():
    rng = np.random.default_rng(4)
    names = np.unique(rng.integers(0, 1 << 64, 500, dtype=np.uint64))
    keys = np.unique((rng.integers(0, 400, 5000).astype(np.uint64) << np.uint64(32))
                     | rng.integers(0, 1 << 32, 5000).astype(np.uint64))
    owner, contexts = (keys >> np.uint64(32)).astype(int), keys & np.uint64(0xFFFFFFFF)
    own, below = -rng.random(len(names)), rng.random(len(keys))
    trie = Trie(memoryview(Trie.build(names, own, owner, contexts.astype(np.uint32), below)))
    assert (trie.find(names) == np.arange(len(names))).all()
    assert (trie.find(names - np.uint64(1)) == -1).all()
    assert np.abs(trie.word_values() - own).max() < 1e-4
    assert np.abs(trie.after(owner, contexts.astype(np.uint32)) - below).max() < 1e-4
    strangers = trie.after(owner, (contexts + np.uint64(1)).astype(np.uint32))
    assert np.isnan(strangers).mean() > 0.99
