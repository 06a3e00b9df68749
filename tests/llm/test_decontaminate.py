import random
import re

import numpy as np
import pytest

from shoplens.llm import decontaminate
from shoplens.llm.wavelet import WaveletMatrix, planes_of, values_of

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(docs, items, window):
    phrases = {}
    for item_id, text in items:
        own = plain_words(text)
        for k in range(max(len(own) - window + 1, 1) if own else 0):
            phrases.setdefault(tuple(own[k : k + window]), set()).add(item_id)
    out = {}
    for doc_id, text in docs:
        own, hit, found = plain_words(text), set(), set()
        for k in range(len(own)):
            for n in {len(p) for p in phrases}:
                owners = phrases.get(tuple(own[k : k + n]))
                if owners and k + n <= len(own):
                    hit |= set(range(k, k + n))
                    found |= owners
        out[doc_id] = (len(own), hit, sorted(found))
    return out


def random_case(seed):
    rng = random.Random(seed)
    text = lambda n: rng.choice(" ,.-\n").join(rng.choice(["a", "B", "c1", "é", "Dd"]) for _ in range(n))
    items = [(k, text(rng.randrange(1, 9))) for k in range(12)] + [(50, None), (51, "..."), (3, text(5))]
    docs = [(k, text(rng.randrange(0, 60))) for k in range(40)]
    docs += [(100, None), (101, ""), (102, "  ..."), (103, "zz " * 3000 + items[0][1])]
    return docs, items


@pytest.mark.parametrize("most", [10**6, 4])
@pytest.mark.parametrize("seed", [1, 2])
def test_spans_and_items_equal_brute_force(spark, seed, most):
    docs, items = random_case(seed)
    table = spark.createDataFrame(docs, DOCS).selectExpr("*", "'n' as n_words", "1 as spans")
    found = decontaminate.find_leaks(
        table, spark.createDataFrame(items, ITEMS), window=5, keep=("doc_id", "spans"), most=most
    )
    got = {}
    for r in found.collect():
        hit = {k for s in r.spans for k in range(s.start, s.start + s.length)}
        ends = [(s.start, s.start + s.length) for s in r.spans]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
        got[r.doc_id] = (r.n_words, hit, list(r.item_ids))
    assert got == expected(docs, items, 5)


@pytest.mark.parametrize("most", [10**6, 2])
def test_repeated_rows_are_reported_each(spark, most):
    docs = [(1, "a b c d"), (1, "a b c d"), (None, "x y"), (None, "x y"), (2, None), (2, None)]
    items = spark.createDataFrame([(1, "a b"), (2, "c d e"), (3, "b c d z x y")], ITEMS)
    found = decontaminate.find_leaks(spark.createDataFrame(docs, DOCS), items, window=2, most=most)
    got = sorted((r.doc_id or 0, r.n_words, [tuple(s) for s in r.spans], r.item_ids) for r in found.collect())
    assert got == [(0, 2, [(0, 2)], [3])] * 2 + [(1, 4, [(0, 4)], [1, 2, 3])] * 2 + [(2, 0, [], [])] * 2


def test_a_block_is_bounded_even_within_an_item(spark):
    items = spark.createDataFrame([(1, " ".join(map(str, range(40)))), (2, "a b")], ITEMS)
    blocks = list(decontaminate._blocks(items, 3, 10))
    assert [more for _, more in blocks] == [True] * 3 + [False]
    assert sum(len(own) for b, _ in blocks for own, _ in b.by_length.values()) == 39


def test_no_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert [(r.n_words, r.spans) for r in decontaminate.find_leaks(docs, none).collect()] == [(2, []), (2, [])]
    assert decontaminate.find_leaks(docs.limit(0), none).count() == 0


def test_wavelet_matrix():
    values = np.random.default_rng(1).integers(0, 50, 1000)
    matrix = WaveletMatrix.of(values, 6)
    assert (matrix.access(np.arange(1000)) == values).all()
    assert (values_of(list(planes_of(values.astype(np.uint16), 6)), np.uint16) == values).all()
    at = np.array([0, 10, 500, 999, 1000])
    for v in range(50):
        places = np.flatnonzero(values == v)
        assert (matrix.select(v, np.arange(len(places))) == places).all()
        assert matrix.rank(np.full(5, v), at).tolist() == [(values[:k] == v).sum() for k in at]


def test_fm_index_finds_and_locates():
    rng = np.random.default_rng(2)
    runs = np.concatenate([np.append(rng.integers(1, 4, n), 0) for n in (40, 3, 1, 25, 40)])
    index = decontaminate.FmIndex(runs, 4)
    for length in (1, 2, 4):
        phrases = rng.integers(1, 4, (30, length))
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high, strict=True):
            places = [k for k in range(len(runs) - length + 1) if (runs[k : k + length] == p).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == places
