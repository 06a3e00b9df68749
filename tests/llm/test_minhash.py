import random
import re

import pytest

from shoplens.llm import minhash
from shoplens.llm.components import components
from shoplens.llm.storage import Scratch


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < n:
        return {tuple(words)}
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def expected(rows, n, least):
    sets = {i: shingle_set(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            shared = len(sets[a] & sets[b])
            if a < b and shared * least[1] >= len(sets[a] | sets[b]) * least[0] and shared:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n_groups, size, length, edits):
    rng = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for _ in range(size):
            own = base[:]
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) + 1, " ".join(own)))
    return rows + [(900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one TWO"), (905, "one")]


@pytest.mark.parametrize(("centres", "small"), [(2, 32), (0, 32), (0, 1)])
def test_components_equal_those_of_all_pairs(spark, monkeypatch, centres, small):
    monkeypatch.setattr(minhash, "CENTRES", centres)
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(minhash, "QUERY_ELEMENTS", 512)
    monkeypatch.setattr(minhash, "ROW_ELEMENTS", 1024)
    rows = near_copies(4, 3, 12, 60, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as bucket", "'c' as component", "2 as n_shingles"
    )
    found = minhash.near_duplicates(docs, n_words=3, least=(85, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected(rows, 3, (85, 100))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_defaults_link_at_four_fifths_of_five_word_shingles(spark):
    words = [f"w{k}" for k in range(24)]  # 20 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[:-2])), (3, " ".join(words[:-4])),
            (4, " ".join(words[:-5])), (5, "x " * 50)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == expected(rows, 5, (4, 5))


def test_copies_repeated_rows_and_missing_ids(spark):
    rows = [(5, "a b c d"), (3, "A b  c d"), (3, "A b  c d"), (None, "a b c d"), (None, "z z z")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in found.collect()), key=str)
    assert got == sorted(
        [(5, 3, False), (3, 3, True), (3, 3, True), (0, 3, False), (0, None, True)], key=str
    )


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 200), (100, 101)]
    found = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark))
    got = {r.node: r.component for r in found.collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 140)}
