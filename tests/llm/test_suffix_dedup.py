import hashlib
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from shoplens.llm import suffix_dedup

DOCS = "doc_id long, text string"
LAST = 1 << 62


def expected(rows, width):
    first = {}
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            first[w] = min(first.get(w, LAST), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        spans, at = [], 0
        while at < len(b):
            end = at
            while end < len(b) and gone[end]:
                end += 1
            if end > at:
                spans.append((at, end - at))
            at = end + 1
        out.append((i, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def random_case(seed):
    rng = random.Random(seed)
    alphabet = ["a", "b", "é", " "][: rng.randrange(1, 5)]
    passages = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(5, 60))) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = [
            rng.choice(passages) if rng.random() < 0.4
            else "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
            for _ in range(rng.randrange(6))
        ]
        rows.append((k, "".join(parts)))
    rng.shuffle(rows)
    return rows + rows[:5] + [(200, None), (201, ""), (None, passages[0]), (3, "".join(passages))]


@pytest.mark.parametrize("width", [10, 23])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, seed, width):
    monkeypatch.setattr(suffix_dedup, "SEGMENT_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    monkeypatch.setattr(suffix_dedup, "BATCH_WINDOWS", 16)
    rows = random_case(seed)
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as kept", "1 as name").coalesce(2)
    found = suffix_dedup.remove_repeats(docs, width, keep=("doc_id", "name", "kept"), shards=3)
    got = [
        (LAST if r.doc_id is None else r.doc_id, r.n_bytes,
         [(s.start, s.length) for s in r.removed], bytes(r.kept))
        for r in found.collect()
    ]
    assert sorted(got, key=str) == expected(rows, width)


@pytest.mark.parametrize("few", [0, 1])
def test_hot_anchors_give_the_same_bytes(spark, monkeypatch, few):
    monkeypatch.setattr(suffix_dedup, "SEGMENT_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "BATCH_WINDOWS", 16)
    monkeypatch.setattr(suffix_dedup, "FEW_CONTEXTS", few)
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 2)
    rows = random_case(4)
    docs = spark.createDataFrame(rows, DOCS).coalesce(2)
    found = suffix_dedup.remove_repeats(docs, 23, shards=3).collect()
    got = [
        (LAST if r.doc_id is None else r.doc_id, r.n_bytes,
         [(s.start, s.length) for s in r.removed], bytes(r.kept))
        for r in found
    ]
    assert sorted(got, key=str) == expected(rows, 23)


def test_windows_of_a_hot_anchor_go_to_many_shards(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 100)
    rng = random.Random(3)
    header = "Licensed to whom it may concern, version two:"
    texts = [header + "".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(600)]
    rest = pa.table({"doc_id": list(range(600))})
    segment = suffix_dedup.Segment([t.encode() for t in texts], rest)
    keys, shards = segment.keys(16, 50), 16
    many, counts = segment.contexts_by_key(keys)
    key = keys.key[keys.dealt]
    blocks = [
        suffix_dedup._compress([suffix_dedup._narrow(key[a:b]),
                                np.flatnonzero(many[keys.dealt][a:b]).astype(np.uint32),
                                counts[keys.dealt][a:b][many[keys.dealt][a:b]]])
        for _, a, b in suffix_dedup._by_shard(keys.shard[keys.dealt])
    ]
    shard = [s for s, _, _ in suffix_dedup._by_shard(keys.shard[keys.dealt])]
    asked = pd.DataFrame({"name": 1, "shard": shard, "block": blocks})
    bits = pd.concat([suffix_dedup._repeated_keys(asked[k : k + 1]) for k in range(len(asked))])
    rows = pd.DataFrame([segment.to_row()])
    told = suffix_dedup._report_contexts(shards, 50)(rows, bits)
    contexts, windows = zip(*((len(x[0]), len(x[5])) for x in map(suffix_dedup._expand, told["block"])))
    assert sum(windows) > 600 and max(windows) < 2 * sum(windows) / shards
    assert max(contexts) <= 100


def test_long_passages_and_runs_of_one_letter(spark):
    rng = random.Random(9)
    shared = "".join(rng.choice("abcdefghijklmnop ") for _ in range(5000))
    rows = [(5, "x" * 400), (2, "y" + "x" * 200), (9, shared), (7, "start " + shared + " end"),
            (8, "z" * 49), (1, "z" * 49), (3, "w" * 300_000), (4, "w" * 300_000)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS), shards=4).collect()
    got = sorted(
        ((r.doc_id, r.n_bytes, [(s.start, s.length) for s in r.removed], bytes(r.kept)) for r in found),
        key=str,
    )
    assert got == expected(rows, 50)


def test_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_levels_grow_geometrically_and_find_smaller_ids():
    rng = np.random.default_rng(5)
    levels, seen = suffix_dedup.Levels(), {}
    for batch in range(40):
        own = np.array([hashlib.md5(bytes([x])).digest() for x in rng.integers(0, 60, 8)])
        own = np.frombuffer(b"".join(own.tolist()), "S16")
        ids = np.sort(rng.integers(batch, batch + 2, 8))
        for k, i in zip(own.tolist(), ids.tolist()):
            seen[k] = min(seen.get(k, i), i)
        want = [seen[k] < i for k, i in zip(own.tolist(), ids.tolist())]
        assert levels.add(own, ids).tolist() == want
        sizes = [len(level) for level, _ in levels.levels]
        assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == len(sizes)
