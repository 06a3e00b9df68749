import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from shoplens.llm import importance

DDL = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected(rows, target, buckets, share, least):
    found = [(i, *runs(t)) for i, t in rows]
    place = lambda f: crc32(f.encode()) % buckets
    s = Counter(place(f) for _, _, own in found for f in own)
    t = Counter(place(f) for text in target for f in runs(text)[1])
    all_s, all_t = s.total(), t.total()

    def gain(b):
        return math.floor(
            1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))
        )

    out = []
    for i, words, own in found:
        weight = sum(gain(place(f)) for f in own) // len(own) if own else 0
        name = "" if i is None else i
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), len(words), weight, score, None])
    ranked = sorted(
        (r for r in out if r[2] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0])
    )
    for k, r in enumerate(ranked[: len(ranked) * share[0] // share[1]]):
        r[5] = k + 1
    return out


def texts(seed, n, words=80):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "naïve", "O'Neil", "x-1", "ﬀ", "日本"]
    return [
        rng.choice(["", " ", "...", "\n"]).join(
            rng.choice([" ", ", ", "\x85", " "]) + rng.choice(vocabulary)
            for _ in range(rng.randrange(words))
        )
        for _ in range(n)
    ]


def sort_key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("target", [texts(2, 9), [None, ""], []])
def test_equals_brute_force(spark, target):
    rows = [*enumerate(texts(1, 120)), (500, None), (501, ""), (502, "one"), (None, "No id " * 30)]
    rows += [(600, "again and again " * 9)] * 4
    docs = spark.createDataFrame(rows, DDL).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = [list(r) for r in importance.draw(docs, wanted, buckets=997).collect()]
    want = expected(rows, target, 997, (25, 100), 20)
    # rows that tie in all are drawn in any order
    assert sorted(found, key=sort_key) == sorted(want, key=sort_key)


def test_empty_table_and_clashing_columns(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    empty = spark.createDataFrame([], DDL)
    assert importance.draw(empty, target).collect() == []
    rows = [(k, "some words here " * 8, 5, "s") for k in range(8)]
    docs = spark.createDataFrame(rows, DDL + ", rank int, source string")
    found = importance.draw(docs, target, keep=("doc_id", "text", "rank", "source"))
    assert found.columns == [
        "doc_id", "text", "source", "n_features", "n_words", "weight", "score", "rank"
    ]
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == [1, 2]


@pytest.mark.parametrize("most", [0, 40, 10**6])
def test_dictionary_of_any_size_gives_the_same_features(most):
    features = importance.Features(1 << 30, most)
    for seed in range(4):
        batch = [None, *texts(seed, 40), ""]
        got = {k: Counter() for k in range(len(batch))}
        n_words = Counter()
        for row, bucket, words in features.of(batch):
            n_words.update(words.tolist())
            for r, b in zip(row.tolist(), bucket.tolist()):
                got[r][b] += 1
        for k, text in enumerate(batch):
            words, own = runs(text)
            assert n_words[k] == len(words)
            assert got[k] == Counter(crc32(f.encode()) % (1 << 30) for f in own)
    assert features.dictionary.built == (most > 0)
    assert features.dictionary.size <= most


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(importance, "SCANNED_BYTES", 50)
    text = " ".join(f"word{k % 7}" for k in range(400)) + " " + "z" * 300 + "   " + "tail " * 30
    features, got, n = importance.Features(1 << 30), Counter(), 0
    for _, bucket, words in features.of([text, "short one", text[:49]]):
        got.update(bucket.tolist())
        n += len(words)
    want = [runs(t) for t in (text, "short one", text[:49])]
    assert n == sum(len(w) for w, _ in want)
    assert got == Counter(crc32(f.encode()) % (1 << 30) for _, own in want for f in own)


def test_crc_of_joined_strings():
    rng, join = random.Random(3), importance.CrcJoin()
    pairs = [(rng.randbytes(rng.randrange(40)), rng.randbytes(rng.randrange(600))) for _ in range(200)]
    first, second = (np.array([crc32(p[k]) for p in pairs], np.uint32) for k in range(2))
    got = join(first, second, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [crc32(a + b) for a, b in pairs]
