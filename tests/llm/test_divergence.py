import random
import re
from collections import Counter, defaultdict

import pytest

from shoplens.llm import divergence

DDL = "doc_id long, text string, lang string, source string"


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def expected(rows, least, ranks):
    groups, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        own = terms(text)
        groups[lang or "", source or ""].update(own)
        in_docs[lang or ""].update(set(own))
    out = []
    for lang, docs in in_docs.items():
        kept = {t for t, n in docs.items() if n >= least}
        own = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(n):
            size = sum(n.values()) + len(kept)
            return {t: 1 + 10**9 * (k + 1) // size for t, k in n.items()}

        p = {s: shares(n) for s, n in own.items()}
        q = shares(whole)

        def ranked(source, part, values, most=None):
            order = sorted(values, key=lambda v: (-v[1], v[0].encode()))[:most]
            out.extend((lang, source, part, i, v, k + 1) for k, (i, v) in enumerate(order))

        for s in own:
            pairs = [
                (o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in own if o != s
            ]
            ranked(s, "pair", pairs)
            lifted = [
                (t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if own[s][t] and p[s][t] > q[t]
            ]
            ranked(s, "term", lifted, ranks)
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"t{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    vocabulary += ["Été", "ÉTÉ", "日本", "x1y", "don't", "ﬀ"]
    rows = []
    for k in range(n):
        # a third of all rows has one source
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", "c", None, ""])
        lang = rng.choice(["en", "en", "de", None])
        words = rng.choices(vocabulary, range(len(vocabulary), 0, -1), k=rng.randrange(40))
        rows.append((k, rng.choice([" ", "\x85", ". 7 "]).join(words), lang, source))
    return rows


@pytest.mark.parametrize(("least", "ranks"), [(3, 200), (1, 5), (20, 7)])
def test_equals_brute_force(spark, least, ranks):
    rows = corpus(least, 240) + [
        (900, None, "en", "silent"), (901, "", "xx", "p"), (902, "12", "xx", "q"),
        (903, "only here", "yy", "p"), (904, "only here", "yy", "q"), (905, "A" * 5000, "en", "a"),
    ]
    rows += [(950, "same row twice", "en", "a")] * 3
    df = spark.createDataFrame(rows, DDL).repartition(4)
    found = divergence.audit(df, least, ranks)
    assert sorted(map(tuple, found.collect())) == expected(rows, least, ranks)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DDL)
    assert divergence.audit(empty).collect() == []
    rows = corpus(5, 60)
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 as term", "2 as n", "3 as p", "4 as rank")
    assert sorted(map(tuple, divergence.audit(df).collect())) == expected(rows, 3, 200)


def test_shares_beyond_double_precision(spark):
    n, total, kept = 3_000_000_000_001, 8_999_999_999_999_000, 900
    df = spark.createDataFrame([(n, total, kept)], "n long, t long, v long")
    got = df.select(divergence.share(*(divergence.F.col(c) for c in "ntv"))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + kept)


def test_sums_are_handed_on_in_portions(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    batch = pa.RecordBatch.from_pylist(
        [{"lang": "l", "source": "s", "text": f"a b c{chr(97 + k)} a"} for k in range(9)]
    )
    parts = [p.to_pylist() for p in divergence._counted(iter([batch]))]
    assert len(parts) > 2
    sums = Counter()
    for part in parts:
        for r in part:
            sums[r["term"]] += r["n"]
            sums["documents", r["term"]] += r["documents"]
    assert sums["a"] == 18 and sums["documents", "a"] == 9 and sums["cd"] == 1
