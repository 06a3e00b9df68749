"""Which sources of a language write unlike the others, and by which terms.

Texts are cut into terms with one translate table: it lowers letters and blanks separators in a
single pass over the bytes. A counter per document gives the occurrences of its terms and the
documents that have them; tasks add these up per language, source and term before anything is
shuffled, so a source with a third of all documents is as many rows as it has terms. All later
arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.memory import release
from shoplens.llm.storage import Scratch

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
# entries a task holds before it hands them on
HELD_TERMS = 700_000
# what shares are parts of, as a base and its number of digits in that base
SHARE_BASE, SHARE_DIGITS = 1000, 3
# A-Z become a-z, other ASCII is blank, all bytes of further characters stay
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
COUNTED = pa.schema(
    [
        ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
        ("n", pa.int64()), ("documents", pa.int64()),
    ]
)
COUNTED_DDL = "lang string, source string, term string, n long, documents long"


def terms(text: str | None) -> list[bytes]:
    """The runs of letters, A-Z in lower case, where every character beyond ASCII is a letter."""
    return text.encode().translate(LETTERS).split() if text else []


# one number holds the occurrences of a term in its low bits and its documents above them
DOCUMENT = 1 << 48


class _Sums:
    """Occurrences and documents of the terms of each group."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], dict[bytes, int]] = {}
        self.size = 0

    def add(self, group: tuple[str, str], document: Counter) -> None:
        held = self.groups.setdefault(group, {})
        before = len(held)
        known = held.get
        for term, times in document.items():
            held[term] = known(term, 0) + times + DOCUMENT
        self.size += len(held) - before

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A batch for each group, whose terms are let go of."""
        while self.groups:
            (lang, source), held = self.groups.popitem()
            n = len(held)
            both = np.fromiter(held.values(), np.int64, n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n), pa.array([source] * n),
                    pa.array(list(held), pa.binary()).cast(pa.string()),
                    pa.array(both % DOCUMENT), pa.array(both // DOCUMENT),
                ],
                schema=COUNTED,
            )
        self.size = 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = _Sums()
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("lang", "source", "text"))
        for lang, source, text in zip(*columns, strict=True):
            sums.add((lang, source), Counter(terms(text)))
            if sums.size >= HELD_TERMS:
                yield from sums.rows()
                release()
    yield from sums.rows()
    release()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
        F.col("text").cast("string").alias("text"),
    )


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """``lang, term, lang_n, sources``: the terms of ``least`` documents, and who has how many.

    One shuffle serves the sums of each group and those of each language. Tasks have added up what
    they read, so nothing is gained by adding up again before it.
    """
    counted = _texts(docs).mapInArrow(_counted, COUNTED_DDL).repartition("lang", "term")
    groups = counted.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents")
    )
    return (
        groups.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"),
            F.collect_list(F.struct("source", "n")).alias("sources"),
        )
        .filter(F.col("documents") >= least).drop("documents")
    )


def _quotient(a: Column, b: Column) -> Column:
    """The whole part of a quotient of whole numbers, which no double could hold."""
    return F.call_function("div", a, b)


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(10^9 (n + 1) / (total + kept))``, digit by digit, so that no product overflows."""
    size = total + kept
    value, rest = F.lit(0).cast("long"), n + 1
    for _ in range(SHARE_DIGITS):
        scaled = rest * SHARE_BASE
        value, rest = value * SHARE_BASE + _quotient(scaled, size), scaled % size
    return value + 1


def excess(p: Column, q: Column) -> Column:
    return _quotient((p - q) * (p - q), q)


def _ranked(found: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    if most is not None:
        # tasks drop what lies behind their own first ranks before the shuffle
        ranked = ranked.filter(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS
) -> DataFrame:
    """``lang, source, part, item, value, rank`` over the groups of ``docs(text, lang, source)``.

    A language keeps the terms that at least ``least`` of its documents have. In each group (a
    language and source), a kept term has the share ``p = 1 + floor(10^9 (n + 1) / (N + V))``: ``n``
    occurrences in the group, ``N`` of all kept terms there, ``V`` kept terms. The excess of ``p``
    over ``q`` is ``floor((p - q)^2 / q)``.

    Part ``pair`` has, for each other source of the language, the sum of the excesses over its
    shares, part ``term`` the ``ranks`` terms of the group with the largest excess over the share in
    the whole language, among those that occur and are more frequent than there. Ties go by the
    item's bytes.

    NULL text, language and source are empty texts. A group without terms has its pairs, of value 0
    if the language keeps no term. A language of one source has no pairs; an empty table gives no
    rows. Repeated rows count each; other columns are ignored. Sums are 64 bits wide, which holds
    for up to 9 * 10^15 occurrences of kept terms in a language.
    """
    scratch = Scratch(docs.sparkSession)
    kept = scratch.store(kept_terms(docs, least), "kept")
    own = kept.select("lang", "term", "lang_n", F.inline("sources"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    sizes = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    zero = F.lit(0).cast("long")
    counts = (F.coalesce(c, zero).alias(c) for c in ("total", "own", "v", "lang_total"))
    groups = (
        _texts(docs).select("lang", "source").distinct()
        .join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *counts)
    )
    # the share of a term that the group lacks; a language without kept terms has none
    lacking = F.when(F.col("v") > 0, share(zero, F.col("total"), F.col("v")))
    groups = scratch.store(groups.withColumn("least", lacking), "groups")

    shares = own.join(groups, ["lang", "source"]).withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("v"))
    )
    of_lang = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    lifted = shares.withColumn("q", of_lang).filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value")
    )
    return _ranked(_pairs(shares, groups), "pair").unionByName(_ranked(lifted, "term", ranks))


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language.

    Terms that a group lacks all have its smallest share, and terms of equal counts have equal
    shares. A pair's value is therefore the sum over each side's different shares, as if the other
    side had none of these terms, put right for the terms that both have. Only those are joined by
    term; a task adds up what it finds for a pair before the shuffle.
    """
    groups = groups.select("lang", "source", "own", "v", "least")
    other = groups.select(
        "lang", F.col("source").alias("item"), F.col("own").alias("item_own"),
        F.col("least").alias("item_least"),
    )
    p0, q0 = F.col("least"), F.col("item_least")
    pairs = groups.join(other, "lang").filter("source <> item")
    absent = (F.col("v") - F.col("own") - F.col("item_own")) * excess(p0, q0)
    nothing = pairs.select(
        "lang", "source", "item", F.when(F.col("v") > 0, absent).otherwise(0).alias("value")
    )

    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    value = F.col("times") * excess(F.col("p"), q0)
    ours = levels.join(other, "lang").filter("source <> item").select(
        "lang", "source", "item", value.alias("value")
    )
    theirs = levels.select("lang", F.col("source").alias("item"), "times", F.col("p").alias("q"))
    value = F.col("times") * excess(p0, F.col("q"))
    theirs = theirs.join(groups, "lang").filter("source <> item").select(
        "lang", "source", "item", value.alias("value")
    )

    ours_with_least = shares.select("lang", "term", "source", "p", "least")
    opposite = ours_with_least.select(
        "lang", "term", F.col("source").alias("item"), F.col("p").alias("q"),
        F.col("least").alias("item_least"),
    )
    p, q = F.col("p"), F.col("q")
    value = excess(p, q) - excess(p, q0) - excess(p0, q) + excess(p0, q0)
    both = ours_with_least.join(opposite, ["lang", "term"]).filter("source <> item").select(
        "lang", "source", "item", value.alias("value")
    )
    parts = [part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             for part in (nothing, ours, theirs, both)]
    summed = parts[0]
    for part in parts[1:]:
        summed = summed.unionByName(part)
    return summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
