"""Language identification with bit-sliced Bloom filters of n-grams.

Each slot of a filter holds one bit per language, for up to 64 languages; more are dealt to several
filters, by size. The slots of an n-gram, combined with AND, name all languages of the filter that
contain it. Per text and language the set bits are counted, the share that
false positives explain is taken off, and the largest count decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shoplens.llm.memory import release

GRAM = 4
PROBES = 3
TRAINING_TEXTS = 4000
SHARED_ABOVE = 0.25
LEAST_TEXTS = 2
FEW_TEXTS = 16
WORD = 64
BITS_PER_GRAM = 12
UNKNOWN = "und"

LETTER = re.compile(r"[^\W\d_]")
FOLDED = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64
)
PREDICTION = StructType(
    [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
)


def grams(text: str) -> np.ndarray:
    """The codes of all runs of ``GRAM`` bytes of the text, letters only, in lower case."""
    b = np.frombuffer(b" " + text.lower().encode().translate(FOLDED) + b" ", dtype=np.uint8)
    if len(b) < GRAM:
        return np.empty(0, np.uint32)
    codes = b[: len(b) - GRAM + 1].astype(np.uint32)
    for k in range(1, GRAM):
        codes <<= 8
        codes |= b[k : len(b) - GRAM + 1 + k]
    return codes[codes != 0x20202020]


@dataclass
class Filters:
    """One word of language bits per slot, and each language's false positive rate.

    ``groups`` are the numbers of up to ``WORD`` languages, whose bits follow that order, and their
    slots.
    """

    languages: list[str]
    groups: list[tuple[np.ndarray, np.ndarray]]
    false_positives: np.ndarray
    usual: int

    @staticmethod
    def _slots(codes: np.ndarray, n_slots: int) -> Iterator[np.ndarray]:
        shift = np.uint64(64 - n_slots.bit_length() + 1)
        for m in MULTIPLIERS[:PROBES]:
            yield ((codes.astype(np.uint64) + np.uint64(1)) * m) >> shift

    @classmethod
    def build(cls, members: pd.DataFrame, languages: list[str], usual: int) -> Filters:
        """``members``: the columns ``gram`` and ``language``, an index into ``languages``."""
        codes = members["gram"].to_numpy(np.int64).astype(np.uint32)
        numbers = members["language"].to_numpy(np.int64)
        sizes = np.bincount(numbers, minlength=len(languages))
        # languages of like size share a filter, so that many small ones take little room
        by_size = np.argsort(-sizes, kind="stable")
        groups, filled = [], np.zeros(len(languages))
        for own in np.split(by_size, range(WORD, len(languages), WORD)):
            n_slots = 1 << max(10, (int(sizes[own].max()) * BITS_PER_GRAM).bit_length())
            slots = np.zeros(n_slots, np.uint64)
            bit = np.full(len(languages), -1)
            bit[own] = np.arange(len(own))
            held = bit[numbers] >= 0
            bits = np.uint64(1) << bit[numbers[held]].astype(np.uint64)
            for at in cls._slots(codes[held], n_slots):
                np.bitwise_or.at(slots, at, bits)
            filled[own] = [
                ((slots >> np.uint64(k)) & np.uint64(1)).mean() for k in range(len(own))
            ]
            groups.append((own, slots))
        return cls(languages, groups, filled**PROBES, usual)

    def counts(self, codes: np.ndarray) -> np.ndarray:
        """Per language, the n-grams it contains, without those that chance explains."""
        hits = np.zeros(len(self.languages), np.int64)
        for own, slots in self.groups:
            masks = ~np.zeros(len(codes), np.uint64)
            for at in self._slots(codes, len(slots)):
                masks &= slots[at]
            hits[own] = [np.count_nonzero(masks & np.uint64(1 << k)) for k in range(len(own))]
        fp = self.false_positives
        return np.clip((hits - fp * len(codes)) / np.maximum(1 - fp, 1e-9), 0, len(codes))

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0
        codes = grams(text)
        counts = self.counts(codes)
        best = int(counts.argmax())
        if not counts[best]:
            return self.languages[self.usual], 0.0
        return self.languages[best], float(counts[best] / len(codes))


def _gram_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each language of a batch, the number of texts that hold each n-gram."""
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            own = np.concatenate([np.unique(grams(t)) for t in texts])
            codes, n = np.unique(own, return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": codes.astype(np.int64), "texts": n})
        release()


def fit(labelled: DataFrame, training_texts: int = TRAINING_TEXTS) -> Filters:
    """Filters learnt from rows with ``doc_id, text, lang``.

    Of each language about ``training_texts`` texts are used, chosen by a hash of ``doc_id``; this
    bounds the n-grams that reach the driver. An n-gram belongs to a language if at least
    ``LEAST_TEXTS`` of these texts hold it and its share of them is at least ``SHARED_ABOVE`` times
    the largest share any language has. A language with fewer than ``FEW_TEXTS`` of them has the
    n-grams of each, and its shares count as those of so many texts, so that a rare or mistaken
    ``lang`` takes no n-gram from a well-known one. There may be any number of languages. Rows without text or ``lang`` teach nothing; without any
    rows there are no languages and everything is ``UNKNOWN``.
    """
    known = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Filters([], [], np.zeros(0), 0)
    share = F.create_map(
        *[F.lit(x) for lang in languages for x in (lang, min(1.0, training_texts / sizes[lang]))]
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    chosen = known.filter(place < share[F.col("lang")]).select("lang", "text")
    used = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    sizes_used = F.create_map(*[F.lit(x) for lang in used for x in (lang, float(used[lang]))])
    n_used = sizes_used[F.col("lang")]
    found = (
        chosen.mapInPandas(_gram_texts, "lang string, gram long, texts long")
        .groupBy("gram", "lang")
        .agg(F.sum("texts").alias("texts"))
        .filter((F.col("texts") >= LEAST_TEXTS) | (n_used < FEW_TEXTS))
    )
    rates = found.withColumn("rate", F.col("texts") / F.greatest(n_used, F.lit(float(FEW_TEXTS))))
    by_gram = rates.groupBy("gram").agg(
        F.max("rate").alias("most"), F.collect_list(F.struct("lang", "rate")).alias("all")
    )
    number = F.create_map(*[F.lit(x) for pair in enumerate(languages) for x in pair[::-1]])
    members = (
        by_gram.select("gram", "most", F.inline("all"))
        .filter(F.col("rate") >= SHARED_ABOVE * F.col("most"))
        .select("gram", number[F.col("lang")].alias("language"))
        .toPandas()
    )
    usual = max(range(len(languages)), key=lambda k: sizes[languages[k]])
    return Filters.build(members, languages, usual)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of its column ``text``.

    ``score`` is the share of the text's n-grams that the filter of the language holds. Texts that
    are NULL, empty or without a letter are ``UNKNOWN`` with score 0, as all are without languages;
    texts none of whose n-grams is known get the most frequent language with score 0. Of languages
    that tie, the first in alphabetical order wins. Columns of these two names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(texts: pd.Series) -> pd.DataFrame:
        release()
        return pd.DataFrame(map(held.value.predict, texts), columns=["lang_pred", "score"])

    kept = [c for c in docs.columns if c not in PREDICTION.names]
    free = max(kept, key=len, default="") + "_found"
    # otherwise a filter on the result would predict once more
    once = F.pandas_udf(predict, PREDICTION).asNondeterministic()
    found = docs.select(*kept, once(docs["text"]).alias(free))
    return found.select(*kept, *[F.col(free)[c].alias(c) for c in PREDICTION.names])
