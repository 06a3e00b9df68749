"""Benchmark decontamination with an FM-index per shard of documents.

A shard's documents become word numbers of the benchmark's vocabulary; runs of known words that are
too short for any phrase are left out, as no occurrence can lie in them. Over the other runs a
suffix array and, from it, the wavelet matrix of the Burrows-Wheeler transform are built. All
phrases are searched backwards at once, occurrences are located by sampled suffix positions, and
the words they cover merge into spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from shoplens.llm.memory import release
from shoplens.llm.wavelet import WaveletMatrix
from shoplens.session import scratch_path

WINDOW = 10
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
# a word of its own, so that the words on both sides make up no phrase
GAP = " […] "
SAMPLING = 16
SHARD_BYTES = 4 << 20
PHRASES_PER_PASS = 500_000
FOLDED = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
    for b in range(256)
)
SPAN = StructType([StructField("start", LongType()), StructField("length", LongType())])
FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("spans", ArrayType(SPAN)),
        StructField("item_ids", ArrayType(LongType())),
    ]
)


def words(text: str | None) -> list[bytes]:
    """The runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(FOLDED).split() if text else []


@F.pandas_udf(LongType())
def word_count(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: len(words(text)))


def cut(text: str | None, spans) -> str | None:
    """``text`` with a ``GAP`` in place of each span of its words and what lies between them."""
    if text is None:
        return None
    raw = text.encode()
    at = [m.span() for m in WORD.finditer(raw)]
    parts, begin = [], 0
    for span in spans:
        first, length = span["start"], span["length"]
        parts.append(raw[begin : at[first][0]])
        begin = at[first + length - 1][1]
    return GAP.join(part.decode().strip() for part in (*parts, raw[begin:])).strip()


@F.pandas_udf(StringType())
def without_spans(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series(list(map(cut, texts, spans)), dtype=object)


class FmIndex:
    """Index of runs of numbers above 0, given as one array in which each run ends with a 0."""

    def __init__(self, runs: np.ndarray, n_values: int) -> None:
        order = _suffixes(runs)
        self.last = runs[order - 1]
        self.transform = WaveletMatrix.of(self.last, max(1, int(n_values - 1).bit_length()))
        counts = np.bincount(runs, minlength=n_values)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        # positions are kept where a run begins, which a search never passes, and in between
        kept = (order % SAMPLING == 0) | (self.last == 0)
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.kept = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes, from and to, that begin with each row of ``phrases``."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            value = phrases[:, k]
            start = self.before[value] - self.transform.place(value, np.zeros_like(low))
            low = start + self.transform.place(value, low)
            high = start + self.transform.place(value, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of suffixes: steps back until one whose position is kept."""
        steps = np.zeros(len(rows), np.int64)
        rows = rows.copy()
        walking = np.arange(len(rows))
        while len(walking):
            at = rows[walking]
            walking = walking[self.kept_before[at] == self.kept_before[at + 1]]
            at = rows[walking]
            value = self.transform.access(at)
            rows[walking] = self.before[value] + self.transform.rank(value, at)
            steps[walking] += 1
        return self.kept[self.kept_before[rows]] + steps


def _suffixes(runs: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the zeros count as different and rise in their order."""
    ends = runs == 0
    n_ends = np.count_nonzero(ends)
    rank = runs.astype(np.int64) + n_ends
    rank[ends] = np.arange(n_ends)
    width, n = 1, len(runs)
    while True:
        following = np.zeros(n, np.int64)
        following[: n - width] = rank[width:] + 1
        key = rank * (n + n_ends + int(runs.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        differs = np.diff(key[order]) != 0
        if differs.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(differs)))
        width *= 2


@dataclass
class Phrases:
    """Distinct phrases of word numbers by length, and the items each belongs to."""

    vocabulary: dict[bytes, int]
    by_length: dict[int, tuple[np.ndarray, list[np.ndarray]]]

    @classmethod
    def of(cls, items: list[tuple[int, list[tuple[bytes, ...]]]]) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item_id, phrases in items:
            for phrase in phrases:
                code = tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in phrase)
                owners.setdefault(code, set()).add(item_id)
        by_length = {}
        for n in sorted({len(p) for p in owners}):
            own = [p for p in owners if len(p) == n]
            by_length[n] = (np.array(own, np.int64), [np.array(sorted(owners[p])) for p in own])
        return cls(vocabulary, by_length)


def phrases_of(text: str | None, window: int) -> list[tuple[bytes, ...]]:
    own = words(text)
    if not own:
        return []
    runs = max(len(own) - window + 1, 1)
    return list(dict.fromkeys(tuple(own[k : k + window]) for k in range(runs)))


def _search_shard(texts: list[str | None], phrases: Phrases) -> list[tuple]:
    """``n_words, spans, item_ids`` for each text."""
    known = phrases.vocabulary.get
    parts, sizes = [], []
    for text in texts:
        own = words(text)
        sizes.append(len(own))
        parts.append(np.fromiter((known(w, 0) for w in own), np.int64, len(own)))
        parts.append(np.zeros(1, np.int64))
    codes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    begins = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) + 1)))
    covered = np.zeros(len(codes) + 1, np.int64)
    item_ids: list[set] = [set() for _ in texts]

    edges = np.flatnonzero(np.diff(np.concatenate(([0], (codes > 0).view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= min(phrases.by_length, default=1)
    starts, ends = starts[long_enough], ends[long_enough]
    if len(starts) and phrases.by_length:
        # every run with the 0 that follows it
        lengths = ends - starts + 1
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        original = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
        index = FmIndex(codes[original] * (original < np.repeat(ends, lengths)),
                        len(phrases.vocabulary) + 1)
        for length, (own, owners) in phrases.by_length.items():
            low, high = index.search(own)
            found = np.flatnonzero(high > low)
            times = high[found] - low[found]
            rows = np.repeat(low[found] - np.cumsum(times) + times, times) + np.arange(times.sum())
            at = original[index.locate(rows)]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + length, -1)
            doc = np.searchsorted(begins, at, side="right") - 1
            pairs = np.unique(np.stack((doc, np.repeat(found, times))), axis=1)
            for d, p in pairs.T.tolist():
                item_ids[d].update(owners[p].tolist())

    hit = np.cumsum(covered) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8)))))
    spans: list[list] = [[] for _ in texts]
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        d = int(np.searchsorted(begins, start, side="right")) - 1
        spans[d].append({"start": start - int(begins[d]), "length": end - start})
    return list(zip(sizes, spans, map(sorted, item_ids), strict=True))


def _search(phrases, kept: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = np.cumsum([len(t) if t else 0 for t in batch["text"]]) // SHARD_BYTES
            for _, shard in batch.groupby(size):
                rows = _search_shard(list(shard["text"]), phrases.value)
                found = pd.DataFrame(rows, columns=FOUND.names)
                yield pd.concat((shard[kept].reset_index(drop=True), found), axis=1)
                release()

    return run


def _blocks(items: DataFrame, window: int, most: int) -> Iterator[tuple[Phrases, bool]]:
    """The phrases of all items, at most so many at a time, and whether others follow."""
    held, n = [], 0
    for row in items.select("item_id", "text").filter("text is not null").toLocalIterator():
        own = phrases_of(row["text"], window)
        while own:
            if n == most:
                yield Phrases.of(held), True
                held, n = [], 0
            held.append((row["item_id"], own[: most - n]))
            own = own[most - n :]
            n += len(held[-1][1])
    yield Phrases.of(held), False


def _merge(found: pd.Series) -> pd.Series:
    def one(spans):
        out: list[dict] = []
        for start, end in sorted((s["start"], s["start"] + s["length"]) for s in spans):
            if out and start <= out[-1]["start"] + out[-1]["length"]:
                out[-1]["length"] = max(out[-1]["length"], end - out[-1]["start"])
            else:
                out.append({"start": start, "length": end - start})
        return out

    return found.map(one)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    keep: tuple[str, ...] = ("doc_id",),
    most: int = PHRASES_PER_PASS,
) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` with ``n_words, spans, item_ids`` of its text.

    The phrases are all ``window`` consecutive words of the ``items(item_id, text)``, or all words
    of an item that has fewer. ``spans`` are the maximal runs of words of the text that lie in an
    occurrence of a phrase (``start``, from 0, and ``length``), ``item_ids`` the items with an
    occurring phrase, ascending. NULL and empty texts have no words; such items have no phrases.
    An item id may repeat: its phrases add up. Documents that repeat an id are searched each.
    Columns of ``docs`` that are called like a result are replaced by it.

    What is sent to the executors is bounded: phrases beyond ``most`` are searched in further
    passes over the documents, one after the other, each stored. For that each row of ``docs`` gets
    a number, by which its spans are merged.
    """
    spark = docs.sparkSession
    kept = [c for c in keep if c not in FOUND.names]
    own = docs.select(*dict.fromkeys((*kept, "text")))
    blocks = _blocks(items, window, most)
    phrases, more = next(blocks)
    if not more:
        schema = StructType([own.schema[c] for c in kept] + FOUND.fields)
        return own.mapInPandas(_search(spark.sparkContext.broadcast(phrases), kept), schema)

    row = max(own.columns, key=len) + "_row"
    numbered = own.withColumn(row, F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered")
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    schema = StructType([StructField(row, LongType()), *FOUND.fields])
    paths: list[str] = []
    while True:
        held = spark.sparkContext.broadcast(phrases)
        found = stored.select(row, "text").mapInPandas(_search(held, [row]), schema)
        if paths:
            found = found.filter(F.size("spans") > 0)
        paths.append(scratch_path(spark, "leaks"))
        found.write.parquet(paths[-1])
        held.destroy()
        if not more:
            break
        del phrases
        phrases, more = next(blocks)
    merge = F.pandas_udf(_merge, FOUND["spans"].dataType)
    merged = (
        spark.read.schema(schema).parquet(*paths)
        .groupBy(row)
        .agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        )
        .withColumn("spans", merge("spans"))
    )
    return stored.select(row, *kept).join(merged, row).select(*kept, *FOUND.names)
