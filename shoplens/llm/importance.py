"""Drawing documents whose hashed word runs look like those of a target.

Words are found by an Aho-Corasick automaton. Its dictionary holds different words between
delimiters, each with a payload: the CRC of the word, the CRC of the word behind a space, and how
many bytes the latter has. A scan emits the payloads of a batch of texts in order. The CRC of two
words follows from two adjacent payloads, as appending bytes acts on a CRC as a linear map, so no
run of words is ever put together as a string. CRCs give buckets, which are counted over the corpus
and the target, and scored.

A task starts with an empty dictionary. Words that a scan passes over are cut out of the gaps,
get their payloads and join the dictionary, up to a bound; beyond it they stay in the gaps. Results
do not depend on what the dictionary holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.memory import release
from shoplens.llm.storage import Scratch

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
SHARE = (25, 100)
# what a task's dictionary may hold: bytes of words, of which each takes some 60 bytes of automaton
DICTIONARY_BYTES = 600_000
# the automaton is built anew when so large a part of a batch's words lay in gaps
GAP_SHARE = 0.02
SCANNED_BYTES = 1 << 20
SPACE = 32
# A-Z become a-z, other ASCII but digits is blank, all bytes of further characters stay
FOLDED = bytes(
    b + 32 if 65 <= b <= 90
    else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
    else SPACE
    for b in range(256)
)
COUNTED = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])


def _appended(crc: np.ndarray, zeros: int) -> np.ndarray:
    """What CRCs become when so many zero bytes are appended, without their final complement."""
    polynomial = np.uint32(0xEDB88320)
    for _ in range(8 * zeros):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), polynomial, np.uint32(0))
    return crc


class CrcJoin:
    """CRCs of two strings put together, from those of the parts and the second one's length.

    Appending a string of ``n`` bytes takes the first CRC through a linear map that depends on ``n``
    alone. The map of each power of two is held as a table for each byte of the CRC, and longer
    ones are composed from these.
    """

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        one = np.stack([_appended(byte << np.uint32(8 * k), 1) for k in range(4)])
        self.powers = [one]

    @staticmethod
    def _through(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
        low = np.uint32(255)
        out = tables[0][crc & low]
        for k in range(1, 4):
            out = out ^ tables[k][(crc >> np.uint32(8 * k)) & low]
        return out

    def __call__(self, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
        out, power = first.copy(), 0
        top = int(length.max(initial=0))
        while top >> power:
            if power == len(self.powers):
                twice = self.powers[-1]
                self.powers.append(np.stack([self._through(twice, t) for t in twice]))
            at = np.flatnonzero((length >> power) & 1)
            out[at] = self._through(self.powers[power], out[at])
            power += 1
        return out ^ second


class Dictionary:
    """Words between delimiters with their payloads, and the automaton over them."""

    def __init__(self, most: int = DICTIONARY_BYTES) -> None:
        self.most = most
        self.automaton = ahocorasick.Automaton()
        self.numbers: dict[bytes, int] = {}
        self.size = 0
        self.waiting: list[bytes] = []
        self.built = False
        self.word = np.zeros(1 << 10, np.uint32)
        self.spaced = np.zeros(1 << 10, np.uint32)
        self.length = np.zeros(1 << 10, np.int64)

    def _put(self, number: int, word: bytes) -> None:
        if number >= len(self.word):
            for name in ("word", "spaced", "length"):
                held = getattr(self, name)
                setattr(self, name, np.concatenate((held, np.zeros_like(held))))
        self.word[number] = crc32(word)
        self.spaced[number] = crc32(b" " + word)
        self.length[number] = len(word) + 1

    def scan(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of ``raw`` start, and their numbers, which say where payloads are.

        ``raw`` is folded and has a space at each end.
        """
        letters = np.frombuffer(raw, np.uint8) != SPACE
        edges = np.flatnonzero(letters[1:] != letters[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        numbers = np.full(len(starts), -1, np.int64)
        if self.built:
            hits = chain.from_iterable(self.automaton.iter(raw.decode("latin-1")))
            found = np.fromiter(hits, np.int64).reshape(-1, 2)
            # a hit ends with the delimiter behind its word
            numbers[np.searchsorted(ends, found[:, 0])] = found[:, 1]
        gaps = np.flatnonzero(numbers < 0)
        if len(gaps):
            self._fill(raw, starts, ends, numbers, gaps)
        return starts, numbers

    def _fill(self, raw, starts, ends, numbers, gaps) -> None:
        """Numbers the words that the automaton does not hold, and lets it learn them."""
        known, fresh = self.numbers, {}
        n = len(known)
        for k, a, b in zip(gaps.tolist(), starts[gaps].tolist(), ends[gaps].tolist(), strict=True):
            word = raw[a:b]
            number = known.get(word)
            if number is None:
                number = fresh.get(word)
            if number is None:
                number = fresh[word] = n + len(fresh)
                self._put(number, word)
            numbers[k] = number
        for word, number in fresh.items():
            # the numbers of words beyond the bound are those of this scan only
            if self.size + len(word) > self.most:
                break
            known[word] = number
            self.size += len(word)
            self.waiting.append(word)
        if self.waiting and len(gaps) > GAP_SHARE * len(starts):
            for word in self.waiting:
                self.automaton.add_word(f" {word.decode('latin-1')} ", known[word])
            self.waiting.clear()
            self.automaton.make_automaton()
            self.built = True


class Features:
    """Buckets of all words and all two neighbouring words of texts, and the rows they are from."""

    def __init__(self, buckets: int, most: int = DICTIONARY_BYTES) -> None:
        self.buckets = np.uint32(buckets)
        self.dictionary = Dictionary(most)
        self.join = CrcJoin()

    def of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``row, bucket`` of all features, and the rows of the words alone, portion by portion."""
        for parts in _portions(texts):
            raw = b" ".join((b"", *(text for _, text, _ in parts), b""))
            starts, numbers = self.dictionary.scan(raw)
            ends = np.cumsum([len(text) + 1 for _, text, _ in parts])
            part = np.searchsorted(ends, starts)
            row = np.array([k for k, _, _ in parts], np.int64)[part]
            word, spaced, length = (
                held[numbers]
                for held in (self.dictionary.word, self.dictionary.spaced, self.dictionary.length)
            )
            beside = np.flatnonzero(part[1:] == part[:-1])
            pair = self.join(word[beside], spaced[beside + 1], length[beside + 1])
            # a part that goes on repeats the word before it
            first = np.append(True, part[1:] != part[:-1])[: len(part)]
            own = np.flatnonzero(~(first & np.array([again for _, _, again in parts], bool)[part]))
            bucket = np.concatenate((word[own], pair)) % self.buckets
            yield np.concatenate((row[own], row[beside])), bucket, row[own]


def _portions(texts: list[str | None]) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Folded texts with their rows, about ``SCANNED_BYTES`` at a time.

    A longer text is cut between words, and what follows starts with the last word before the cut.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        if not text:
            continue
        raw, again = text.encode().translate(FOLDED), 0
        while len(raw) > SCANNED_BYTES:
            # behind the word that is repeated, however long it is
            cut = raw.find(b" ", max(SCANNED_BYTES, again + 1))
            if cut < 0:
                break
            head = raw[:cut].rstrip()
            yield [(row, head, again > 0)]
            last = head[head.rfind(b" ") + 1 :]
            raw, again = last + raw[cut:], len(last)
        held.append((row, raw, again > 0))
        size += len(raw) + 1
        if size >= SCANNED_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, n = Features(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in features.of(batch.column("text").to_pylist()):
                n += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(n)
        del features
        release()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], schema=COUNTED)

    return run


def count_buckets(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: the features of all texts; a task hands on one row for each bucket."""
    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _counted(buckets), "bucket int, n long"
    )
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket, thousand times the logarithm of how much more frequent it is in the target.

    The driver sees two numbers for each bucket.
    """
    s, t = np.zeros(buckets), np.zeros(buckets)
    for held, texts in ((s, docs), (t, target)):
        for row in count_buckets(texts, buckets).collect():
            held[row["bucket"]] = row["n"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def _weighed(gains, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, table = Features(len(gains.value)), gains.value
        for batch in batches:
            size = batch.num_rows
            n, n_words, weight = (np.zeros(size, np.int64) for _ in range(3))
            for row, bucket, words in features.of(batch.column("text").to_pylist()):
                n += np.bincount(row, minlength=size)
                n_words += np.bincount(words, minlength=size)
                # whole numbers far below 2^53, which doubles add exactly
                weight += np.bincount(row, table[bucket], minlength=size).astype(np.int64)
            weight = np.where(n > 0, weight // np.maximum(n, 1), 0)
            own = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(n), pa.array(n_words), pa.array(weight)],
                names=[*kept, "n_features", "n_words", "weight"],
            )
        del features
        release()

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """Thousand times a Gumbel variable, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(
    docs: DataFrame,
    target: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    buckets: int = BUCKETS,
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The columns ``keep`` of all ``docs`` with ``n_features, n_words, weight, score, rank``.

    Features of a text are its words and each two neighbouring words, in buckets by CRC. ``weight``
    is the floored mean of the gains of its buckets (0 without features), ``score`` adds ``noise``.
    Of the documents with ``least_words`` words, the ``share`` with the highest scores is drawn and
    ranked from 1; others have no rank. Ties go to the smaller ``doc_id``, then to any.

    NULL and empty texts have no words; a NULL ``doc_id`` counts as an empty text in the noise and
    comes last among ties. Repeated rows are documents each. Columns of ``docs`` called like a
    result are replaced. An empty target or table is allowed.

    What the driver sees are two numbers for each bucket.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    gains = bucket_gains(docs, target, buckets)
    results = ("n_features", "n_words", "weight", "score", "rank")
    kept = [c for c in keep if c not in results]
    own = docs.select(
        *(c for c in dict.fromkeys((*kept, "doc_id")) if c != "text"),
        F.col("text").cast("string").alias("text"),
    )
    carried = [c for c in own.columns if c != "text" or "text" in kept]
    ddl = own.select(*carried).schema
    for name in results[:3]:
        ddl = ddl.add(name, "long")
    # a name that none of the columns has
    row = max(own.columns, key=len) + "_row"
    weighed = own.mapInArrow(_weighed(spark.sparkContext.broadcast(gains), carried), ddl)
    weighed = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    weighed = scratch.store(weighed.withColumn(row, F.monotonically_increasing_id()), "weighed")

    long_enough = F.col("n_words") >= least_words
    drawn = weighed.filter(long_enough).count() * share[0] // share[1]
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc(row)]
    # only these are sorted; equal scores of equal ids are still dealt over ranges by the row number
    ranged = (
        weighed.filter(long_enough).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(row, F.monotonically_increasing_id())
    )
    ranged = scratch.store(ranged, "ranged")
    part, place = F.shiftright(row, 33), F.col(row).bitwiseAND((1 << 33) - 1)
    sizes = ranged.groupBy(part.alias(f"{row}_part")).agg(F.count("*").alias(f"{row}_n"))
    # one row for each range
    before = F.sum(f"{row}_n").over(
        Window.orderBy(f"{row}_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = sizes.select(f"{row}_part", F.coalesce(before, F.lit(0)).alias(f"{row}_n"))
    rank = F.col(f"{row}_n") + place + 1
    ranked = ranged.withColumn(f"{row}_part", part).join(before, f"{row}_part").withColumn(
        "rank", F.when(rank <= drawn, rank)
    )
    others = weighed.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*kept, *results).unionByName(others.select(*kept, *results))
