"""Scores of an n-gram language model held in Elias-Fano tries.

The model is a bigram model with Dirichlet smoothing: with c counted in training documents,
p(w | v) = (c(v w) + m p(w)) / (c(v) + m) and p(w) = (c(w) + 1) / (N + V + 1), so that the
probabilities after any word, one unknown word included, sum to 1. Every logarithm depends either on
a word and the word before it or on the preceding word alone. All occurrences of a word therefore go
to one shard with no more than the hashes of its neighbours; the shard counts, builds the trie of
its words, looks all occurrences up and returns a sum per document. A frequent word is dealt to
several shards by the word before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.elias_fano import Trie, pack, unpack
from shoplens.llm.memory import release, released
from shoplens.llm.words import STEP, hashes, mixed, words

MASS = 100.0
SPLIT_SHARE = 0.25
BATCH_CHARS = 8 << 20
END, START = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0x57A2757A2757A271)
MASK32 = np.uint64(0xFFFFFFFF)
SCORED = "doc_id long, n_tokens long, n_known long, base_part double, score_part double"


@dataclass
class Totals:
    """Of the training documents: tokens, different tokens, documents, and frequent words."""

    tokens: int
    different: int
    documents: int
    frequent: dict[int, int]


def _tokens(text: str | None) -> np.ndarray:
    return np.append(hashes(words(text)), END)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for texts in released(_portions(batch)):
            word, n = np.unique(
                np.concatenate([_tokens(t) for t in texts["text"]]), return_counts=True
            )
            yield pd.DataFrame({"word": word.view(np.int64), "n": n})


def _portions(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    sizes = np.cumsum([len(t) if t else 0 for t in batch["text"]]) // BATCH_CHARS
    for _, portion in batch.groupby(sizes):
        yield portion


def totals(training: DataFrame, shards: int) -> Totals:
    """Counts of the training documents ``training(text)``.

    A word is frequent if it would fill more than ``SPLIT_SHARE`` of a shard; there are fewer than
    ``shards / SPLIT_SHARE`` of them.
    """
    counts = (
        training.select("text").mapInPandas(_counted, "word long, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )
    end = int(END.view(np.int64))
    share = F.sum("n").alias("tokens"), F.count("*").alias("different")
    documents = F.sum(F.when(F.col("word") == end, F.col("n"))).alias("documents")
    counts = counts.persist()
    row = counts.agg(*share, documents).first()
    tokens = row["tokens"] or 0
    frequent = counts.filter(F.col("n") > max(1, tokens * SPLIT_SHARE / shards)).collect()
    counts.unpersist()
    return Totals(
        tokens, row["different"], row["documents"] or 0,
        {r["word"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in frequent},
    )


def _shard_of(word: np.ndarray, context: np.ndarray, frequent: np.ndarray, shards: int):
    place = mixed(word)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)
        split = frequent[at] == word
        place = np.where(split, mixed(word * STEP + context), place)
    return ((place >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _occurrences(held, shards: int):
    """For each portion of documents and each shard a block of the tokens that belong there.

    A block has the different words, ascending, the contexts of each, and the documents of each
    pair, which repeat for repeated tokens. The first block of a portion also has its documents.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = np.array(sorted(held.value.frequent), np.uint64)
        packer, n = zstandard.ZstdCompressor(level=1), 0
        for batch in batches:
            for portion in released(_portions(batch)):
                own = [_tokens(t) for t in portion["text"]]
                lengths = np.array([len(t) for t in own])
                word = np.concatenate(own)
                before = np.empty_like(word)
                before[1:] = word[:-1]
                before[np.cumsum(lengths) - lengths] = START
                context = mixed(before) >> np.uint64(32)
                doc = np.repeat(np.arange(len(own), dtype=np.uint32), lengths)
                shard = _shard_of(word, context, frequent, shards)
                different, number = np.unique(word, return_inverse=True)
                order = np.argsort((number.astype(np.uint64) << np.uint64(32)) | context)
                order = order[np.argsort(shard[order].astype(np.uint32), kind="stable")]
                word, context, doc, shard = word[order], context[order], doc[order], shard[order]
                train = portion["train"].to_numpy(bool)
                source = np.array([TaskContext.get().partitionId(), n])
                header = [
                    portion["doc_id"].to_numpy(np.int64, na_value=0),
                    portion["doc_id"].isna().to_numpy(bool), lengths,
                ]
                edges = np.flatnonzero(np.diff(shard, prepend=shard[0] + 1, append=shard[-1] + 1))
                out = []
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    arrays = _block(word[a:b], context[a:b], doc[a:b])
                    blob = pack([source, train, *arrays, *(header if k == 0 else [])])
                    out.append((int(shard[a]), int(source[0]) << 32 | n, packer.compress(blob)))
                n += 1
                yield pd.DataFrame(out, columns=["shard", "source", "block"])

    return run


def _block(word: np.ndarray, context: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    new_word = np.diff(word, prepend=~word[:1]) != 0
    new_pair = new_word | (np.diff(context, prepend=~context[:1]) != 0)
    pairs = np.flatnonzero(new_pair)
    contexts_of = np.diff(np.flatnonzero(new_word[pairs]), append=len(pairs))
    docs_of = np.diff(pairs, append=len(word))

    def narrow(x: np.ndarray) -> np.ndarray:
        return x.astype(np.min_scalar_type(int(x.max(initial=0))))

    return [
        word[new_word], narrow(contexts_of), context[pairs].astype(np.uint32), narrow(docs_of),
        narrow(doc),
    ]


def _scores(held, mass: float):
    """Builds the trie of one shard and looks up all its blocks."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        known, unpacker = held.value, zstandard.ZstdDecompressor()
        group = group.sort_values("source")
        blocks = [unpack(unpacker.decompress(b)) for b in group["block"]]
        word, number = np.unique(np.concatenate([b[2] for b in blocks]), return_inverse=True)
        contexts_of = np.concatenate([b[3].astype(np.int64) for b in blocks])
        context = np.concatenate([b[4] for b in blocks]).astype(np.uint64)
        pair_key = (np.repeat(number, contexts_of).astype(np.uint64) << np.uint64(32)) | context
        key, pair = np.unique(pair_key, return_inverse=True)
        owner = (key >> np.uint64(32)).astype(np.int64)
        del pair_key, number, context, contexts_of

        c_pair = np.zeros(len(key), np.int64)
        at = 0
        for b in blocks:
            own = pair[at : at + len(b[4])]
            at += len(own)
            taught = np.repeat(own, b[5])[b[1][b[6]]]
            c_pair += np.bincount(taught, minlength=len(key))
        c_word = np.bincount(owner, c_pair, minlength=len(word)).astype(np.int64)
        frequent = np.array(sorted(known.frequent), np.uint64)
        split = np.flatnonzero(np.isin(word, frequent))
        c_word[split] = [known.frequent[w] for w in word[split].tolist()]

        room = known.tokens + known.different + 1
        prior = mass * (c_word + 1) / room
        in_model, stored = c_word > 0, c_pair > 0
        rank = np.cumsum(in_model) - 1
        trie = Trie(
            Trie.build(
                word[in_model], np.log10(prior[in_model]), rank[owner[stored]],
                (key[stored] & MASK32).astype(np.uint32),
                np.log10(c_pair[stored] + prior[owner[stored]]),
            )
        )

        index = trie.find(word)
        value = np.append(trie.word_values(), np.log10(mass / room))[index][owner]
        queried = np.flatnonzero(index[owner] >= 0)
        after = trie.after(index[owner[queried]], (key[queried] & MASK32).astype(np.uint32))
        value[queried] = np.where(np.isnan(after), value[queried], after)
        # a word's own probability in the base, and what it costs the word that follows it
        base = np.log10(c_word + 1)[owner]
        follows = np.where(word == END, 0.0, np.log10(c_word + mass))[owner]
        value = value - follows
        known_pair = (c_word > 0)[owner].astype(np.float64)

        out, at = [], 0
        for source, b in zip(group["source"], blocks, strict=True):
            own = np.repeat(pair[at : at + len(b[4])], b[5])
            at += len(b[4])
            sums = [
                np.bincount(b[6], column[own], minlength=len(b[1]))
                for column in (known_pair, base, value)
            ]
            sums[0] = sums[0].astype(np.int32)
            out.append((source, zstandard.compress(pack([*sums, *b[7:]]), 1)))
        del blocks, pair, key, owner, value, base, follows, known_pair, trie
        release()
        return pd.DataFrame(out, columns=["source", "sums"])

    return run


def _per_document(group: pd.DataFrame) -> pd.DataFrame:
    total: list[np.ndarray] | None = None
    header: list[np.ndarray] = []
    for blob in group["sums"]:
        arrays = unpack(zstandard.decompress(blob))
        header = arrays[3:] or header
        total = [x + y for x, y in zip(total, arrays, strict=False)] if total else arrays[:3]
    doc_id, missing, lengths = header
    return pd.DataFrame(
        {
            "doc_id": pd.array(doc_id, "Int64").copy(), "n_tokens": lengths, "n_known": total[0],
            "base_part": total[1], "score_part": total[2],
        }
    ).assign(doc_id=lambda d: d["doc_id"].mask(missing))


def score(docs: DataFrame, shards: int | None = None, mass: float = MASS) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for all ``docs``.

    ``docs`` has ``doc_id, text, train``; rows whose ``train`` is true teach the model, all are
    scored. Tokens are the words of the text and an end. ``base_score`` is the log10 probability
    under the unigram counts alone, ``score`` that of the bigram model with smoothing mass ``mass``,
    its logarithms rounded to 16 bits within a shard's range. NULL and empty texts consist of the
    end; NULL ``train`` is false; rows that repeat a ``doc_id`` are documents of their own. Without
    training documents every word is unknown. Words and contexts are known by hashes of 64 and 32
    bits. ``shards`` follows ``spark.sql.shuffle.partitions`` and should grow with the input.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    train = F.coalesce("train", F.lit(False)).alias("train")
    docs = docs.select("doc_id", "text", train)
    known = totals(docs.filter("train"), shards)
    held = spark.sparkContext.broadcast(known)
    sums = (
        docs.mapInPandas(_occurrences(held, shards), "shard int, source long, block binary")
        .groupBy("shard")
        .applyInPandas(_scores(held, mass), "source long, sums binary")
        .groupBy("source")
        .applyInPandas(_per_document, SCORED)
    )
    room = float(np.log10(known.tokens + known.different + 1))
    start = float(np.log10(known.documents + mass))
    return sums.select(
        "doc_id", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") - F.col("n_tokens") * room).alias("base_score"),
        (F.col("score_part") - start).alias("score"),
    )
