"""From raw documents to packed training sequences.

Each stage works on all documents that the one before it kept; its result is written as Parquet to
the shared folder and read again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.llm import decontaminate, language, minhash, packing, suffix_dedup
from shoplens.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.1
SHINGLE_WORDS = 5
SIMILARITY = (4, 5)
REPEATED_BYTES = 50
LEAKED_WORDS = 10
LEAKED_SHARE = 0.5
CAPACITY = 4096
# as the stages before leave an executor little memory
CACHED_WORDS = 300_000

# rows that are handed to a Python worker at once; whole texts come with them
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

ORACLE_SQL = None


def small_batches(
    stage: Callable[[SparkSession, DataFrame, str], DataFrame],
) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with at most ``BATCH_ROWS`` rows in a batch, from now on in this session.

    The stages share the memory of the same executors, which keep what one of them has needed. The
    setting stays, as a stage's result is computed after the function has returned.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get(BATCH_SETTING))
        if rows <= 0 or rows > BATCH_ROWS:
            spark.conf.set(BATCH_SETTING, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` names.

    Rejected are texts that are NULL or without a letter, and those that share hardly any n-gram
    with any language. A missing ``lang`` becomes the predicted one. Without a single labelled
    document nothing can be recognised and every document goes.
    """
    found = language.identify(docs, language.fit(docs))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(known).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


@small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest ``doc_id``.

    Rows that repeat id and text are one document. Documents without words stay.
    """
    found = minhash.near_duplicates(docs, SHINGLE_WORDS, SIMILARITY)
    kept = found.filter("kept").select("doc_id")
    # NULL equals nothing, so documents without an id are never duplicates
    staying = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return staying.unionAll(docs.filter("doc_id is null")).select(*COLUMNS)


@small_batches
def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that documents of smaller id have in a row; emptied ones go."""
    found = suffix_dedup.remove_repeats(docs, REPEATED_BYTES, keep=COLUMNS, with_text=True)
    changed = F.size("removed") > 0
    cleaned = found.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    left = ~changed | (F.trim("text") != "")
    return cleaned.filter(left).withColumn(
        "n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


@small_batches
def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that lie in a phrase of the benchmark.

    Phrases are ``LEAKED_WORDS`` consecutive words of an item; they are cut out of the text, and a
    document goes if more than ``LEAKED_SHARE`` of its words lie in phrases. An item of fewer words
    may be anyone's phrase and is left where it stands, but a document goes if such items make up
    more than that share of it.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    n_words = decontaminate.word_count("text")
    found = decontaminate.find_leaks(
        docs, items.filter(n_words >= LEAKED_WORDS), LEAKED_WORDS, keep=COLUMNS
    )
    found = found.filter(_in_spans() <= LEAKED_SHARE * F.col("n_words"))
    found = found.select(*COLUMNS, F.col("spans").alias("leaked"))
    short = items.filter(n_words.between(1, LEAKED_WORDS - 1))
    if not short.isEmpty():
        found = decontaminate.find_leaks(found, short, LEAKED_WORDS, keep=(*COLUMNS, "leaked"))
        found = found.filter(_in_spans() <= LEAKED_SHARE * F.col("n_words"))
    # stored, so that no task needs one Python worker to search and another one to cut
    path = scratch_path(spark, "leaked")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    changed = F.size("leaked") > 0
    left = decontaminate.without_spans(F.when(changed, F.col("text")), "leaked")
    cleaned = found.withColumn("text", F.when(changed, left).otherwise(F.col("text")))
    return cleaned.withColumn(
        "n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def _in_spans() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])


@small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of ``CAPACITY`` tokens."""
    return packing.pack(docs, CAPACITY, cached=CACHED_WORDS)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeated_passages),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
