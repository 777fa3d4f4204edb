"""Corpus preparation in five stages; each reads what the one before it wrote.

language ID -> SimHash near-duplicates -> repeated byte strings -> benchmark
decontamination -> BPE ids. Every stage works on all rows its predecessor kept, and
its decisions take effect:

* ``language``: rows without a letter or text (``und``), or whose language no class
  claims with ``MIN_SCORE``, go. Labels for training come from the rows' own ``lang``.
* ``near_duplicates``: of each SimHash component one row stays: the one with the smallest
  doc_id (null ids come last; of identical ids the one with the smallest text hash).
* ``repeated_bytes``: byte strings of 200 that occur elsewhere are cut out of ``text``.
* ``decontaminate``: rows that contain a benchmark item go.
* ``encode``: token ids (packed, 4 bytes each) and the decoded text of what is left, with their digests.

Empty tables pass through every stage as empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotrail.llm import bpe, decontaminate, langid, simhash, suffixdedup
from geotrail.llm.common import materialize, read_table
from geotrail.sources.store import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "word_bpe_49k.json"
MIN_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = langid.fit(docs)
    kept = langid.predict(docs, model, *COLUMNS)
    return kept.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    classes = simhash.near_duplicates(docs).select("fp", "root").distinct()
    # rows meet their component by fingerprint, so ids may be null or stand on several texts; copies fold first
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text", "lang", "source", "n_chars").alias("h"))
    first = F.min_by(F.struct(*COLUMNS), order).alias("r")
    by_fp = simhash.with_fingerprints(docs).groupBy("fp").agg(first)
    kept = by_fp.join(classes, "fp").select("root", "r.*").groupBy("root").agg(first)
    return kept.select("r.*").select(*COLUMNS)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(docs.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs.select(*COLUMNS), public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_bytes", repeated_bytes),
    ("decontaminate", without_benchmark),
    ("encode", encode),
]
# learned models, hash majorities and merges: SQL can't express these stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
