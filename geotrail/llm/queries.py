"""Registered queries of the thirteen operators, over the whole tables with production parameters.

SQL expresses operators 12 and 13 (``oracles.py``). It can't express the others (hash majorities, tokenizer merges, learned
models); tests/llm checks those against brute force, the libraries or labels.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotrail.llm import bpe, contextmix, convrepair, decontaminate, htmltext, langid, planes, prefixtrie, quality, rules, simhash, suffixdedup, tokencount
from geotrail.llm.common import fold_of, read_table
from geotrail.llm.oracles import ORACLE_SQL  # noqa: F401  (read by __spark_entry__.py)

TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
END_ID = 2
QUALITY_THRESHOLD = 0.3


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return planes.token_file_digest(spark, _docs(spark, sf_dir), path, END_ID)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"), lambda c: fold_of(c, 5) == 0)
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    held_out = fold_of(F.col("doc_id"), 3) == 1
    model = langid.fit(docs, train=~held_out)
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.apply_rules(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"), lambda c: fold_of(c, 5) != 0)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_pages(read_table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, sf_dir), shingle=3, max_bits=3).select("doc_id", "fingerprint", "component_id")


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 5) == 1
    scored = contextmix.score_documents(_docs(spark, sf_dir), held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup_digest(_docs(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode_digest(_docs(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_tokens(_docs(spark, sf_dir), public_tokenizers.path(PIECE_MODEL))
    over = (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return counted.select(F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", "n_tokens", over)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.repair(convrepair.damaged(read_table(spark, sf_dir, "conversations")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(prefixtrie.rebuilt(read_table(spark, sf_dir, "conversations")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_decontaminate, op3_quality, op4_language, op5_quality_rules,
        op6_main_text, op7_simhash, op8_context_mixing, op9_repeated_bytes, op10_bpe,
        op11_token_counts, op12_conversation_repair, op13_prefix_trie,
    )
}
