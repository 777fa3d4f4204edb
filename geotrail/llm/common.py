"""Helpers shared by the operators: input selection, scratch tables, token rules, dense sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geotrail.sources.store import scratch_path

# Fixed rule: a word is a maximal run of characters that are none of space and 0x09-0x0D.
# bytes.split() without arguments cuts at exactly these six characters, and bytes.lower()
# changes only A-Z, so tokenising the UTF-8 bytes follows the rule without a regex.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: UTF-8 bytes of text that one NumPy step works on (a longer text is a block of its own)
BLOCK_BYTES = 2_000_000
#: rows per Arrow batch handed to Python: bounds a task's memory when texts are long
BATCH_ROWS = 512
#: a key with more than one in so many rows is hot; there are fewer hot keys than this
HOT_KEYS = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def select_docs(docs: DataFrame, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``text`` (null becomes empty), plus the columns asked for."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
        *more,
    )


def small_batches(spark: SparkSession) -> None:
    """Bound the rows per Arrow batch of this session (never raises a lower setting)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    cur = int(spark.conf.get(key, "10000"))
    if cur <= 0 or cur > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: work done once, lineage cut, loss-proof."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_classes(rows: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``classes`` (one row per ``key``, ``n_rows``: its rows), safe from hot keys.

    Keys with more than one ``HOT_KEYS``-th of all rows are fewer than ``HOT_KEYS``: their
    classes are broadcast, so their rows stay where they are; all others meet in a
    shuffled join, where no key holds more than that share. ``n_rows`` is not returned.
    """
    total = classes.agg(F.sum("n_rows")).first()[0] or 0
    is_hot = F.col("n_rows") * HOT_KEYS > F.lit(total)
    hot, rest = classes.where(is_hot).drop("n_rows"), classes.where(~is_hot).drop("n_rows")
    usual = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return rows.join(F.broadcast(hot), key).unionByName(usual)


def fold_of(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


def words_of(text: str) -> list[bytes]:
    return text.encode().split()


def lower_words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def text_blocks(col: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column whose texts together stay under ``max_bytes`` (or one row)."""
    size = np.diff(np.frombuffer(col.buffers()[1], dtype=np.int32, count=len(col) + 1 + col.offset)[col.offset :]) if len(col) else []
    lo, total = 0, 0
    for i, n in enumerate(size):
        if i > lo and total + n > max_bytes:
            yield lo, i
            lo, total = i, 0
        total += int(n)
    if lo < len(col):
        yield lo, len(col)


def utf8_block(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls, as NumPy views without a copy."""
    off = np.frombuffer(col.buffers()[1], dtype=np.int32, count=col.offset + len(col) + 1)[col.offset :].astype(np.int64)
    if col.buffers()[2] is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    col = batch.column(name)
    return col.cast(pa.string()) if col.type != pa.string() else col


def sum_vectors(partials: DataFrame, column: str, size: int, dtype=np.float64) -> np.ndarray:
    """Element-wise sum of one fixed-size vector (binary) per task.

    Partial sums meet pairwise on executors (``treeReduce``); the driver
    receives a single vector whose size does not depend on the data.
    """
    vectors = partials.select(column).rdd.map(lambda r: np.frombuffer(bytes(r[0]), dtype=dtype))
    if vectors.isEmpty():
        return np.zeros(size, dtype)
    return np.array(vectors.treeReduce(lambda a, b: a + b, depth=3))
