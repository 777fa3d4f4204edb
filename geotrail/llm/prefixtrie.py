"""Trie of conversation prefixes from sorted sequences, their LCPs and range minima.

Every conversation is the sequence of its turns (128-bit digests of role and text) and its turns' lengths. The
sequences are range-partitioned and sorted, ties by conversation id, so a group of copies or a first turn that a third
of all conversations share is spread over tasks. A task reads its sorted rows in blocks of about ``BLOCK_TURNS``
turns and computes the longest common prefix (LCP) of neighbours and a sparse table of its range minima. A
prefix of row ``i`` that is longer than ``LCP[i]`` is a candidate: it occurs here first. Each candidate
finds its member interval by itself: two binary searches over the sparse table, to the left and to the right, as far
as the minimum stays at or above the prefix length. No stack, no order between candidates.

All that a node reports is a sum or a minimum over its members, so the partial nodes of blocks and tasks merge in one
aggregate keyed by the prefix digest:

* members: 1 per row; smallest id: the minimum;
* children: a row with ``LCP[i] <= depth < length`` opens one;
* leaves: a row whose successor doesn't continue its whole sequence (``LCP[i + 1] < length``) ends one;
* saved tokens, the sum over the subtree of ``(members - 1) * chars``: what the members hold below the node's
  parent, less what the nodes of the subtree hold; a node belongs to the first row that has it.

Only at the border of two tasks is the neighbour unknown. Each task sends its first and last sequence; the LCP at
each border gives corrections for the nodes both sides share, which enter the same aggregate.

Ids of the conversations that end in a node reach its hash as runs of consecutive ids, streamed in order.
A task holds one block; a conversation's digests (32 hex digits a turn) are one value.

Turns are ordered by turn (null first; ties by digest); null role or text is empty; rows without ``conv_id``
are ignored; repeated rows are turns of their own. Very long texts are digested whole in their row and
not moved. Other columns, whatever their names, are ignored. An empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from geotrail.llm.common import join_classes, materialize, small_batches

HEAD_TURNS = 5          # Fixed value of the contract: at most so many turns come from the group's first conversation
GROUP = 100             # Fixed value: conversations c - c % GROUP .. c share that first one
BLOCK_TURNS = 200_000   # turns of one block: bounds a task's memory
UNKNOWN = -1            # LCP with a neighbour that another task holds


# ---- one block of sorted sequences


def sparse_minima(values: np.ndarray) -> list[np.ndarray]:
    """Table ``t``: ``t[k][i]`` is the minimum of ``values[i : i + 2 ** k]``."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half, last = 1 << (len(table) - 1), table[-1]
        table.append(np.minimum(last[:-half], last[half:]))
    return table


def reach_right(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Largest ``r`` per candidate with all of ``lcp[at + 1 .. r]`` at least ``depth``."""
    r = at.copy()
    for k in range(len(table) - 1, -1, -1):
        start = r + 1
        fits = start + (1 << k) <= len(table[0])
        low = table[k][np.where(fits, start, 0)]
        r = np.where(fits & (low >= depth), r + (1 << k), r)
    return r


def reach_left(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Smallest ``l`` per candidate with all of ``lcp[l + 1 .. at]`` at least ``depth``."""
    left = at.copy()
    for k in range(len(table) - 1, -1, -1):
        start = left - (1 << k) + 1
        fits = start >= 0
        low = table[k][np.where(fits, start, 0)]
        left = np.where(fits & (low >= depth), left - (1 << k), left)
    return left


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads digests so that sums of them tell sequences apart."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_keys(symbols: np.ndarray) -> np.ndarray:
    """Two 64-bit keys of every prefix (the empty one first) of one sequence of ``(n, 2)`` turn digests."""
    with np.errstate(over="ignore"):
        place = np.arange(1, len(symbols) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        other = symbols[:, ::-1] ^ np.array([0, 0xA5A5A5A5A5A5A5A5], np.uint64)
        return np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(_mixed(_mixed(symbols + place[:, None]) ^ other), axis=0, dtype=np.uint64)])


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = (a[:n] != b[:n]).any(axis=1)
    return int(differ.argmax()) if differ.any() else n


def _suffix_sums(chars: np.ndarray) -> np.ndarray:
    """Characters from each place on; one more than there are places (0 at the end)."""
    return np.append(np.cumsum(chars[::-1])[::-1], 0)


NODE = pa.schema(
    [(n, pa.int64()) for n in ("k1", "k2", "p1", "p2", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved")]
    + [("kind", pa.int32()), ("ids", pa.string()), ("piece", pa.int64()), ("seq", pa.string()), ("chars", pa.list_(pa.int64()))]
)
NODE_DDL = (
    "k1 long, k2 long, p1 long, p2 long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long,"
    " kind int, ids string, piece long, seq string, chars array<bigint>"
)
#: kinds of rows: a partial node, a run of ids that end in a node, the first and the last sequence of a task
PARTIAL, ENDS, FIRST, LAST = range(4)


class Row:
    """One conversation: id, turn digests, characters per turn."""

    __slots__ = ("conv", "symbols", "chars")

    def __init__(self, conv: int, seq: str, chars: list[int]):
        self.conv = conv
        self.symbols = np.frombuffer(bytes.fromhex(seq), dtype=">u8").astype(np.uint64).reshape(-1, 2)
        self.chars = np.array(chars, np.int64)


def block_nodes(rows: list[Row], before: int, after: int) -> dict[str, np.ndarray]:
    """Partial nodes of one block. ``before`` / ``after``: LCP of its first / last row with the neighbour in the task.

    A node is listed if any row of the block is a member; ownership (children, leaves,
    what a node holds itself) follows the true LCPs.
    """
    size = np.array([len(r.symbols) for r in rows])
    n = len(rows)
    lcp = np.array([before] + [common_prefix(a.symbols, b.symbols) for a, b in zip(rows, rows[1:])])
    nxt = np.append(lcp[1:], after)
    # inside the block the first row is preceded by nothing: every prefix of it is a candidate
    inner = lcp.copy()
    inner[0] = -1
    table = sparse_minima(inner)
    n_new = size - inner
    at = np.repeat(np.arange(n), n_new)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(n_new) - n_new, n_new) + np.repeat(inner, n_new) + 1
    left, right = reach_left(table, at, depth), reach_right(table, at, depth)

    # cells (row, depth), a row after the other: what each member adds to the node of that depth
    cells = size + 1
    start = np.cumsum(cells) - cells
    row = np.repeat(np.arange(n), cells)
    d = np.arange(len(row)) - np.repeat(start, cells)
    tail = np.concatenate([_suffix_sums(r.chars) for r in rows])          # characters of turns after depth d
    held = tail[np.repeat(start, cells) + np.maximum(d - 1, 0)]             # ... of turn d and after (root: all)
    owned = tail[np.repeat(start, cells) + np.maximum(np.maximum(d - 1, 0), lcp[row])]
    add = np.stack([np.ones(len(row), np.int64), (lcp[row] <= d) & (d < size[row]), nxt[row] < size[row], held - owned], axis=1).astype(np.int64)
    # members of a node are consecutive among the cells of its depth
    order = np.lexsort((row, d))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    lo = place[start[left] + depth]
    hi = place[start[right] + depth] + 1
    sums = np.concatenate([np.zeros((1, add.shape[1]), np.int64), np.cumsum(add[order], axis=0)])
    totals = sums[hi] - sums[lo]
    ids = np.array([r.conv for r in rows], np.int64)[row[order]]
    bounds = np.stack([lo, hi], axis=1).ravel()
    least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), bounds)[::2]
    keys = np.concatenate([prefix_keys(r.symbols) for r in rows]).view(np.int64)
    own = start[at] + depth
    parent = own - (depth > 0)
    return {
        "k1": keys[own, 0], "k2": keys[own, 1], "p1": keys[parent, 0], "p2": keys[parent, 1], "depth": depth, "conv_id": least,
        "n_convs": totals[:, 0], "n_children": totals[:, 1], "n_leaves": totals[:, 2], "saved": totals[:, 3],
    }


def _batch(kind: int, columns: dict, n: int) -> pa.RecordBatch:
    columns = {"kind": np.full(n, kind, np.int32), **columns}
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in NODE]
    return pa.RecordBatch.from_arrays(arrays, schema=NODE)


def _end_runs(rows: list[Row]) -> pa.RecordBatch:
    """Ids of equal sequences in a row (they are sorted) as one text per node."""
    runs: list[tuple] = []
    for i, r in enumerate(rows):
        if i and len(r.symbols) == len(rows[i - 1].symbols) and (r.symbols == rows[i - 1].symbols).all():
            runs[-1][-1].append(r.conv)
        else:
            k = prefix_keys(r.symbols)[-1].view(np.int64)
            runs.append((int(k[0]), int(k[1]), len(r.symbols), [r.conv]))
    k1, k2, depth, ids = zip(*runs)
    texts = [",".join(map(str, x)) for x in ids]
    return _batch(ENDS, {"k1": k1, "k2": k2, "depth": depth, "conv_id": [x[0] for x in ids], "ids": texts}, len(runs))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Row]]:
    block, turns = [], 0
    for batch in batches:
        for conv, seq, chars in zip(*(c.to_pylist() for c in batch.columns)):
            block.append(Row(conv, seq, chars))
            turns += len(chars) + 1
            if turns >= BLOCK_TURNS:
                yield block
                block, turns = [], 0
    if block:
        yield block


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of one task's sorted sequences; a block is worked on once the row after it is known."""
    piece = TaskContext.get().partitionId()

    def end(kind: int, r: Row) -> pa.RecordBatch:
        return _batch(kind, {"piece": [piece], "seq": [r.symbols.astype(">u8").tobytes().hex()], "chars": [r.chars.tolist()]}, 1)

    held, before = None, UNKNOWN
    for block in _blocks(batches):
        if held is None:
            yield end(FIRST, block[0])
        else:
            after = common_prefix(held[-1].symbols, block[0].symbols)
            yield from _block_rows(held, before, after)
            before = after
        held = block
    if held is not None:
        yield from _block_rows(held, before, UNKNOWN)
        yield end(LAST, held[-1])


def _block_rows(rows: list[Row], before: int, after: int) -> Iterator[pa.RecordBatch]:
    nodes = block_nodes(rows, before, after)
    yield _batch(PARTIAL, nodes, len(nodes["k1"]))
    yield _end_runs(rows)


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the tasks on both sides of a border counted twice, for the nodes that both sides have."""
    for batch in batches:
        for last, seq, chars in zip(*(c.to_pylist() for c in batch.columns)):
            e, f = Row(0, last, []), Row(0, seq, chars)
            shared = common_prefix(e.symbols, f.symbols)
            depth = np.arange(shared + 1)
            keys = prefix_keys(f.symbols).view(np.int64)[: shared + 1]
            parents = keys[np.maximum(depth - 1, 0)]
            tail = _suffix_sums(f.chars)
            zero = np.zeros(shared + 1, np.int64)
            columns = {
                "k1": keys[:, 0], "k2": keys[:, 1], "p1": parents[:, 0], "p2": parents[:, 1], "depth": depth, "n_convs": zero,
                "n_children": -(depth < shared).astype(np.int64),
                "n_leaves": zero - int(shared == len(e.symbols)),
                "saved": tail[np.maximum(depth - 1, 0)] - tail[shared],
            }
            yield _batch(PARTIAL, columns, shared + 1)


ENDS_DDL = "k1 long, k2 long, depth long, ends_sha256 string"
ENDS_SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids, sorted by node and first id -> one hash per node."""
    node, sha = None, None
    for batch in batches:
        done = []
        for k1, k2, depth, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2, depth) != node:
                if node is not None:
                    done.append((*node, sha.hexdigest()))
                node, sha = (k1, k2, depth), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), ENDS_SCHEMA.types)], schema=ENDS_SCHEMA)
    if node is not None:
        row = (*node, sha.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, ENDS_SCHEMA.types)], schema=ENDS_SCHEMA)


# ---- the tables


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``seq`` (the turns' digests, joined) and ``chars`` (code points per turn) of every conversation."""
    empty = F.lit("")
    role, text = F.coalesce(F.col("role").cast("string"), empty), F.coalesce(F.col("text").cast("string"), empty)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("h"),
        F.char_length(text).cast("long").alias("n"),
    )
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations that open with turns of their group's first one: ``conv_id, turns``."""
    own = sequences(conversations)
    first = F.col("conv_id") % GROUP
    heads = own.where(first == 0).select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, HEAD_TURNS).alias("head"))
    c = own.withColumn("first_id", F.col("conv_id") - first).join(heads, "first_id", "left")
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_TURNS + 1)).cast("int")
    head = F.slice(F.coalesce(F.col("head"), F.slice("turns", 1, 0)), F.lit(1), n)
    return c.select("conv_id", F.concat(head, F.slice("turns", n + 1, F.size("turns"))).alias("turns"))


KEY = ["k1", "k2", "depth"]


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over ``conversations`` (``conv_id``, ``turns``: array of structs with digest ``h`` and length ``n``)."""
    spark = conversations.sparkSession
    small_batches(spark)
    rows = conversations.select(
        "conv_id", F.array_join(F.transform("turns", lambda x: x["h"]), "").alias("seq"), F.transform("turns", lambda x: x["n"]).alias("chars")
    )
    ordered = rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = materialize(ordered.mapInArrow(_partials, NODE_DDL), "trie_parts")

    pieces = parts.where(F.col("kind").isin(FIRST, LAST)).groupBy("piece").agg(
        F.max(F.when(F.col("kind") == LAST, F.col("seq"))).alias("last"),
        F.max(F.when(F.col("kind") == FIRST, F.struct("seq", "chars"))).alias("first"),
    )
    following = F.lead("first").over(Window.orderBy("piece"))  # one row per task of the sort
    borders = pieces.select("last", following.alias("f")).where(F.col("f").isNotNull()).select("last", "f.seq", "f.chars")
    partial = parts.where(F.col("kind") == PARTIAL).unionByName(borders.mapInArrow(_corrections, NODE_DDL))
    nodes = partial.groupBy(*KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        *[F.sum(n).cast("long").alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    nodes = materialize(nodes, "trie_nodes")

    name = lambda a, b, depth: F.concat_ws(":", F.col(a), F.col(b), depth)
    parents = nodes.where(F.col("n_children") > 0).select(
        name("k1", "k2", F.col("depth")).alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_rows")
    )
    below = nodes.where(F.col("depth") > 0).withColumn("parent", name("p1", "p2", F.col("depth") - 1))
    root = nodes.where(F.col("depth") == 0).withColumn("parent_conv_id", F.lit(None).cast("long"))
    full = join_classes(below, parents, "parent").drop("parent").unionByName(root)

    runs = parts.where(F.col("kind") == ENDS).select(*KEY, "ids", "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    ends = runs.select(*KEY, "ids").mapInArrow(_hashed, ENDS_DDL)
    return full.join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce(F.col("ends_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
