"""Token counts, conversation repair and the prefix trie against brute force; registered queries on whole tables."""

import collections
import hashlib
import heapq
import itertools
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrail.llm import convrepair, oracles, prefixtrie, queries, tokencount

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
CONV = T.StructType(
    [
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        # names that the operators use inside
        T.StructField("kind", T.StringType()), T.StructField("h", T.LongType()), T.StructField("symbol", T.LongType()), T.StructField("turns", T.StringType()),
        T.StructField("depth", T.LongType()), T.StructField("seq", T.StringType()), T.StructField("lost", T.LongType()),
    ]
)
MORE = ("k", 1, 2, "t", 3, "s", 4)


# ---- token counts


def _library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_cuts_are_safe_at_every_size():
    rnd = random.Random(1)
    alphabet = list("abcde  \n\t▁éß12中文の<s>x.!  ") + [" the ", " and", "ing", "́", "\U0001f600", "   "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(3000)] + ["", " ", "  ", "a ", " a", "\n ", "<s>"]
    want = [len(x) for x in _library().encode(texts)]
    count = tokencount.counter(MODEL)
    for size in (1, 2, 5, 17):
        assert sum(len(list(count.pieces(t, size))) for t in texts) > 2 * len(texts)
        assert count.counts(texts, size=size, call_bytes=300).tolist() == want


def test_calls_are_balanced_by_bytes():
    count = tokencount.PieceCounter(MODEL)
    sizes = []
    real = count.model

    class Spy:
        def encode(self, call, num_threads):
            sizes.append(sum(len(x) for x in call))
            return real.encode(call, num_threads=num_threads)

    count.model = Spy()
    text = "many words in a very long text " * 30_000
    got = count.counts([text, "", "short"] * 2)
    assert got.tolist() == [len(real.encode(x)) for x in (text, "", "short")] * 2
    assert len(sizes) > 5 and max(sizes) <= tokencount.CALL_BYTES + tokencount.PIECE_CHARS + 100


def test_token_counts_of_rows(spark):
    long = " ".join("w%d ü" % k for k in range(60_000))
    rows = [(1, None, 5), (2, "", 5), (2, "a b", 5), (None, "a b", 5), (2, "a b", 5), (3, long, 5), (4, "x" * 40_000, 5), (5, "\n" * 40_000, 5), (6, " " * 40_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").withColumn("batches", F.lit(1))
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in tokencount.count_tokens(docs, MODEL).collect())
    enc = _library()
    assert got == collections.Counter((i, len((t or "").encode()), len(enc.encode(t or ""))) for i, t, _ in rows)
    empty = tokencount.count_tokens(docs.limit(0), MODEL)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "n_tokens", "batches", "n_bytes"]


def test_op11_query(spark):
    got = {r.doc_id: r for r in queries.op11_token_counts(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    enc = _library()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        n = len(enc.encode(d.text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((d.text or "").encode()), n, n > 4096)


# ---- conversation repair


def _cheapest(symbols):
    """Best (cost, audit) over all edit sequences, by uniform-cost search."""
    keep = {0: {2: 1, 0: 2}, 1: {0: 2}, 2: {1: 3}, 3: {0: 2}}
    turn = {0: 2, 1: 2, 2: 3, 3: 2}
    heap, seen = [(0, "", 0, 0)], {}
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen[i, state] = cost, audit
        heapq.heappush(heap, (cost + 3, audit + "I", i, turn[state]))
        if i < len(symbols):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if symbols[i] != 8:
                extra, kind = 3 * (symbols[i] & 1), symbols[i] >> 1
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, turn[state]))
                if kind in keep[state]:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, keep[state][kind]))
    return min(seen[len(symbols), s] for s in (0, 3))


def test_run_length_program_equals_search():
    rnd = random.Random(3)
    for _ in range(1500):
        symbols = []
        while len(symbols) < rnd.randint(0, 14):
            symbols += [rnd.randrange(9)] * rnd.choice([1, 1, 2, 3, 5, 9])
        runs = [(k, len(list(g))) for k, g in itertools.groupby(symbols)]
        assert convrepair.solve(runs) == _cheapest(symbols)


def test_long_runs_take_powers():
    # 100 001 user turns: an answer after each costs 3, as a reroled turn does for two; all by 17 powers
    cost, audit = convrepair.solve([(0, 100_001)])
    assert len(audit.replace("I", "")) == 100_001 and cost == 3 * audit.count("R") + 3 * audit.count("I") + 4 * audit.count("D")
    small = convrepair.solve([(0, 101)])
    assert small == _cheapest([0] * 101)


def _repair(rows):
    """The contract, row by row."""
    crc = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        h = crc(c, t)
        convs[c]
        if h == 0:
            continue
        text = "" if h == 1 else "".join(x for x in text if x not in ".!?") if h == 2 else text
        role = "user" if h == 4 else role
        convs[c] += [(t, role, text)] * (2 if h == 3 else 1)
    out = {}
    white = " \t\n\x0b\x0c\r"
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, symbols, faults = set(), [], collections.Counter()
        for _, role, text in turns:
            core = text.strip(white)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            kind = {"u": 0, "a": 1, "s": 2}.get(role[:1], 3)
            symbols.append(8 if fault in ("blank", "duplicate") else 2 * kind + (fault == "truncated"))
        initials = [r[1][:1] for r in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = _cheapest(symbols)
        fixed, i = [], 0
        for letter in audit:
            prior = fixed[-1][0][:1] if fixed else ""
            needed = "assistant" if prior == "u" else "user"
            if letter == "I":
                fixed.append((needed, ""))
                continue
            if letter != "D":
                fixed.append((turns[i][1] if letter == "K" else needed, turns[i][2]))
            i += 1
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[c] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha)
    return out


def _check_repair(spark, rows):
    table = spark.createDataFrame([r + MORE for r in rows], CONV).repartition(3)
    got = convrepair.repair(convrepair.damaged(table)).collect()
    want = _repair(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r


def _random_conversations():
    rnd = random.Random(5)
    says = ["Hi.", "What now?", "cut off", "  ", "", "\t\n", "Yes!", "no", "An answer. ", "a.b", None]
    rows = []
    for c in range(220):
        for t in range(rnd.randint(1, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((c, t * rnd.choice([1, 1, 1, 2]), role, rnd.choice(says)))
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Yes."), (None, None, "assistant", "Yes."), (900, None, "user", "x"), (901, None, None, None)]
    rows += rows[:40]                                                     # repeated rows
    rows += [(910, t, "user", "Same.") for t in range(700)]               # one long conversation of few symbols
    rows += [(911, t, ("user", "assistant")[t % 2], f"Turn {t} " + "long text. " * 3000) for t in range(6)]
    return rows


def test_repair_equals_the_contract(spark):
    _check_repair(spark, _random_conversations())


def test_repair_of_nothing(spark):
    out = convrepair.repair(convrepair.damaged(spark.createDataFrame([], CONV)))
    assert out.count() == 0
    # every row of the conversation is lost: zeros, no audit, the hash of nothing
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:7".encode()) % 20 == 0)
    _check_repair(spark, [(gone, 7, "user", "Hi.")])


def test_op12_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = _repair(rows)
    got = queries.op12_conversation_repair(spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


# ---- prefix trie


def _trie(convs):
    """Every node by a dictionary of prefixes; ``convs``: id -> list of (role, text)."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for prefix, ids in members.items():
        sub = [p for p in members if p[: len(prefix)] == prefix]
        childless = [p for p in sub if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in sub)]
        ends = sorted(c for c in ids if len(convs[c]) == len(prefix))
        out.append((
            min(ids), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(ids), sum(len(p) == len(prefix) + 1 for p in sub), len(childless),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in sub if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return collections.Counter(out)


def _rebuilt(rows):
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = [(r, x) for _, r, x in own.get(c - c % 100, [])[:h] + turns[h:]]
    return out


def _trie_rows():
    rnd = random.Random(6)
    rows = []
    for c in list(range(100, 180)) + list(range(230, 260)) + [0, 5, 300, 399]:
        for t in range(rnd.randint(1, 8)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bb", "ü", "", None])))
    rows += [(c, t, "user", "copied turn") for c in range(400, 440) for t in range(3)]      # one large group of copies
    rows += [(500, None, "user", "x"), (500, None, "user", "x"), (501, 1, "user", "long " * 20_000), (None, 1, "user", "no id")]
    rows += rows[:30]
    return rows


@pytest.mark.parametrize("block", [1, 7, 60, 200_000])
@pytest.mark.parametrize("tasks", [1, 5])
def test_trie_equals_dictionary(spark, monkeypatch, block, tasks):
    rows = _trie_rows()
    table = spark.createDataFrame([r + MORE for r in rows], CONV).repartition(3)
    monkeypatch.setattr(prefixtrie, "_blocks", _blocks_of(block))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collections.Counter(tuple(r) for r in prefixtrie.trie(prefixtrie.rebuilt(table)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == _trie(_rebuilt(rows))


def _blocks_of(size):
    """Blocks of another size (the module's constant doesn't reach the workers)."""

    def blocks(batches):
        block, turns = [], 0
        for batch in batches:
            for conv, seq, chars in zip(*(c.to_pylist() for c in batch.columns)):
                block.append(prefixtrie.Row(conv, seq, chars))
                turns += len(chars) + 1
                if turns >= size:
                    yield block
                    block, turns = [], 0
        if block:
            yield block

    return blocks


def test_block_nodes_equal_dictionary():
    rnd = random.Random(9)
    for n in (1, 2, 5, 40):
        convs = {c: [("u", rnd.choice("abc") * rnd.randint(1, 2)) for _ in range(rnd.randint(0, 5))] for c in range(n)}
        code = lambda turns: "".join(hashlib.md5(x[1].encode()).hexdigest() for x in turns)
        rows = [prefixtrie.Row(c, s, [len(x[1]) for x in convs[c]]) for s, c in sorted((code(t), c) for c, t in convs.items())]
        out = prefixtrie.block_nodes(rows, prefixtrie.UNKNOWN, prefixtrie.UNKNOWN)
        names = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved")
        got = collections.Counter(zip(*(out[k].tolist() for k in names)))
        want = collections.Counter({(i, d, n, k, leaves, saved): v for (i, d, _, n, k, leaves, saved, _), v in _trie(convs).items()})
        assert got == want


def test_reach_equals_scan():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50):
        lcp = rng.integers(0, 4, n)
        lcp[0] = -1
        table = prefixtrie.sparse_minima(lcp)
        at, depth = np.repeat(np.arange(n), 4), np.tile(np.arange(4), n)
        right, left = prefixtrie.reach_right(table, at, depth), prefixtrie.reach_left(table, at, depth)
        for i, d, r, lo in zip(at, depth, right, left):
            want = i
            while want + 1 < n and lcp[want + 1] >= d:
                want += 1
            assert r == want
            want = i
            while lcp[want] >= d:
                want -= 1
            assert lo == want


def test_trie_of_nothing(spark):
    assert prefixtrie.trie(prefixtrie.rebuilt(spark.createDataFrame([], CONV))).count() == 0


def test_op13_query(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    got = collections.Counter(tuple(r) for r in queries.op13_prefix_trie(spark, SF).collect())
    assert got == _trie(_rebuilt(rows))


# ---- the SQL statements


def _duck(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return con


def test_sql_equals_brute_force():
    rows = [r for r in _random_conversations() if r[0] != 911]
    got = _duck(rows).sql(oracles.OP12).fetchall()
    assert {r[0]: r[1:] for r in got} == _repair(rows)
    rows = [r for r in _trie_rows() if r[0] != 501]
    assert collections.Counter(_duck(rows).sql(oracles.OP13).fetchall()) == _trie(_rebuilt(rows))


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_prefix_trie"])
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf)
    assert got.columns == want.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want.fetchall())
