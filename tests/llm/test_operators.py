"""Each operator's query logic against brute force, with nulls, empty and long texts, ties, repeats and extra columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrail.llm import bpe, common, contextmix, decontaminate, graph, htmltext, langid, planes, quality, rules, simhash, suffixdedup, wordcache
from geotrail.llm.common import fold_of
from geotrail.llm.runindex import RunLengthIndex

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("word", T.StringType()), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("score", T.LongType()),
    ]
)
EN = "the cat and the dog were in the house with a very old man that sang for them all day".split()
DE = "der hund und die katze waren mit dem alten mann in dem haus und sangen den ganzen tag".split()


def _texts() -> list[tuple]:
    rnd = random.Random(4)
    say = lambda words, n: " ".join(rnd.choice(words) for _ in range(n)).capitalize() + "."
    shared = say(EN, 60)
    docs = [
        (1, say(EN, 80), "en"), (2, say(DE, 80), "de"), (3, None, "en"), (4, "", None), (5, "  \n\t ", "de"), (6, "12 !?", "en"),
        (7, shared + "\n" + say(EN, 30), "en"), (8, say(EN, 40) + "\n" + shared, "en"), (9, say(DE, 4000), "de"), (9, "same id", "en"),
        (None, "no id at all", "en"), (11, "la la " * 200, "en"), (12, "x" * 700, None), (13, say(EN, 90), "en"), (13, None, None),
    ]
    docs += [docs[0], docs[0]]
    for k in range(20, 60):
        docs.append((k, say(EN if k % 2 else DE, 70), "en" if k % 2 else "de"))
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, "s", len(t or ""), "w", 1, 2, 3) for i, t, lang in _texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def _encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_token_files_round_trip(spark, docs, empty):
    tok = _encoder()
    order = sorted(((i, t or "") for i, t, _ in _texts()), key=lambda x: (x[0] is not None, x[0] or 0))
    got = planes.token_file_digest(spark, docs, PATH, 2, block_ids=64).orderBy("start").collect()
    want = [(i, tok.encode(t, add_special_tokens=False).ids + [2]) for i, t in order]
    assert [r.doc_id for r in got] == [i for i, _ in want]
    at, mine = 0, collections.Counter()
    for r in got:
        assert r.start == at
        at += r.n_tokens
        mine[r.doc_id, r.n_tokens, r.ids_crc32] += 1
    assert mine == collections.Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    assert planes.token_file_digest(spark, empty, PATH, 2).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_transpose(kind):
    ids = np.random.default_rng(1).integers(0, 2**32, 1001, dtype=np.uint64).astype(np.uint32)
    assert (planes.from_planes(planes.to_planes(ids, kind), len(ids)) == ids).all()


def test_cgk_lsh_recall_and_precision(spark, empty):
    rnd = random.Random(8)
    vocab = ["w%d" % k for k in range(400)] + ["the", "of", "and"] * 60
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(15, 60)))) for k in range(60)]
    docs, planted = [], set()
    for k, (i, t) in enumerate(items):
        words = t.split()
        for _ in range(int(0.2 * len(words)) if k % 3 else 0):
            at = rnd.randrange(len(words))
            words[at : at + 1] = rnd.choice([[], ["new%d" % rnd.randrange(99)], [words[at], "extra"]])
            words = words or ["x"]
        if decontaminate.best_distance(t.split(), words, int(0.2 * len(t.split()))) is None:
            continue
        lead = [rnd.choice(vocab) for _ in range(rnd.randint(0, 200))]
        docs.append((k, " ".join(lead).upper() + "\n" + " ".join(words) + "!! " + " ".join(lead)))
        planted.add((k, i))
    docs += [(1000 + k, " ".join(rnd.choice(vocab) for _ in range(300))) for k in range(50)] + [(2000, None), (2001, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items + [(900, None), (901, "?!")], "item_id long, text string")
    found = decontaminate.contaminated(d, b).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert len(planted & pairs) >= 0.95 * len(planted)
    assert all(r.distance <= int(0.2 * r.item_words) for r in found) and not any(i >= 1000 for i, _ in pairs)
    assert {r.doc_id for r in decontaminate.clean(d, b).collect()} == {i for i, _ in docs} - {i for i, _ in pairs}
    assert decontaminate.contaminated(empty, b).count() == 0 and decontaminate.contaminated(d, empty.withColumnRenamed("doc_id", "item_id")).count() == 0


@pytest.mark.parametrize("n", [5, 9, 40, 60, 150, 400])
@pytest.mark.parametrize("kind", ["delete", "insert", "substitute"])
def test_one_sided_edits_at_the_limit_are_found(n, kind):
    rnd = random.Random(n)
    items = [(k, ["w%d" % rnd.randrange(5000) for _ in range(n)]) for k in range(30)]
    index = decontaminate.ItemIndex([(k, " ".join(w)) for k, w in items])
    texts = []
    for _, words in items:
        cut = set(rnd.sample(range(n), n // 5))
        edit = {"delete": lambda w: [], "insert": lambda w: [w, "new%d" % rnd.randrange(99)], "substitute": lambda w: ["new%d" % rnd.randrange(99)]}[kind]
        lead = ["x%d" % rnd.randrange(900) for _ in range(50)]
        texts.append(" ".join([*lead, *(y for o, w in enumerate(words) for y in (edit(w) if o in cut else [w])), *lead]))
    found = [{index.ids[i] for i, _ in x} for x in index.match(texts)]
    assert sum(k in x for (k, _), x in zip(items, found)) >= 0.9 * len(items)
    assert all(x <= {k} for (k, _), x in zip(items, found))


def test_words_are_cut_at_marks_and_unspaced_characters():
    words = lambda t: [w.decode() for w in decontaminate.normal_words(t)]
    assert words("“Où”—là… café") == ["où", "là", "café"]
    assert words("中文。ab") == ["中", "文", "ab"]
    index = decontaminate.ItemIndex([(1, "我们今天去公园看花")])
    assert index.match(["他说：“我们今天去公园看花”。", "没有"]) == [[(0, 0)], []]


def test_edit_distance_brute_force():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]

    rnd = random.Random(2)
    for _ in range(100):
        a, b = [rnd.randrange(4) for _ in range(rnd.randint(1, 7))], [rnd.randrange(4) for _ in range(rnd.randint(0, 9))]
        best = min(plain(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        for limit in range(4):
            assert decontaminate.best_distance(a, b, limit) == (best if best <= limit else None)


def test_quality_learns_and_handles_edges(spark, docs, empty):
    rnd = random.Random(3)
    good = [(k, " ".join(rnd.choice(EN) for _ in range(60)) + ".") for k in range(100, 400)]
    bad = [(k, " ".join(rnd.choice(EN) + "###" for _ in range(60))) for k in range(400, 600)]
    d = spark.createDataFrame(good + bad + [(i, t) for i, t, _ in _texts()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (7777, 0), (100, None)], "doc_id long, quality int")
    got = quality.classify(d, labels, lambda c: fold_of(c, 5) == 0).collect()
    assert len(got) == 500 + len(_texts()) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id and 100 <= r.doc_id < 600]
    assert len(held) > 40 and all((r.score >= 0.5) == (r.doc_id < 400) for r in held)
    assert all(r.score == 0.5 for r in quality.classify(d, labels.limit(0), lambda c: fold_of(c, 5) == 0).collect())
    assert quality.classify(empty, labels, lambda c: fold_of(c, 5) == 0).count() == 0


def test_isotonic_is_monotone_and_exact():
    assert quality.isotonic(np.arange(5), np.array([1, 3, 2, 2, 5.0]), np.ones(5)).tolist() == pytest.approx([1, 7 / 3, 7 / 3, 7 / 3, 5])


def test_language(spark, docs, empty):
    model = langid.fit(docs, train=fold_of(F.col("doc_id"), 3) != 1)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(_texts())
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.lang_pred)
    assert all(by[k] == {"en" if k % 2 else "de"} for k in range(20, 60))
    assert by[3] == by[4] == by[5] == by[6] == {"und"} and "und" in by[13]
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_rule_statistics_and_verdict(spark, docs, empty):
    def brute(x):
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if grams[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
        lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(covered)

    odd = ["a b c a b c", "a a a a", "a b a b a b", "é ü # a\n\n x\nx\n x", "|||\n|||"]
    d = docs.select("doc_id", "text").union(spark.createDataFrame([(500 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    got = rules.text_stats(d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = collections.Counter((i, *brute(t or "")) for i, t in [(i, t) for i, t, _ in _texts()] + [(500 + k, t) for k, t in enumerate(odd)])
    assert _rows(got) == want
    assert rules.text_stats(empty).count() == 0
    # a learned list drops what the labels call bad and nothing else
    rnd = random.Random(6)
    good = [(k, " ".join(rnd.choice(EN) + str(rnd.randrange(50)) for _ in range(80))) for k in range(1000, 1300)]
    bad = [(k, " ".join(rnd.choice(EN) + str(rnd.randrange(50)) + "!!" for _ in range(80))) for k in range(1300, 1500)]
    t = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1300)) for i, _ in good + bad] + [(None, 0), (1000, None)], "doc_id long, quality int")
    out = rules.apply_rules(t, labels, lambda c: F.lit(True)).collect()
    assert all(r.kept == (r.doc_id < 1300) for r in out)
    assert all(r.kept for r in rules.apply_rules(t, labels.limit(0), lambda c: F.lit(True)).collect())


PAGE = """<html><head><title>No</title><script>var a="</p>";</script><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>
<div class="ad">Buy the thing of the day and be happy with it for all that is</div><article><header>Head</header><h1>Title  here</h1>
<p>One &amp; two<b>three</b>
 four.<p>Short.<aside>side</aside><div id=comments><p>The reader said that this is the best of all</div></article><footer>&copy; foot</footer>"""


def test_main_text(spark, empty):
    assert htmltext.extract(PAGE) == "Title here\nOne & twothree four.\nShort."
    long = "<p>" + "the man and the dog were in a house of the king " * 6 + "</p>"
    plain = f"<div>{long}<p>So it was.</p>{long}</div><div><a href=a>one</a> <a href=b>two</a></div>"
    assert htmltext.extract(plain).split("\n")[1] == "So it was." and "two" not in htmltext.extract(plain)
    for odd in (None, "", "<", "<p", "a < b", "<!-- x", "<script>x", "</div></p>", "<p title='a>b\">x</p>"):
        assert isinstance(htmltext.extract(odd), str)
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None)], "page_id long, url string, html string")
    got = htmltext.extract_pages(pages).collect()
    assert [(r.page_id, r.n_chars) for r in got] == [(1, 42), (1, 42), (None, 0)] or sorted(r.n_chars for r in got) == sorted([0, *[len(htmltext.extract(PAGE))] * 2])
    assert htmltext.extract_pages(pages.limit(0)).count() == 0


def _components(fps, bits):
    ids, root = sorted(fps), {}
    for a in ids:
        root[a] = a

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for x in ids:
        for y in ids:
            if x < y and bin((fps[x] ^ fps[y]) & (2**64 - 1)).count("1") <= bits:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {x: find(x) for x in ids}


def test_simhash(spark, docs, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(_texts())
    rows = [(i, simhash.fingerprint(t or "")) for i, t, _ in _texts()]
    low = {}
    for i, fp in rows:
        low[fp] = min(x for x in (low.get(fp), i) if x is not None) if (low.get(fp) is not None or i is not None) else None
    groups = _components({k: fp for k, fp in enumerate(low)}, 3)
    best = collections.defaultdict(list)
    for k, fp in enumerate(low):
        if low[fp] is not None:
            best[groups[k]].append(low[fp])
    want = {fp: min(best[groups[k]], default=None) for k, fp in enumerate(low)}
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == collections.Counter((i, f"{fp:016x}", want[fp]) for i, fp in rows)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 3, 4])
def test_pigeonhole_finds_every_pair(spark, parts, monkeypatch):
    if parts == 1:
        pytest.skip("one part probes every mask of three bits: too many rows for a unit test")
    rng = np.random.default_rng(parts)
    seeds = rng.integers(0, 2**63, 40, dtype=np.int64)
    fps = set(seeds.tolist())
    for s in seeds:
        for _ in range(4):
            m = 0
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                m |= 1 << int(b)
            v = (int(s) ^ m) & (2**64 - 1)
            fps.add(v - 2**64 if v >= 2**63 else v)
    monkeypatch.setattr(simhash, "parts_for", lambda n, k: parts)
    got = {(r.a, r.b) for r in simhash.link_distinct(spark.createDataFrame([(f,) for f in fps], "fp long"), 3).collect()}
    want = {(max(a, b), min(a, b)) for a in fps for b in fps if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert got == want


@pytest.mark.parametrize("hot_keys", [1, 4, 1024])
def test_classes_reach_hot_and_rare_keys(spark, hot_keys, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    rows = [(i, 0 if i % 3 else i) for i in range(90)]
    classes = spark.createDataFrame([(k, -k, sum(r[1] == k for r in rows)) for k in {r[1] for r in rows}], "k long, c long, n_rows long")
    got = common.join_classes(spark.createDataFrame(rows, "i long, k long"), classes, "k")
    assert sorted((r.i, r.k, r.c) for r in got.collect()) == [(i, k, -k) for i, k in rows]
    none = common.join_classes(spark.createDataFrame([], "i long, k long"), classes.limit(0), "k")
    assert none.count() == 0 and none.columns == ["k", "i", "c"]


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (1, 0)]
    got = {(r.node, r.root) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(61)} | {(k, 1000) for k in range(1000, 1100)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_base_score_and_model(spark, docs, empty):
    held = fold_of(F.col("doc_id"), 5) == 1
    out = contextmix.score_documents(docs, held).collect()
    count = collections.Counter()
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    crc = lambda i: zlib.crc32(("" if i is None else str(i)).encode())
    for i, t, _ in _texts():
        if crc(i) % 5 != 1:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    want = collections.Counter(
        (i, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6))
        for i, t, _ in _texts()
    )
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    long = [r for r in out if r.n_tokens > 50]
    assert sum(r.score for r in long) > sum(r.base_score for r in long)
    assert contextmix.score_documents(empty, held).count() == 0


def test_mix_predicts_every_core_by_occurrence(spark, monkeypatch):
    rnd = random.Random(5)
    words = ["w" + "".join(rnd.choice("abcde") for _ in range(4)) for _ in range(300)]
    rows = [(0, "the", 5000)] + [(0, w, rnd.randint(1, 9)) for w in sorted(set(words))]
    counts = spark.createDataFrame([(0, z, w, c) for z, w, c in rows] + [(1, 7, "", 9)], "kind int, cls int, item string, c long")
    tuned = []
    monkeypatch.setattr(contextmix, "TRAIN_CORES", 100)
    plain = contextmix.averaged
    monkeypatch.setattr(contextmix, "averaged", lambda x, start: tuned.append(x) or plain(x, start))
    model = contextmix.train(counts, ["en"], np.array([1.0]))
    # frequent words go through the mix like all others, and their occurrences count
    frequent = model.core_costs([b"the"])
    assert np.allclose(frequent, model.spelled([b"the"]))
    share = 5000 / sum(c for _, _, c in rows)
    assert abs(float(frequent[0, 0]) - math.log(share)) < 0.5
    # all partitions take part in the learning, with every occurrence of every bit
    bits = sum(c * int(sum(model.code.size[b] for b in w.encode() + b" ")) for _, w, c in rows)
    assert len(tuned[0]) > 1 and sum(n.sum() for _, n in tuned[0]) % bits == 0
    total = np.zeros((2, contextmix.CONTEXTS, 1 << 16), np.float32)
    contextmix.gather_contexts(model.code, [b"the"], np.array([0]), np.array([7.0]), total, 16)
    assert total.sum() == 7 * contextmix.CONTEXTS * sum(model.code.size[b] for b in b"the ")


def test_contexts_cross_words_and_predict_ends_and_repeats(spark):
    train = [(k, "pa ko mo tu " * 8, "en") for k in range(30)] + [(k, "ha ha lo re " * 8, "en") for k in range(30, 60)]
    held = ["pa ko mo tu pa ko mo tu", "pa mo ko tu pa mo ko tu", "ha ha lo re", "ha lo re re", "pa ko mo", "pa ko mo tu"]
    rows = spark.createDataFrame(train + [(1000 + k, t, None) for k, t in enumerate(held)], "doc_id long, text string, lang string")
    got = {r.doc_id - 1000: r for r in contextmix.score_documents(rows, F.col("doc_id") >= 1000).collect()}
    # the same words in another order; a repeat of a word that repeats; an end where texts end: words alone don't tell these apart
    assert abs(got[0].base_score - got[1].base_score) < 1e-9 and got[0].score > got[1].score + 3
    assert got[2].score > got[3].score + 2
    assert got[5].score > got[4].score


def test_text_scorer_equals_every_symbol_under_every_class(monkeypatch):
    rnd = random.Random(8)
    words = [b"w" + "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 7))).encode() + rnd.choice([b"", b"", b".", b"#!"]) for _ in range(200)] + [b"||"] * 30
    texts = [" ".join(rnd.choice(words).decode() for _ in range(rnd.randint(0, 30))) for _ in range(60)] + ["", "waa waa waa \u00e9t\u00e9 WAA"]
    counter = contextmix.CorpusCounter(3)
    counter.add(texts, [k % 3 for k in range(len(texts))])
    blocks = [b for batch in counter.batches() for b in contextmix._core_blocks(batch) if b[0] != [b""]]
    code = contextmix.ByteCode(np.arange(256))
    total = np.zeros((2, contextmix.CONTEXTS, 1 << 16), np.float32)
    for block in blocks:
        contextmix.gather_contexts(code, *block, total, 16, contextmix.SEAM)
    model = contextmix.MixModel(["a", "b", "c"], np.log([0.5, 0.3, 0.2]), contextmix.packed(total[0]), contextmix.packed(total[1]), code, 16)
    model.refine = contextmix.refinement(sum(contextmix.cell_counts(model, *b, contextmix.SEAM) for b in blocks))
    want = []
    for t in texts:
        each, prev, earlier = np.zeros(3), b"", b""
        for w in [*t.encode().lower().split(), b""]:
            lead, (core, tail) = prev[-contextmix.LEAD :] + b" ", contextmix.split_word(w)
            cost = model.spelled([lead + (contextmix.seam_of(core) if w else contextmix.END)])[0].astype(float)
            if w:
                kinds = [contextmix.mark_kind(*contextmix.split_word(x)) for x in (prev, earlier)]
                state = 7 if not prev else 8 if kinds == [0, 6] else kinds[0]
                cost += model.spelled([contextmix.tail_seam(state, tail)])[0]
            if len(w) >= contextmix.SEAM:
                cost += model.spelled([w], contextmix.SEAM)[0]
            if w and w == prev:
                cost = np.logaddexp(cost, model.spelled([lead + contextmix.AGAIN])[0])
            each, prev, earlier = each + cost, w, prev
        want.append(np.logaddexp.reduce(each + model.prior))
    for class_words, memo in ((20_000, 300_000), (3, 300_000), (0, 0)):
        monkeypatch.setattr(contextmix, "CLASS_WORDS", class_words)
        monkeypatch.setattr(contextmix, "MEMO_WORDS", memo)
        monkeypatch.setattr(contextmix, "MEMO_SEAMS", memo)
        scorer, got = contextmix.TextScorer(model, words[:40], np.zeros(40)), []
        for lo in range(0, len(texts), 7):
            scorer.load(texts[lo : lo + 7])
            got += scorer.log_probabilities().tolist()
        assert np.allclose(got, want, rtol=1e-5, atol=1e-4)


def test_byte_code_is_a_prefix_code():
    code = contextmix.ByteCode(np.arange(256))
    assert abs(sum(2.0 ** -int(n) for n in code.size) - 1) < 1e-9


def test_matching_statistics():
    rnd = random.Random(3)
    for _ in range(60):
        parts = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(1, 22))) for _ in range(rnd.randint(1, 4))]
        parts.append(parts[0][2:] + b"ab" + parts[0][:9])
        index = RunLengthIndex(parts)
        stats = index.matching_statistics()
        starts = [(i, a) for i, p in enumerate(parts) for a in range(len(p))]
        for k, p in enumerate(parts):
            want = []
            for a in range(len(p)):
                best = 0
                for i, b in starts:
                    if (i, b) != (k, a):
                        n = 0
                        while a + n < len(p) and b + n < len(parts[i]) and p[a + n] == parts[i][b + n]:
                            n += 1
                        best = max(best, n)
                want.append(best)
            assert index.part_statistics(k, stats).tolist() == want


def _brute_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[k : k + length] for r in raws for k in range(len(r) - length + 1))
    out = []
    for r in raws:
        hit = np.zeros(len(r), bool)
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                hit[k : k + length] = True
        spans = int(hit[:1].sum() + (hit[1:] & ~hit[:-1]).sum())
        kept = bytes(np.frombuffer(r, np.uint8)[~hit])
        out.append((len(r), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("max_contexts", [suffixdedup.MAX_CONTEXTS, 1])
def test_repeated_bytes(spark, docs, empty, max_contexts, monkeypatch):
    """max_contexts 1: every mixed key takes the counting way."""
    plain = suffixdedup.repeated_ranges
    monkeypatch.setattr(suffixdedup, "repeated_ranges", lambda d, length: plain(d, length, max_contexts))
    rnd = random.Random(9)
    base = "".join(rnd.choice("abcdefé ") for _ in range(900))
    extra = [(200, base), (201, "x" + base[:300] + "y" + base[350:]), (202, base[100:420]), (203, "ab" * 400), (204, base[:199]), (205, base[:200])]
    d = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = [(i, t) for i, t, _ in _texts()] + extra
    want = collections.Counter((i, *x) for (i, _), x in zip(rows, _brute_repeats([t for _, t in rows], 200)))
    assert _rows(suffixdedup.dedup_digest(d)) == want
    assert suffixdedup.dedup_digest(empty).count() == 0


ODD = [
    "", "a", "<|endoftext|>x<|startoftext|> y", "don't can'T 'S's's", "H̱ ẖ İi̇ ΣΣ σΣ", "가 각",
    "é" * 50, "a" * 5000, "ab" * 20000 + " c", "!?" * 5000, "'s" * 5000, "中文" * 3000, "x\x1cy\x85z\xa0w q　r", "1234 5² ٠",
    "\U0001f600‍" * 300, "\n\t ", "<|ENDOFTEXT|>", "<|endoftext", "the <|endoftext|>",
]


def test_transducer_equals_library():
    tok, table = _encoder(), bpe.merge_table(PATH)
    rnd = random.Random(1)
    bits = ["a", "b", "th", "the", "́", "̈", " ", "'", "s", "!", "1", "É", "한", "ᅡ", "<|", "|>", "\n", "\xa0", "Σ", "Z", "İ"]
    for text in ODD + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 60))) for _ in range(150)]:
        ids = tok.encode(text, add_special_tokens=False).ids
        assert bpe.encode_text(text, table) == ids
        assert bpe.decode_ids(ids, table) == tok.decode(ids, skip_special_tokens=False)


def test_transducer_streams_in_small_pieces(monkeypatch):
    tok, table = _encoder(), bpe.merge_table(PATH)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 16)
    for text in ODD:
        assert bpe.encode_text(text, table, 5) == tok.encode(text, add_special_tokens=False).ids
    run = bpe.RunTransducer(table)
    for _ in range(3000):
        run.feed(b"erthblean")
        assert len(run.held) <= 3 * run.limit + 9      # constant memory


def test_lookahead_needs_a_proper_list():
    assert bpe.sufficient_lookahead([("a", "b"), ("ab", "c")]) == 1
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([("ab", "c"), ("a", "b")])


def test_byte_level_decoding_joins_split_characters():
    table = bpe.merge_table(PATH)
    ids = bpe.encode_text("été café \U0001f600", table)
    dec = bpe.StreamDecoder(table, byte_level=True)
    assert "".join(dec.feed([i]) for i in ids) + dec.finish() == "été café \U0001f600 "


def test_bpe_query(docs, empty):
    tok = _encoder()
    want = collections.Counter()
    for i, t, _ in _texts():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert _rows(bpe.encode_decode_digest(docs, PATH)) == want
    assert bpe.encode_decode_digest(empty, PATH).count() == 0


def test_pipeline_stages(spark, docs, empty, tmp_path):
    import corpus_pipeline as cp

    bench = spark.createDataFrame([(1, " ".join(_texts()[20][1].split()[5:40]))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()}
    ids = {i for i, _, _ in _texts()}
    assert not {3, 4, 5, 6} & kept                      # no letter
    assert _texts()[20][0] not in kept                  # holds a benchmark item
    assert {k for k in range(30, 60)} <= kept and kept <= ids
    step = docs
    for _, stage in cp.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path)).cache()
        assert step.columns == cp.COLUMNS
    for _, stage in cp.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_pipeline_keeps_a_row_of_every_component(spark):
    import corpus_pipeline as cp

    rnd = random.Random(12)
    text = lambda: " ".join("w%d" % rnd.randrange(9999) for _ in range(80))
    a, b, c, d = text(), text(), text(), text()
    rows = [(None, c), (None, d), (5, a), (5, b), (6, a), (7, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == sorted([(-1, c), (-1, d), (5, a), (5, b)])


def test_every_language_keeps_rows_at_any_size():
    for scale in (1, 10**3, 10**9):
        counts = {"en": 12 * scale, "de": 7 * scale, "fr": scale, "rare": 3, "once": 1}
        got = langid.quotas(counts, 12_000)
        assert set(got) == set(counts) and all(1 <= got[x] <= n for x, n in counts.items())
        assert got["rare"] == 3 and got["once"] == 1
        assert sum(got.values()) <= max(12_000, sum(counts.values()) if scale == 1 else 12_000)
    many = langid.quotas({f"l{i}": 10**6 for i in range(100)}, 12_000)
    assert min(many.values()) >= 30 and sum(many.values()) <= 12_000


def test_sample_of_a_huge_corpus_is_not_empty(spark, docs):
    # the counts of 20 thousand million rows: the shares stay above zero
    labelled = docs.where("lang is not null and text is not null")
    seen = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    rows = langid._sampled(docs.select("doc_id", "text", "lang"), 20, seen).groupBy("lang").count().collect()
    assert {r.lang for r in rows} == set(seen) and all(r["count"] <= max(seen.values()) for r in rows)
    huge = {x: n * 10**9 for x, n in seen.items()}
    assert min(langid.quotas(huge, 12_000).values()) > 0 and sum(langid.quotas(huge, 12_000).values()) <= 12_000


def test_language_of_one_in_a_thousand_rows_is_learned(spark):
    rnd = random.Random(11)
    say = lambda words: " ".join(rnd.choice(words) for _ in range(30))
    fi = "talo koira kissa vanha mies lauloi koko illan heille ja olivat hyvin iloisia siella".split()
    rows = [(k, say(EN if k % 2 else DE), "en" if k % 2 else "de") for k in range(6000)] + [(9000 + k, say(fi), "fi") for k in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(table, max_rows=300)
    assert model.langs == ["de", "en", "fi"]
    new = spark.createDataFrame([(1, say(fi)), (2, say(EN)), (3, say(DE))], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(new, model).collect()} == {1: "fi", 2: "en", 3: "de"}


def test_rules_by_chance():
    assert rules.by_chance(2, 0, 0.05) == pytest.approx(0.0025) and rules.by_chance(0, 5, 0.5) == 1.0
    brute = sum(math.comb(20, k) * 0.3**k * 0.7 ** (20 - k) for k in range(9, 21))
    assert rules.by_chance(9, 11, 0.3) == pytest.approx(brute)
    assert rules.by_chance(700, 700, 0.5) == pytest.approx(0.5, abs=0.02) and rules.by_chance(800, 600, 0.5) < 1e-6


def test_decision_list_is_learned_on_the_small_tables(spark):
    from geotrail.llm import queries

    for sf in ("sf0.001", "sf0.01"):
        d = f"/root/testdata/{sf}"
        out = queries.op5_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed").collect()
        bad, good = [r for r in out if r.quality == 0], [r for r in out if r.quality == 1]
        assert sum(not r.kept for r in bad) >= 0.9 * len(bad) > 0 and sum(r.kept for r in good) >= 0.95 * len(good)


def test_document_encoder_in_pieces_equals_library(monkeypatch):
    """Any piece size, open words that stream, special tokens cut apart, upper case, marks behind words."""
    tok, table = _encoder(), bpe.merge_table(PATH)
    memo = bpe._memo(PATH)
    rnd = random.Random(2)
    parts = list("abcdeXYZ  \n\t.,'éßΣ12中文<|>") + ["<|startoftext|>", "<|STARTOFTEXT|>", "Vi.", "vi.,", "it's.", " don't,", "é.", "a..", "x" * 90, "́", "\u3000"]
    for _ in range(2500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        want = tok.encode(text, add_special_tokens=False).ids
        monkeypatch.setattr(bpe, "PIECE_CHARS", rnd.choice([1, 3, 7, 1 << 16]))
        monkeypatch.setattr(bpe, "OPEN_BYTES", rnd.choice([2, 10, 4096]))
        got = b"".join(bpe.encoded(text, table, memo))
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert bpe.decode_ids(np.frombuffer(got, "<u4").tolist(), table) == tok.decode(want, skip_special_tokens=False)


def test_document_encoder_memory_is_constant():
    """A text of one word and one of many words: neither the encoder nor what it emits at once grows with the text."""
    table = bpe.merge_table(PATH)
    for unit in ("abcdefgh", "some words, in a row. "):
        encoder, most, held = bpe.DocumentEncoder(table, bpe._memo(PATH)), 0, 0
        for _ in range(40):
            piece = (unit * (bpe.PIECE_CHARS // len(unit)))[: bpe.PIECE_CHARS]
            most = max(most, len(encoder.feed(piece)))
            stream = encoder.stream
            held = max(held, len(encoder.carry) + (len(stream.raw) + len(stream.text) if stream else 0))
        assert encoder.finish() is not None and most <= 8 * bpe.PIECE_CHARS and held <= 2 * bpe.PIECE_CHARS


def test_word_memo_composes_and_stays_bounded():
    asked = []

    def encode_new(words):
        asked.extend(words)
        return [w + b"|" for w in words]

    memo = wordcache.WordMemo(encode_new, max_words=50)
    got = memo.lookup({b"word.", b"word", b"x,", b"9.", b"a.."})
    assert got.items() >= {b"word.": b"word|.|", b"word": b"word|", b"x,": b"x|,|", b"9.": b"9.|", b"a..": b"a..|"}.items()
    assert sorted(asked) == sorted([b"word", b"x", b"9.", b"a..", *[bytes([t]) for t in wordcache.TAILS]])
    for k in range(500):
        memo.lookup({b"w%d" % k})
    assert len(memo.young) + len(memo.old) <= 2 * 50 + 2
    assert wordcache.folded(b"AbC <|X|>") == b"AbC <|X|>" and wordcache.folded(b"AbC") == b"abc"


def test_word_table_asks_once_for_each_part_and_stays_bounded():
    """Op 1's cost is in the words asked of the library: marks behind letters are not asked with every word, nor is a word twice."""
    from geotrail.llm import wordtable

    asked = []

    def encode_new(words):
        asked.extend(words.to_pylist())
        return wordtable.ragged([np.frombuffer(w.encode(), np.uint8).astype("<u4").tobytes() for w in words.to_pylist()])

    table = wordtable.WordTable(encode_new, max_words=50)
    text = "word word. WORD, wörd### x9. a.b. it's ### . end."
    for _ in range(3):
        (got, sizes), = wordtable.encode_column(pa.array([text, "", " word. "]), table, 2)
        want = [[*b"".join(t.encode().lower().split()), 2] for t in (text, "", "word.")]
        assert got.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
    assert sorted(asked) == sorted(["word", ".", ",", "wörd", "###", "x9.", "a.b.", "it's", "end"])
    for k in range(0, 500, 20):
        ids, _ = wordtable.encode_words(pa.array([f"w{i}" for i in range(k, k + 20)] + ["y" * 65]), table)
        assert ids.tolist() == list("".join(f"w{i}" for i in range(k, k + 20)).encode() + b"y" * 65)
        assert len(table.words) <= 50 and len(table.used) == len(table.ragged[1]) - 1 == len(table.words)
    assert "y" * 65 not in table.words.to_pylist() and table.words[0].as_py() == ""


def test_word_table_equals_the_library(monkeypatch):
    from geotrail.llm import wordtable

    rnd = random.Random(11)
    parts = [*"abcZ  \t\n.,!?'#<|>-_0129\x00\x1c\x85\xa0éÉßªºµ×²½ñ", "\u0301", "ı", "Σ", "日本", "😀", "\u200b", "<|endoftext|>", "<|", "|>", "'ll", "word", "Wörd", "###"]
    texts = ["".join(rnd.choices(parts, k=rnd.choice([0, 1, 3, 8, 30, 200]))) for _ in range(1500)]
    texts += ["x" * 300, "é." * 50, " ".join(f"w{i} word{i}." for i in range(700)), "", " \n"]
    tok = _encoder()
    want = [[*tok.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    table = wordtable.library_table(PATH)
    for step_bytes, step_words, max_words in ((300, 7, 40), (20, 99, 40), (8_000_000, 2_000_000, 550_000)):
        monkeypatch.setattr(wordtable, "STEP_BYTES", step_bytes)
        monkeypatch.setattr(wordtable, "STEP_WORDS", step_words)
        monkeypatch.setattr(table, "max_words", max_words)
        pieces = list(wordtable.encode_column(pa.array(["cut off", *texts]).slice(1), table, 2))
        sizes = np.concatenate([n for _, n in pieces])
        assert sizes.tolist() == list(map(len, want))
        assert np.concatenate([x for x, _ in pieces]).tolist() == sum(want, [])


def test_doc_blocks_join_small_batches(monkeypatch):
    rows = [(i or None, "t" * (i % 7)) for i in range(40)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows[k : k + 3]], "text": [r[1] for r in rows[k : k + 3]]}) for k in range(0, 40, 3)]
    monkeypatch.setattr(planes, "BLOCK_BYTES", 100)
    blocks = list(planes.doc_blocks(iter(batches)))
    assert 1 < len(blocks) < len(batches)
    assert [r for ids, texts in blocks for r in zip(ids.to_pylist(), texts.to_pylist())] == rows
    assert not list(planes.doc_blocks(iter([])))


STORY = "<article><h1>A title</h1><p>The story of the old man and the sea that he was on for days.</p><svg/><p>It was the end of it.</p></article>"
TOLD = "A title\nThe story of the old man and the sea that he was on for days.\nIt was the end of it."


@pytest.mark.parametrize(
    "page",
    [
        f"<body class='no-sidebar'>{STORY}</body>",
        f"<div class='site has-sidebar'><nav>Home</nav>{STORY}</div>",
        f"<div class='search-results'>{STORY}<div class='sidebar'>Side things</div></div>",
        f"<form action='/'><input name=q>{STORY}</form>",
        f"<svg/>{STORY}<svg><text>drawn</text></svg>",
        f"<object data=x>{STORY}",
        f"{STORY}<section class='comments'><article><p>I was the first to say that it is not so, and that is what it is.</p></article></section>",
        f"<div class='related'><article><p>Another story of the sea that you may like to read as well as this.</p></article></div>{STORY}",
    ],
)
def test_layout_names_end_at_the_article(page):
    assert htmltext.extract(page) == TOLD


def test_pages_without_an_article_element():
    """Density and link rules, then neighbours, decide every block."""
    text = "It was in the days of the old king that the people of the land came to the city, and with them all that they had. " * 3
    link = "<a href='/x'>Some other page</a> "
    page = f"<ul><li>{link * 3}</li></ul><div>{text}</div><div>So it was.</div><div>{text}</div><div>{link * 8}</div><div>Imprint</div>"
    found = list(htmltext.blocks_of(page))
    rules_ = htmltext.BlockRules()
    first = [htmltext.first_pass(b, rules_, False) for b in found]
    assert first == [htmltext.BAD, htmltext.GOOD, htmltext.OPEN, htmltext.GOOD, htmltext.BAD, htmltext.OPEN]
    assert htmltext.extract(page) == "\n".join([text.strip(), "So it was.", text.strip()])


def test_missing_end_tags_are_looked_for_once():
    import time

    start = time.process_time()
    assert htmltext.extract("<object>" * 60_000 + "<p>x</p>") in ("", "x")
    assert time.process_time() - start < 3


def test_identical_rows_share_one_list_of_ranges(spark):
    """Any number of rows equal in id and text: each gets the ranges that one pair of them has."""
    rnd = random.Random(12)
    text = " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(400))
    sizes = {}
    for n in (2, 300):
        rows = spark.createDataFrame([(None, text)] * n + [(1, "short")], "doc_id long, text string")
        lists = [len(r._ranges or ()) for r in suffixdedup._with_ranges(rows, 200).collect()]
        assert len(lists) == n + 1 and len(set(lists)) == 2 and min(lists) == 0
        sizes[n] = max(lists)
        out = suffixdedup.dedup_digest(rows).where("doc_id is null").collect()
        assert len(out) == n and all((r.n_removed, r.n_spans) == (len(text), 1) for r in out)
    assert sizes[300] == sizes[2]
