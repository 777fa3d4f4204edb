"""Operator 5: quality rules -- base statistics in SQL and a learned decision list (DataFrame functions only).

``text_stats`` computes every statistic with built-in functions inside one
row: no shuffle, no Python. Repeated 3-word windows are found by sorting one
array of longs per text (window hash in the high bits, position in the low ones) and
comparing neighbours; a text whose windows share the kept hash bits
without sharing the whole 64-bit hash, or with over 2^20 words, takes the same
path over (hash, position) pairs.

``learn`` grows a decision list for label 0 by sequential covering: each rule
adds the threshold condition with the best information gain, counted by one
grouped aggregate over binned statistics, is pruned on rows that did not grow
it, and is kept only if it is precise enough there; rows it covers are taken
out before the next rule. The driver sees counts per (statistic, bin) only.
``verdict`` turns the list into one ordered conditional expression.

Edge cases: null or empty text has zero words and fails the base rules; no
labels give an empty list (everything that passes the base rules is kept);
null labels are ignored, repeated ones count once (the larger wins); an empty
table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import materialize, select_docs

SPACE = r"[\x20\x09-\x0D]+"
POSITION_BITS = 20
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_COVER = 2           # label-0 rows a rule must cover at least among those that prune it
MIN_PRECISION = 0.6     # share of label 0 among them
MAX_CHANCE = 0.01       # probability that as many label-0 rows among the covered ones are chance: holds at every table size
BASE_WORDS = 50
# statistics the rules may test, over the base columns (ratios keep them comparable across lengths)
STATISTICS = {
    "n_words": "double(n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(n_words, 1)",
    "mark_rate": "n_marks / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
    "dup_lines": "double(n_dup_lines)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "kind_rate": "n_kinds / greatest(n_words, 1)",
}


def text_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of the whole text, all long."""
    bits, low = POSITION_BITS, (1 << POSITION_BITS) - 1
    only = lambda chars: F.length(F.regexp_replace("text", f"[^{chars}]+", "")).cast("long")
    d = select_docs(docs).select(
        "doc_id",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        only(r"#*$%&|<>").alias("n_symbols"),
        only("!").alias("n_marks"),
        only("A-Z").alias("n_upper"),
    )
    d = d.select(
        "doc_id", "word_chars", "n_symbols", "n_marks", "n_upper",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_kinds"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "if(size(words) < 3, cast(array() as array<bigint>),"
            " transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"
        ).alias("h"),
    )
    kept = [c for c in d.columns if c != "h"]
    # sorted longs: the hash without its low bits, and the position there
    d = d.select(*kept, "h", F.expr(
        f"if(size(array_distinct(h)) = size(h) or size(h) > {low}, cast(array() as array<bigint>),"
        f" sort_array(transform(h, (x, i) -> (x & ~{low}L) | i)))").alias("s"))
    same = lambda a, b: f"(s[{a}] >> {bits}) = (s[{b}] >> {bits})"
    d = d.select(*kept, "h", "s", F.expr(
        f"size(h) > {low} or exists(sequence(1, greatest(size(s) - 1, 1)), k -> k < size(s) and {same('k', 'k - 1')}"
        f" and h[int(s[k] & {low}L)] != h[int(s[k - 1] & {low}L)])").alias("mixed"))
    # the rare texts that need (hash, position) pairs
    d = d.select(*kept, "s", F.expr(
        "if(mixed, sort_array(transform(h, (x, i) -> struct(x as x, bigint(i) as i))),"
        " cast(array() as array<struct<x:bigint,i:bigint>>))").alias("pairs"))
    d = d.select(*kept, F.expr(
        "if(size(pairs) > 0,"
        " sort_array(transform(filter(sequence(0, size(pairs) - 1), k -> (k > 0 and pairs[k].x = pairs[k - 1].x)"
        "  or (k < size(pairs) - 1 and pairs[k].x = pairs[k + 1].x)), k -> pairs[k].i)),"
        f" if(size(s) = 0, cast(array() as array<bigint>), sort_array(transform(filter(sequence(0, size(s) - 1), k -> (k > 0 and {same('k', 'k - 1')})"
        f"  or (k < size(s) - 1 and {same('k', 'k + 1')})), k -> s[k] & {low}L))))").alias("p"))
    # each repeated window adds the words up to the next one, three at most
    covered = "aggregate(transform(p, (x, k) -> if(k = size(p) - 1, 3L, least(3L, p[k + 1] - x))), 0L, (a, x) -> a + x)"
    return d.select(*kept, F.expr(covered).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < BASE_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.expr(STATISTICS[self.statistic])
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:.6g}"


def _binned(rows: DataFrame, names: list[str], cuts: dict[str, list[float]]) -> DataFrame:
    """bin = how many cuts lie below the value."""
    bins = []
    for n in names:
        value, b = F.expr(STATISTICS[n]), F.lit(0)
        for c in cuts[n]:
            b = b + (value > F.lit(c)).cast("int")
        bins.append(b.alias(n))
    return rows.select("bad", "grows", *bins)


def _holds(conditions) -> Column:
    out = F.lit(True)
    for name, above, k in conditions:
        out = out & (F.col(name) > k if above else F.col(name) <= k)
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(rows: DataFrame, max_rules: int = MAX_RULES, min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[list[Condition]]:
    """Rules for label 0 from rows with the count columns, ``label`` and ``doc_id``."""
    names = list(STATISTICS)
    rows = rows.select(
        *[c for c in rows.columns if c not in ("label", "doc_id")],
        (F.col("label") == 0).alias("bad"),
        # two thirds grow, one third prunes
        (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) != 0).alias("grows"),
    )
    shares = F.array(*[F.lit((k + 1) / BINS) for k in range(BINS - 1)])
    quantiles = rows.agg(*[F.percentile_approx(F.expr(STATISTICS[n]), shares, 10_000).alias(n) for n in names]).first()
    if quantiles[0] is None:
        return []
    cuts = {n: sorted(set(quantiles[n])) for n in names}
    left = materialize(_binned(rows, names, cuts), "rule-rows")
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("s"), F.col(n).alias("b")) for n in names])).alias("x")
    rules: list[list[Condition]] = []
    found: list[list[tuple]] = []
    while len(rules) < max_rules:
        free = left.where(~_holds_any(found)) if found else left
        rule: list[tuple] = []
        while len(rule) < MAX_CONDITIONS:
            at = free.where(F.col("grows") & _holds(rule)).select("bad", pairs)
            table = at.groupBy("x.s", "x.b").agg(F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")).collect()
            best = _best_condition(table, names, cuts, min_cover)
            if best is None:
                break
            rule.append(best)
        rule = _pruned(free, rule, min_precision, min_cover)
        if not rule:
            break
        found.append(rule)
        rules.append([Condition(n, above, cuts[n][k - 1] if not above else cuts[n][k]) for n, above, k in _as_cuts(rule)])
    return rules


def _as_cuts(rule: list[tuple]) -> list[tuple]:
    # bin > k means value > cuts[k]; bin <= k means value <= cuts[k]
    return [(n, above, k if above else k + 1) for n, above, k in rule]


def _holds_any(found: list[list[tuple]]) -> Column:
    out = F.lit(False)
    for rule in found:
        out = out | _holds(rule)
    return out


def _best_condition(table, names, cuts, min_cover):
    counts = {n: {} for n in names}
    for r in table:
        counts[r.s][r.b] = (r.p, r.n)
    if not table:
        return None
    p0, n0 = (sum(v[i] for v in counts[names[0]].values()) for i in (0, 1))
    if not p0 or not n0:
        return None
    best, most = None, 1e-9
    for name in names:
        below_p = below_n = 0
        for k in range(len(cuts[name])):
            p, n = counts[name].get(k, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
                g = _gain(p, n, p0, n0) if p >= min_cover else 0.0
                if g > most:
                    best, most = (name, above, k), g
    return best


def by_chance(p: int, n: int, share: float) -> float:
    """Probability of at least ``p`` label-0 rows among ``p + n`` drawn where they have this share."""
    total = p + n
    if p <= 0 or share >= 1.0:
        return 1.0
    if share <= 0.0:
        return 0.0
    if total > 1000:  # normal tail
        return 0.5 * math.erfc((p - 0.5 - total * share) / math.sqrt(2 * total * share * (1 - share)))
    log = [math.lgamma(total + 1) - math.lgamma(k + 1) - math.lgamma(total - k + 1) + k * math.log(share) + (total - k) * math.log1p(-share) for k in range(p, total + 1)]
    return min(1.0, sum(map(math.exp, log)))


def _pruned(free: DataFrame, rule: list[tuple], min_precision: float, min_cover: int) -> list[tuple]:
    """The best prefix of the rule on the rows that did not grow it; empty when none is precise enough."""
    if not rule:
        return []
    sums = [F.sum(F.col("bad").cast("long")).alias("p0"), F.count(F.lit(1)).alias("all")]
    for k in range(1, len(rule) + 1):
        hit = _holds(rule[:k])
        sums += [F.sum((hit & F.col("bad")).cast("long")).alias(f"p{k}"), F.sum((hit & ~F.col("bad")).cast("long")).alias(f"n{k}")]
    r = free.where(~F.col("grows")).agg(*sums).first()
    best, most = [], -2.0
    share = (r.p0 or 0) / max(r["all"], 1)
    for k in range(1, len(rule) + 1):
        p, n = r[f"p{k}"] or 0, r[f"n{k}"] or 0
        worth = (p - n) / (p + n) if p + n else -2.0
        sure = p >= min_cover and p >= min_precision * (p + n) and by_chance(p, n, share) <= MAX_CHANCE
        if sure and worth > most + 1e-9:
            best, most = rule[:k], worth
    return best


def verdict(rules: list[list[Condition]]) -> Column:
    """True: kept. The first rule that holds decides; none: kept."""
    out = None
    for rule in rules:
        hit = F.lit(True)
        for c in rule:
            hit = hit & c.column()
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def apply_rules(docs: DataFrame, labels: DataFrame, train) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` per document; rules learned where ``train(id)`` holds."""
    stats = materialize(text_stats(docs), "rule-stats")
    known = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("label"))
        .where(train(F.col("doc_id")))
    )
    rules = learn(stats.where(~base_failed()).join(known, "doc_id"))
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", F.when(base_failed(), F.lit(False)).otherwise(verdict(rules)))
