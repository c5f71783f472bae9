"""Operator 8: quality rules with risk-controlled thresholds (DataFrame functions only).

Each rule rejects a document whose statistic lies beyond a cutoff.  Cutoffs come from a
fixed grid; labelled good documents are the holdout.  For a stratum (language) with ``n``
good documents of which a cutoff rejects ``k``, the exact binomial p-value of "the false
rejection rate is above alpha" is P(Bin(n, alpha) <= k).  A cutoff is certified if that is
at most delta divided by the number of all tests (Bonferroni over strata, rules and
cutoffs), so that with probability 1 - delta no certified cutoff breaks its limit.  Each
rule gets an equal part of the total limit, so the rules together stay below it.  The
strictest certified cutoff of each stratum and rule is used; without one, or in a stratum
without labels, the rule rejects nothing.  A document is one trial however many rows it
has, and counts as rejected if any of them is.  The holdout are documents that pass the base
rule: what that rule rejects is fixed by contract and outside the guarantee.

A null or empty text has no words and fails the base rule.  A null language is a stratum
of its own.  Labels with a null doc_id or quality are left out; a document labelled more
than once counts as good if any of its labels is 1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import SPACE_CLASS, read_table, stored, text_or_empty

# Fixed values of the base rule.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]+"
WORD_CHAR = SPACE_CLASS.replace("[", "[^")

# Statistic of each rule and its grid of cutoffs (reject above).
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", (0.01, 0.02, 0.04, 0.08, 0.16)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.05, 0.1, 0.15, 0.2, 0.25)),
    "dup_lines": ("n_dup_lines / greatest(n_words, 1)", (0.01, 0.02, 0.04, 0.08, 0.16)),
    "capitals": ("n_upper / greatest(word_chars, 1)", (0.1, 0.2, 0.3, 0.4, 0.6)),
    "long_words": ("word_chars / greatest(n_words, 1)", (8.0, 10.0, 12.0, 16.0, 24.0)),
}


def _joined(h: Column, step: int, n: Column) -> Column:
    """Hashes of runs twice as long: item i joins items i and i + step of ``h`` (n items)."""
    left = F.greatest(n - step, F.lit(0))
    return F.zip_with(F.slice(h, F.lit(1), left), F.slice(h, F.lit(step + 1), left), lambda a, b: F.xxhash64(a, b))


def text_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper of each whole text."""
    body = F.col("_t")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD_CHAR))
    s = docs.select(*[F.col(c) for c in keep], text_or_empty(text).alias("_t"))
    s = s.select(
        *keep,
        F.array_remove(F.split(body, SPACE_CLASS + "+", -1), "").alias("_words"),
        (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(body) - F.length(F.regexp_replace(body, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        lines.alias("_lines"),
    )
    stats = ("n_symbols", "n_upper")
    s = s.select(*keep, *stats, F.size("_words").alias("_n"),
                 F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    stats += ("word_chars", "n_dup_lines", "_n")
    n = F.col("_n")
    for step, covered in ((1, 1), (2, 2), (4, 4)):
        s = s.select(*keep, *stats, _joined(F.col("_h"), step, n - (covered - 1)).alias("_h"))
    # positions are sorted by window only where some window repeats
    s = s.select(*keep, *stats, F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("_p"))
    same = lambda p, j: F.get(F.col("_p"), j)["x"].eqNullSafe(p["x"])
    near = F.transform("_p", lambda p, i: F.when(same(p, i - 1) | same(p, i + 1), p["i"]))
    s = s.select(*keep, *stats, F.sort_array(F.array_compact(near)).alias("_at"))
    covered = F.aggregate(
        "_at", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("end"),
                              (a["n"] + p + WINDOW - F.greatest(p, a["end"])).cast("long").alias("n")))
    return s.select(*keep, n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                    F.coalesce(covered["n"], F.lit(0)).cast("long").alias("n_repeat_words"), "n_upper")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8, brought back by the recurrence."""
    y = x + 8.0
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y)
    series = series + 1 / (1260 * y * y * y * y * y)
    back = F.lit(0.0)
    for j in range(8):
        back = back + F.log(x + float(j))
    return series - back


def binomial_at_most(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k < n p, else 1 (never certified).

    Sums the terms from k downward; each is a known ratio of the one above.  Terms over
    40 standard deviations below k are under 1e-300 of the sum and end it.
    """
    n, k = n.cast("double"), k.cast("double")
    log_p, log_q = math.log(p), math.log(1 - p)
    log_top = (_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
               + k * log_p + (n - k) * log_q)
    steps = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 50).cast("int")
    tail = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"), n.alias("n"), k.alias("k")),
        lambda a, j: F.struct((nxt := a["t"] * (a["k"] - j) / (a["n"] - a["k"] + j + 1) * ((1 - p) / p)).alias("t"),
                              (a["s"] + nxt).alias("s"), a["n"].alias("n"), a["k"].alias("k")))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(log_top) * tail["s"])


def certified_cutoffs(good: DataFrame, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.05,
                      key: str | None = None) -> DataFrame:
    """(stratum, rule, cutoff): the strictest certified cutoff, from statistics of good holdout documents.

    The result has a row per stratum and rule at most.  Rows with the same ``key`` (if given) are one
    trial, with the greatest value of each statistic.
    """
    values = [F.expr(stat).alias(f"_s_{rule}") for rule, (stat, _) in RULES.items()]
    good = good.select(F.col(stratum), *([key] if key else []), *values)
    if key:
        good = good.groupBy(key, stratum).agg(*[F.max(f"_s_{rule}").alias(f"_s_{rule}") for rule in RULES])
    tests = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(float(c)).alias("cutoff"),
                               (F.col(f"_s_{rule}") > F.lit(float(c))).alias("rejected"))
                      for rule, (_, grid) in RULES.items() for c in grid])
    # one row per stratum first: partial sums meet before the shuffle
    counted = good.select(F.col(stratum).alias("stratum"), F.explode(tests).alias("t")).groupBy(
        "stratum", "t.rule", "t.cutoff").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("t.rejected").cast("int")).alias("k"))
    n_strata = counted.select("stratum").distinct().count()
    per_rule = alpha / len(RULES)
    n_tests = sum(len(grid) for _, grid in RULES.values())
    p = counted.withColumn("p", binomial_at_most(F.col("n"), F.col("k"), per_rule))
    return (p.filter(F.col("p") <= delta / (n_tests * max(n_strata, 1)))
            .groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff")))


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Statistics, base verdict and the risk-controlled verdict of each document."""
    stats = stored(text_statistics(docs), "text-statistics")
    good_ids = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    good = stats.filter(~base_failed()).join(good_ids, "doc_id", "left_semi")
    cutoffs = certified_cutoffs(good, alpha=alpha, delta=delta, key="doc_id")
    # a row per language: the languages, not the documents, bound this side
    per_lang = cutoffs.groupBy("stratum").agg(*[
        F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"_c_{rule}") for rule in RULES])
    judged = stats.join(per_lang, stats["lang"].eqNullSafe(per_lang["stratum"]), "left")
    rejected = F.lit(False)
    for rule, (stat, _) in RULES.items():
        rejected = rejected | F.coalesce(F.expr(stat) > F.col(f"_c_{rule}"), F.lit(False))
    return (judged.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rejected))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_upper")
