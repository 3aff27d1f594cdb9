"""Quality rules whose cutoffs bound the share of good documents they reject.

Each rule is a number a document; a document fails a rule when the number is above the rule's cutoff for its stratum
(its language). Cutoffs come from a labelled holdout of good documents: rejecting above ``c`` is allowed only if the
hypothesis "more than ``alpha`` of the stratum's good documents are above ``c``" is refuted by an exact binomial test,
P(Binomial(n, alpha) <= k) <= delta / tests, with ``k`` of the ``n`` good holdout documents above ``c`` and ``tests``
the number of (stratum, rule) families (Bonferroni). Within a family the cutoffs are tested from the largest down, each
at the same level, up to the first that is not allowed (a fixed sequence needs no further correction); as ``k`` only
grows on the way, that is the smallest allowed cutoff. Without one, the rule rejects nothing in that stratum. ``alpha`` is split evenly over the rules, so by the union bound at most ``alpha`` of
the good documents of a stratum fail any rule, for all strata at once with probability ``1 - delta``.

Everything is DataFrame expressions. Counts within a text are array functions on the row: a document, however long, is
one row, and documents are never exploded or shuffled. What is shuffled is one count a (stratum, rule, grid step).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import documents, prepare, small, written

ALPHA = 0.02
DELTA = 0.05
STEPS = 40  # cutoffs tried for each rule: 1/40, 2/40, ... of its range
# FIXED VALUES of the contract
SPACES = "[\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50

# rule: (numerator, denominator, range): the number is numerator / denominator, in [0, range]
RULES = {
    "symbol_share": ("n_symbols", "word_chars", 0.4),
    "upper_share": ("n_upper", "word_chars", 1.0),
    "bang_share": ("n_bangs", "n_words", 2.0),
    "dup_line_share": ("n_dup_lines", "n_lines", 1.0),
    "repeat_share": ("n_repeat_words", "n_words", 0.5),
}


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable is bound, a plain column would be repeated."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(chars)).cast("long")


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are sorted by hash and place; neighbours of equal hash whose words are equal as well mark both places, and
    every marked place covers three words less what the next marked place covers again.
    """
    def places(w: Column, s: Column) -> Column:
        def equal(a: Column, b: Column) -> Column:
            same = a["h"] == b["h"]
            for k in range(3):
                same = same & (F.get(w, a["i"] + k) == F.get(w, b["i"] + k))
            return same

        both = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
                          lambda a, b: F.when(equal(a, b), F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))

    def covered(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1),
                          lambda a, b: F.least(b - a, F.lit(3)))
        return F.aggregate(gaps, F.lit(3), lambda s, g: s + g)

    def count(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        at = _let(F.sort_array(windows), lambda s: places(w, s))
        return _let(at, lambda p: F.when(F.size(p) == 0, F.lit(0)).otherwise(covered(p)))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(words, count))


def measured(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, stratum and the counts of every text; with ``carry`` also the whole row, as ``row``. Null texts have no words; a null language is a stratum of its
    own (""); null ids and repeated rows stay."""
    stratum = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), stratum.alias("stratum"),
                       *([F.struct(*docs.columns).alias("row")] if carry else []))
    more = ["row"] if carry else []
    t = F.col("text")
    words = F.array_remove(F.split(t, SPACES + "+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counts = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    by_line = _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    return (rows.select("doc_id", "stratum", *more, counts.alias("w"), by_line.alias("l"),
                        (F.length(t) - _count(t, SPACES)).alias("word_chars"), _count(t, SYMBOLS).alias("n_symbols"),
                        _count(t, "[A-Z]").alias("n_upper"), _count(t, "!").alias("n_bangs"))
            .select("doc_id", "stratum", *more, F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
                    (F.col("l.n") - F.col("l.d")).cast("long").alias("n_dup_lines"),
                    F.col("w.r").cast("long").alias("n_repeat_words"), "n_upper", "n_bangs",
                    F.col("l.n").cast("long").alias("n_lines")))


def _steps(counts: DataFrame, steps: int) -> dict[str, Column]:
    """For each rule the least grid step whose cutoff is not exceeded, ``steps`` + 1 beyond the last; exact integers."""
    out = {}
    for name, (over, under, span) in RULES.items():
        scaled = F.ceil(F.col(over) * F.lit(steps) / (F.col(under) * F.lit(span)))
        out[name] = F.when(F.col(under) > 0, F.least(scaled, F.lit(steps + 1))).otherwise(F.lit(0)).cast("int")
    return out


def log_tail(n: Column, k: Column, p: float) -> Column:
    """log P(Binomial(n, p) <= k), term by term; terms are added in log space, so no n is too large."""
    ratio, log_q = math.log(p / (1 - p)), math.log1p(-p)
    first = F.struct((n * F.lit(log_q)).alias("term"), (n * F.lit(log_q)).alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + F.lit(ratio)
        top = F.greatest(acc["sum"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(acc["sum"] - top) + F.exp(term - top))).alias("sum"))

    return F.when(k <= 0, n * F.lit(log_q)).otherwise(
        F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)).cast("long")), first, add, lambda a: a["sum"]))


def cutoffs(counts: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
            steps: int = STEPS) -> DataFrame:
    """stratum, rule, step: the smallest cutoff step that the holdout allows. Strata and rules without one are absent.

    The holdout is every labelled document of quality 1; all of it is used. A document with several labels counts
    as often as it has them; labels of unknown documents and null labels are not used. A stratum should have at least
    ``log(delta / tests) / log(1 - alpha / rules)`` good documents, or nothing can be proven and nothing is rejected.
    """
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    at = _steps(counts, steps)
    held = counts.select("doc_id", "stratum", *[c.alias(r) for r, c in at.items()]).join(good, "doc_id")
    long = held.select("stratum", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("step"))
                                                      for r in RULES])).alias("x"))
    by_step = long.groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.step").alias("step")).agg(
        F.count("*").alias("n"))
    # one row a stratum and rule from here on: its counts by step
    hist = written(by_step.groupBy("stratum", "rule").agg(
        F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("h"), F.sum("n").alias("n")), "rule-counts")
    tests = max(1, hist.count())
    tried = hist.select("stratum", "rule", "n", "h", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    above = F.aggregate(F.map_entries(F.col("h")), F.lit(0).cast("long"),
                        lambda s, e: s + F.when(e["key"] > F.col("step"), e["value"]).otherwise(F.lit(0)))
    share = alpha / len(RULES)
    # the tail is summed only where k is below the mean: elsewhere the test cannot pass
    passed = F.when(F.col("k") < F.col("n") * share, log_tail(F.col("n"), F.col("k"), share)
                    <= F.lit(math.log(delta / tests))).otherwise(F.lit(False))
    return tried.withColumn("k", above).where(passed).groupBy("stratum", "rule").agg(F.min("step").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
          steps: int = STEPS, carry: bool = False) -> DataFrame:
    """The counts of each document with ``base_failed``, ``failed_rules`` and ``kept``; with ``carry`` also the whole
    row of ``docs``, as ``row``.

    The counts (a few numbers a document) are written once, as both the holdout and the verdicts read them. The
    cutoffs are one row a stratum, a map from rule to step, and are broadcast when proven small.
    """
    prepare(docs.sparkSession)
    counts = written(measured(docs, carry), "rule-measures")
    cuts = (cutoffs(counts, labels, alpha, delta, steps).groupBy("stratum")
            .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts")))
    at = _steps(counts, steps)
    failed = F.array_compact(F.array(*[
        F.when(c > F.element_at(F.col("cuts"), r), F.lit(r)) for r, c in at.items()]))
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (counts.join(small(cuts, 3 * len(RULES)), "stratum", "left")
            .withColumn("failed_rules", F.coalesce(failed, F.array().cast("array<string>")))
            .withColumn("base_failed", base)
            .withColumn("kept", ~base & (F.size("failed_rules") == 0)))


def op8_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base_failed and kept of every document; holdout: the labels table."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(documents(spark, sf_dir), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
with d as (
  select doc_id, coalesce(lang, '') stratum, coalesce(text, '') t from documents),
w as (select doc_id, stratum, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from d),
win as (
  select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] g
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) i from w where len(ws) >= 3)),
hit as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) c from win) where c > 1),
rep as (select doc_id, count(distinct p) n from (select doc_id, unnest([i, i + 1, i + 2]) p from hit) group by doc_id),
ln as (
  select doc_id, count(*) n, count(distinct x) d
  from (select doc_id, unnest(string_split(t, chr(10))) x from d)
  where length(translate(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) > 0 group by doc_id),
m as (
  select doc_id, stratum, len(ws)::bigint n_words,
    length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::bigint word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint n_symbols,
    (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::bigint n_upper,
    (length(t) - length(translate(t, '!', '')))::bigint n_bangs,
    coalesce(ln.n, 0)::bigint n_lines, (coalesce(ln.n, 0) - coalesce(ln.d, 0))::bigint n_dup_lines,
    coalesce(rep.n, 0)::bigint n_repeat_words
  from w left join rep using (doc_id) left join ln using (doc_id)),
s as (
  select doc_id, stratum, unnest([
    {rule: 'symbol_share', step: case when word_chars > 0 then least(ceil(n_symbols * 40 / (word_chars * 0.4::double)), 41) else 0 end},
    {rule: 'upper_share', step: case when word_chars > 0 then least(ceil(n_upper * 40 / (word_chars * 1.0::double)), 41) else 0 end},
    {rule: 'bang_share', step: case when n_words > 0 then least(ceil(n_bangs * 40 / (n_words * 2.0::double)), 41) else 0 end},
    {rule: 'dup_line_share', step: case when n_lines > 0 then least(ceil(n_dup_lines * 40 / (n_lines * 1.0::double)), 41) else 0 end},
    {rule: 'repeat_share', step: case when n_words > 0 then least(ceil(n_repeat_words * 40 / (n_words * 0.5::double)), 41) else 0 end}
  ], recursive := true) from m),
g as (select s.* from s join labels using (doc_id) where quality = 1),
tried as (
  select stratum, rule, c.c step, count(*) n, count(*) filter (where g.step > c.c) k
  from g, (select unnest(range(1, 41)) c) c group by all),
passed as (
  select stratum, rule, step from (
    select stratum, rule, step, n, k, (select count(*) from (select distinct stratum, rule from tried)) tests,
      list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - (case when i > 0 then lgamma(i + 1) else 0 end)
        - lgamma(n - i + 1) + i * ln(0.004::double) + (n - i) * ln(0.996::double)))) tail
    from tried where k < n * 0.004) where tail <= 0.05 / tests),
cut as (select stratum, rule, min(step) cutoff from passed group by all),
bad as (select distinct s.doc_id from s join cut using (stratum, rule) where s.step > cut.cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 or 100 * n_repeat_words > 50 * n_words) base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and bad.doc_id is null kept
from m left join bad using (doc_id)
"""
