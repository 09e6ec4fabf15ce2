"""Quality rules with risk-controlled thresholds. DataFrame and SQL functions only.

Base features come from the whole text inside one row: no shuffle. For each rule a fixed grid of cutoffs
is tried on labelled documents that pass the base rule. In each stratum (language) and for each cutoff the
number of good documents it would reject is binomial; a cutoff is admitted only if the exact binomial
(Clopper-Pearson) upper bound of its false rejection is within the rule's share of ``RISK``, at confidence
1 - ``DELTA`` over all strata, rules and cutoffs together. The cutoffs of a rule are tested in a fixed order, loosest first,
until one fails (a tighter one rejects whatever a looser one does, so its test can't succeed where that fails); such a sequence
needs no correction within itself, and Bonferroni's covers rules and strata. As all bounds hold at once, any
admitted cutoff may be chosen: that with the largest difference between the rejected shares of bad and of
good documents, if it is positive; of equal ones the loosest. A stratum without enough good documents
admits nothing and loses nothing. The thresholds are fitted on all labelled documents: features are written once
for all documents, and only numbers are shuffled to the labels. Counts per document are always of the whole text.

A trial is a distinct text of a stratum, so neither repeated rows nor ids that share a text count twice. Of rows that
repeat an id, that with the least md5 of the text, then the least language, counts; texts whose ids have both labels
aren't used. Near copies with other words are trials of their own: the bound takes them as independent.

Repeated windows are found by 64-bit hashes of five word hashes.

Nulls and empties: a null text has no words and fails the base rule; a null language is a stratum of its own;
null labels, and ids with both labels, are not used. Extra columns are ignored, repeated rows are repeated
in the result, an empty table gives an empty result, without labels no rule rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import WORD
from papyra.shared import written

RISK, DELTA = 0.02, 0.05
SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Cutoffs by rule, in order; a value above the cutoff is rejected (for mean_chars_low: its negative).
GRID = {
    "symbols_per_word": [0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0],
    "dup_lines_per_line": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9],
    "repeat_share": [0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.14, 0.16, 0.18, 0.19, 0.2],
    "mean_chars_high": [6.0, 6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 10.0, 11.0, 12.0, 15.0, 20.0],
    "mean_chars_low": [-4.5, -4.25, -4.0, -3.75, -3.5, -3.25, -3.0, -2.75, -2.5, -2.25, -2.0, -1.5],
}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words in windows of five that are found twice or more, from the array of word hashes."""
    n = F.size(hashes)
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))

    def places(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def met(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
            at = F.sort_array(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            return F.aggregate(at, start, lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")), lambda acc: acc["n"])

        return _let(ordered, met)

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(places(w)))


def features(docs: DataFrame, *keep: Column) -> DataFrame:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long) of whole texts, after the columns ``keep``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.length(F.regexp_replace(text, SPACES, ""))
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
    lines = _let(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)), lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    split = F.when(F.length(inner) > 0, F.split(inner, SPACES)).otherwise(F.array().cast("array<string>"))
    words = _let(F.transform(split, lambda w: F.xxhash64(w)), lambda h: F.struct(F.size(h).alias("n"), _repeat_words(h).alias("repeat")))
    rows = docs.select(*keep, bare.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"), lines.alias("_lines"), words.alias("_words"))
    kept = [c for c in rows.columns if c not in ("_lines", "_words")]
    return rows.select(*kept, *[F.col(f"_{a}.{b}").cast("long").alias(c) for a, b, c in (("lines", "n", "n_lines"), ("lines", "dup", "n_dup_lines"), ("words", "n", "n_words"), ("words", "repeat", "n_repeat_words"))])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_lines_per_line": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "mean_chars_high": F.col("word_chars") / words,
        "mean_chars_low": -F.col("word_chars") / words,
    }


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed exactly in logarithms."""
    import math

    odds, none = math.log(p / (1 - p)), n * math.log1p(-p)
    start = F.struct(none.alias("log"), F.exp(none).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        log = acc["log"] + F.log((n - i + 1) / i) + odds
        return F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum"))

    return F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, step, lambda acc: acc["sum"])


def rated(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, text_md5, features) of all documents."""
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_md5")
    return features(docs, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("(none)")).alias("stratum"), digest)


def thresholds(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cutoffs): one row per stratum with a cutoff, cutoffs a map from rule to cutoff."""
    return fitted(rated(docs), labels, risk, delta)


def fitted(rows: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``thresholds`` from ``rated`` rows."""
    agreed = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("low"), F.max("quality").alias("quality")).where("low = quality")
    numbers = [c for c in rows.columns if c not in ("doc_id", "stratum", "text_md5")]
    labelled = rows.join(agreed.select("doc_id", "quality"), "doc_id")
    each = labelled.groupBy("doc_id").agg(F.min(F.struct("text_md5", "stratum", "quality", *numbers)).alias("of")).select("of.*")
    texts = each.groupBy("stratum", "text_md5").agg(F.min("quality").alias("low"), F.max("quality").alias("quality"), *[F.min(c).alias(c) for c in numbers])
    known = texts.where("low = quality").where(~base_failed())
    # How many cutoffs of its grid a value is above: rows are counted by that before the cutoffs are told apart.
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), sum(((v > F.lit(float(c))).cast("int") for c in GRID[r]), F.lit(0)).alias("above")) for r, v in rule_values().items()])
    good, n = F.col("quality") == 1, F.col("n")
    placed = known.select("stratum", "quality", F.explode(rules).alias("r")).groupBy("stratum", "r.rule", "r.above").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    grid = F.create_map(*[x for r, cs in GRID.items() for x in (F.lit(r), F.array(*[F.lit(float(c)) for c in cs]))])
    tried = placed.select("*", F.posexplode(grid[F.col("rule")]).alias("n", "cutoff"))
    over = F.col("above") > n
    counts = tried.groupBy("stratum", "rule", "cutoff").agg(F.sum("good").alias("good"), F.sum(F.when(over, F.col("good")).otherwise(0)).alias("false_rejected"), F.sum("bad").alias("bad"), F.sum(F.when(over, F.col("bad")).otherwise(0)).alias("rejected"))
    share = risk / len(GRID)
    strata = F.broadcast(counts.agg(F.count_distinct("stratum").alias("strata")))
    bounded = counts.crossJoin(strata).where(F.col("false_rejected") < F.col("good") * share)
    bounded = bounded.where(binomial_cdf(F.col("false_rejected"), F.col("good"), share) <= F.lit(delta / len(GRID)) / F.col("strata"))
    gain = F.round(F.col("rejected") / F.greatest("bad", F.lit(1)) - F.col("false_rejected") / F.col("good"), 9)
    best = bounded.withColumn("gain", gain).where("gain > 0").groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct("gain", "cutoff")).alias("cutoff"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "cutoff")))).alias("cutoffs"))


def judge(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, features, base_failed, failed_rules, kept): one row per document."""
    rows = written(rated(docs), "rules-features")  # numbers, computed once for the thresholds and for the result
    cutoffs = F.broadcast(fitted(rows, labels, **how))  # at most one row for each stratum among the labelled rows
    failed = F.filter(F.array(*[F.when(v > F.col("cutoffs")[r], F.lit(r)) for r, v in rule_values().items()]), lambda r: r.isNotNull())
    rows = rows.join(cutoffs, "stratum", "left").withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("cutoffs", "stratum", "text_md5")
