"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document when one measured rate exceeds a cutoff.  For every
stratum and rule the cutoffs of a fixed grid are tested from the mildest on.
A cutoff is accepted while the exact binomial (Clopper-Pearson) upper bound on
the share of good documents it rejects stays at or below ``risk``; the first
refused cutoff ends the sequence, which needs no correction along the grid.
Over strata and rules the error ``error`` is divided evenly, so with probability
``1 - error`` no accepted cutoff rejects more than ``risk`` of a stratum's good
documents, and all rules together no more than ``risk`` times their number.  A stratum with too few labels gets no rule.

Only DataFrame expressions are used.  Null text is empty, has no words and fails
the base check; unlisted and null strata share the stratum "other"; documents
without a label are judged, and never calibrate.  Repeated rows are measured one
by one.  Tables may be empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.tables import written

SYMBOLS = "#*$%&|<>"
STRATA = ("en", "de", "fr", "es")
#: rate columns and their cutoffs, mildest first
GRID = {
    "symbol_rate": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03, 0.02),
    "shout_rate": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "dup_line_rate": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_rate": (0.29, 0.27, 0.25, 0.22, 0.2, 0.15, 0.1),
    "word_length": (30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 10.0),
}
WINDOW = 8


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Number of words inside ``WINDOW``-word windows that occur twice or more."""
    def counted(hashes: Column) -> Column:
        # the usual text has no equal windows, and needs no sort
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bound(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
                  in_repeats))

    def in_repeats(pairs: Column) -> Column:
        twin = F.filter(pairs, lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"])
                        | (F.get(pairs, k + 1)["h"] == p["h"]))
        starts = F.array_sort(F.transform(twin, lambda p: p["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(starts, start, lambda s, i: F.struct(
            i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n")))["n"]

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(bound(windows, counted)).cast("long")


def measured(docs: DataFrame, strata: tuple[str, ...] = STRATA) -> DataFrame:
    """The documents with n_words, the four counts, the rates, base_failed and stratum."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda s: F.translate(s, " \t\n\x0b\f\r", "") != "")
    per_word = bound(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                               repeated_words(w).alias("n_repeat_words")))
    bare = F.translate(text, " \t\n\x0b\f\r", "")
    counts = (docs.withColumn("_w", per_word)
              .withColumn("_lines", bound(lines, lambda a: F.struct(
                  F.size(a).alias("n"), (F.size(a) - F.size(F.array_distinct(a))).alias("again"))))
              .withColumn("word_chars", F.char_length(bare).cast("long"))
              .withColumn("n_symbols", (F.char_length(text) - F.char_length(
                  F.translate(text, SYMBOLS, ""))).cast("long"))
              .withColumn("_shout", F.char_length(F.regexp_replace(bare, r"[^\p{Lu}!]+", ""))))
    ratio = lambda x, n: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0))
    n_words, repeats = F.col("_w.n_words"), F.col("_w.n_repeat_words")
    return (counts
            .withColumn("n_words", n_words).withColumn("n_repeat_words", repeats)
            .withColumn("n_dup_lines", F.col("_lines.again").cast("long"))
            .withColumn("symbol_rate", ratio(F.col("n_symbols"), F.col("word_chars")))
            .withColumn("shout_rate", ratio(F.col("_shout"), F.col("word_chars")))
            .withColumn("dup_line_rate", ratio(F.col("_lines.again"), F.col("_lines.n")))
            .withColumn("repeat_rate", ratio(repeats, n_words))
            .withColumn("word_length", ratio(F.col("word_chars"), n_words))
            .withColumn("base_failed", (n_words < 20) | (repeats * 100 > n_words * 30))
            .withColumn("stratum", F.when(F.col("lang").isin(*strata), F.col("lang"))
                        .otherwise(F.lit("other")))
            .drop("_w", "_lines", "_shout"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            *GRID, "stratum")


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for n trials of probability p, summed in logarithms so nothing underflows."""
    start = F.struct((n * F.log1p(F.lit(-p))).alias("term"), (n * F.log1p(F.lit(-p))).alias("total"))
    odds = F.log(F.lit(p)) - F.log1p(F.lit(-p))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(s["total"], term), F.least(s["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.least(F.lit(1.0), F.exp(F.aggregate(steps, start, step)["total"]))


def certified_cutoffs(measures: DataFrame, labels: DataFrame, strata: tuple[str, ...] = STRATA,
                      risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """stratum and one column per rule: its certified cutoff, null where there is none.

    At most ``len(strata) + 1`` rows.
    """
    share = error / ((len(strata) + 1) * len(GRID))
    # documents that fail the base check never reach the rules
    good = (measures.where(~F.col("base_failed")).join(
        labels.where("quality = 1").select("doc_id").distinct(), "doc_id", "left_semi"))
    over = [F.sum((F.col(rule) > cut).cast("long")).alias(f"{rule}_{i}")
            for rule, cuts in GRID.items() for i, cut in enumerate(cuts)]
    counts = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *over)

    def accepted(rule: str, cuts: tuple[float, ...]) -> Column:
        best: Column = F.lit(None).cast("double")
        passed: Column = F.lit(True)
        steps = []
        for i, cut in enumerate(cuts):
            k = F.col(f"{rule}_{i}")
            # the upper bound is at most risk just when so few rejections have probability <= share
            fits = (k <= F.col("n") * risk) & (binomial_tail(k, F.col("n"), risk) <= share)
            steps.append(F.struct(fits.alias("ok"), F.lit(cut).alias("cut")))
        state = F.struct(passed.alias("ok"), best.alias("cut"))
        return F.aggregate(F.array(*steps), state, lambda s, x: F.struct(
            (s["ok"] & x["ok"]).alias("ok"),
            F.when(s["ok"] & x["ok"], x["cut"]).otherwise(s["cut"]).alias("cut")))["cut"].alias(f"_{rule}")

    return counts.select("stratum", *(accepted(rule, cuts) for rule, cuts in GRID.items()))


def judged(measures: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add kept: false if the base check failed or a certified rule rejects."""
    rejected = [F.coalesce(F.col(rule) > F.col(f"_{rule}"), F.lit(False)) for rule in GRID]
    some = rejected[0]
    for one in rejected[1:]:
        some = some | one
    return (measures.join(F.broadcast(cutoffs), "stratum", "left")  # one row per listed stratum
            .withColumn("kept", ~F.col("base_failed") & ~some)
            .drop(*(f"_{rule}" for rule in GRID)))


def rule_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, all measures and the verdict of every document."""
    measures = written(measured(docs.select("doc_id", "text", "lang")).select("doc_id", *MEASURES),
                       "measures")
    return judged(measures, certified_cutoffs(measures, labels))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    Rows are measured once and written with their measures; the calibration
    reads only the narrow columns of that table.
    """
    own = F.struct(*docs.columns).alias("_row")
    measures = written(measured(docs.select(own, "doc_id", "text", "lang")).select("_row", "doc_id", *MEASURES),
                       "measures")
    return judged(measures, certified_cutoffs(measures, labels)).where("kept").select("_row.*")
