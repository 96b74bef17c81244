"""Quality rules whose cutoffs are risk-controlled on labelled documents.

Each rule holds a share of a text against a cutoff. For every stratum and rule the
cutoffs are tested from the loosest to the strictest: labelled good documents give an
exact binomial test of "this cutoff rejects more than ``risk`` of good documents". The
tests of one rule stop at the first that fails (fixed sequence), and each has its part of
``error`` by the number of rules and strata (Bonferroni). With probability 1 - ``error``
no rule rejects more than ``risk`` of the good documents of any stratum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablelift.llm.tables import written

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = "\t\n\x0b\x0c\r"
# Good documents that one rule may reject, and the chance that this does not hold.
RISK, ERROR = 0.01, 0.05
# Rules: (share of, per, cutoffs in percent from loose to strict).
RULES = {
    "symbols": ("n_symbols", "word_chars", (50, 30, 20, 10, 5, 2)),
    "dup_lines": ("n_dup_lines", "n_lines", (80, 60, 50, 40, 30, 20)),
    "repeats": ("n_repeat_words", "n_words", (90, 80, 70, 60, 50, 40, 30, 20)),
    "capitals": ("n_capitals", "word_chars", (80, 60, 40, 30, 20)),
    "long_words": ("word_chars", "n_words", (3000, 2000, 1500, 1200, 1000)),
}


def _covered(starts: Column) -> Column:
    """Words that windows of three, at these sorted places, lie over."""
    steps = F.transform(starts, lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and counts of each text; the stratum is its language, '' for null.

    Every step is a column of its own, so that no array is computed again for its elements.
    """
    spaced = F.translate("text", WHITE, " " * len(WHITE))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda line: F.trim(F.translate(line, WHITE, " ")) != "")
    step = docs.select(
        "doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("stratum"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).select(
        "doc_id", "stratum", "text", words.alias("words"), lines.alias("lines")
    ).select(
        "doc_id", "stratum", "words",
        F.size("words").alias("n_words"),
        F.length(F.translate("text", WHITE + " ", "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", CAPITALS, ""))).alias("n_capitals"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines")
    window = F.transform(
        F.sequence(F.lit(0), F.col("n_words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )
    windows = F.when(F.col("n_words") >= 3, window).otherwise(F.array().cast("array<bigint>"))
    step = step.select("doc_id", "stratum", *counts, windows.alias("windows"))
    once = F.size(F.array_distinct("windows")) == F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    placed = F.when(once, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(placed)
    step = step.select("doc_id", "stratum", *counts, placed.alias("placed"))
    again = F.filter(
        "placed",
        lambda w, k: w["h"].eqNullSafe(F.get("placed", k - 1)["h"]) | w["h"].eqNullSafe(F.get("placed", k + 1)["h"]),
    )
    step = step.select("doc_id", "stratum", *counts, F.sort_array(F.transform(again, lambda w: w["i"])).alias("starts"))
    repeated = _covered(F.col("starts")).alias("n_repeat_words")
    return step.select(
        "doc_id", "stratum", *(F.col(c).cast("long").alias(c) for c in counts), repeated.cast("long").alias("n_repeat_words")
    )


def _over(rule: str, cutoff: Column | int) -> Column:
    count, per, _ = RULES[rule]
    return 100 * F.col(count) > cutoff * F.col(per)


def at_most(hits: Column, trials: Column, share: float) -> Column:
    """The chance of ``hits`` or fewer in ``trials`` draws that hit with ``share``."""
    odds = F.lit(share / (1 - share))
    first = F.struct((trials * F.log(F.lit(1 - share))).alias("log"), F.exp(trials * F.log(F.lit(1 - share))).alias("sum"))

    def step(acc: Column, j: Column) -> Column:
        log = acc["log"] + F.log((trials - j + 1) / j * odds)
        return F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum"))

    counted = F.when(hits > 0, F.sequence(F.lit(1).cast("long"), hits)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(counted, first, step, lambda acc: acc["sum"])


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum, and the cutoff in percent of each rule there; null where none is safe.

    Of the cutoffs that pass their tests, the strictest is taken that rejects at least as
    many labelled bad documents as good ones.
    """
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    held = measured.join(marked.agg(F.min("quality").alias("quality")), "doc_id")
    good, bad = F.col("quality") >= 1, F.col("quality") < 1
    tests = [(rule, i, cut) for rule, (_, _, cuts) in RULES.items() for i, cut in enumerate(cuts)]
    sums = held.groupBy("stratum").agg(
        F.count_if(good).alias("trials"),
        *(F.count_if(good & _over(rule, cut)).alias(f"good_{rule}_{i}") for rule, i, cut in tests),
        *(F.count_if(bad & _over(rule, cut)).alias(f"bad_{rule}_{i}") for rule, i, cut in tests),
    )
    rows = F.array(*(
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("place"), F.lit(cut).alias("cutoff"),
                 F.col(f"good_{rule}_{i}").alias("hits"), F.col(f"bad_{rule}_{i}").alias("caught"))
        for rule, i, cut in tests
    ))
    sums = written(sums, "strata")
    strata = sums.count()
    tested = sums.select("stratum", "trials", F.explode(rows).alias("t")).select("stratum", "trials", "t.*")
    # A share of hits at or above the risk can not pass and needs no sum.
    can = F.col("hits") < F.col("trials") * risk
    chance = F.when(can, at_most(F.when(can, F.col("hits")).otherwise(0).cast("long"), F.col("trials"), risk)).otherwise(1.0)
    tested = tested.withColumn("fails", chance > error / (len(RULES) * F.lit(max(strata, 1))))
    # A cutoff is safe if it and all looser ones pass.
    stop = tested.groupBy("stratum", "rule").agg(F.min(F.when(F.col("fails"), F.col("place"))).alias("stop"))
    safe = tested.join(stop, ["stratum", "rule"]).where("stop IS NULL OR place < stop")
    useful = safe.where("caught >= hits AND caught > 0")
    best = useful.groupBy("stratum").pivot("rule", list(RULES)).agg(F.min("cutoff"))
    return best.select("stratum", *(F.col(rule).alias(f"cut_{rule}") for rule in RULES))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """doc_id, the counts of its text, base_failed, kept: one row for each row of ``docs``.

    base_failed: fewer than 50 words, or more than half of them in three-word windows found
    twice. kept is false for those, and for texts over a rule's cutoff in their stratum.

    A null text counts as an empty one, which fails for want of words. Documents without
    language form one stratum; strata without enough labels have no cutoffs. Labels without
    a doc_id or quality are left out, and of several for one document the worst counts.
    Repeated rows get a row each, an empty table gives an empty result, and other columns
    are ignored.
    """
    measured = written(measures(docs), "measures")
    chosen = cutoffs(measured, labels, risk, error)
    judged = measured.join(chosen, "stratum", "left")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    over = reduce(Column.__or__, (F.coalesce(_over(rule, F.col(f"cut_{rule}")), F.lit(False)) for rule in RULES))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~over).alias("kept"),
    )
