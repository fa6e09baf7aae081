"""Mixing to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

The tokens of each cell (source, language, topic) are summed once. The cells' weights are then scaled to the targets of one marginal after the
other, again and again, until every marginal is within ``tolerance`` of its target. A document of a cell stays with a
probability in proportion to weight over tokens, cut at one; so no document is repeated, and the expected tokens of the sample follow the fitted
weights, but for rare cells that have too few tokens. These, the cells with the highest weight per token, hold at most ``short`` of all weight, so a
few rare documents don't decide how much of the rest is kept; ``shortfall`` is the part of its wanted tokens that a cell lacks. A document's draw is a
hash of its id, so a repeated run draws alike.

Default targets are tempered shares, tokens ** ``power`` of each value. Own targets come as rows (dimension, value, share); values
they don't name keep the share that the named ones leave. Own targets that can't be met within ``most`` tests are an error; tempered shares that
contradict each other (they may, where cells are missing) are followed as far as ``most`` tests go, the topic exactly, and ``fit_error`` says how
far the worst marginal is off.

Defined cases: a null text has no tokens; null sources, languages and topics are values of their own; documents of cells without
tokens stay; repeated rows are drawn alike; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricelake.llm.store import stored

DIMENSIONS = ("source", "lang", "topic")
#: Steps per doubling in ``scale``.
STEPS = 1024


def token_count(text: Column) -> Column:
    """Words between blanks, tabs and line ends."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def form_topic(text: Column, tokens: Column) -> Column:
    """A topic from the form of a text, for tables that have no column for it."""
    return F.when(F.contains(text, F.lit(" | ")), "table").when(tokens < 200, "brief").when(tokens > 2000, "long").otherwise("prose")


def _targets(cells: DataFrame, dimension: str, power: float, given: DataFrame | None) -> DataFrame:
    """(value, share) of one marginal; shares sum to one."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("n").alias("n"))
    if given is None:
        share = F.pow(F.col("n").cast("double"), F.lit(power))
        return sums.select("value", (share / F.lit(sums.agg(F.sum(share)).first()[0])).alias("share"))
    mine = given.where(F.col("dimension") == dimension).select(F.col("value").alias("named"), F.col("share").cast("double").alias("named_share"))
    both = sums.join(mine, F.col("value").eqNullSafe(F.col("named")), "left")
    rest = F.sum(F.when(F.col("named_share").isNull(), F.col("n")).otherwise(0))
    named, rest = both.agg(F.coalesce(F.sum("named_share"), F.lit(0.0)), rest).first()
    share = F.coalesce("named_share", F.lit(max(1 - named, 0.0)) * F.col("n") / F.lit(max(rest or 0, 1)))
    both = both.select("value", share.alias("share"))
    return both.select("value", (F.col("share") / F.lit(both.agg(F.sum("share")).first()[0])).alias("share"))


def fit(
    cells: DataFrame, power: float = 0.9, targets: DataFrame | None = None, tolerance: float = 1e-4, rounds: int = 4, most: int = 25
) -> DataFrame:
    """(source, lang, topic, n) -> the same with ``weight``, the fitted share of all tokens, and ``fit_error``, one number for all.

    ``rounds`` passes over the marginals between two tests, ``most`` tests at most. Works on one row per cell.
    """
    total = cells.where("n > 0").agg(F.sum("n")).first()[0]
    if not total:
        return cells.where("false").select(*DIMENSIONS, "n", F.lit(0.0).alias("weight"), F.lit(0.0).alias("fit_error"))
    rows = cells.where("n > 0").withColumn("weight", F.col("n") / F.lit(total))
    for d in DIMENSIONS:
        t = _targets(cells.where("n > 0"), d, power, targets).select(F.col("value").alias("v"), F.col("share").alias(f"to_{d}"))
        rows = rows.join(t, F.col(d).eqNullSafe(F.col("v"))).drop("v")
    rows = stored(rows, "cells")
    for _ in range(most):
        for _ in range(rounds):
            for d in DIMENSIONS:
                rows = rows.withColumn("weight", F.col("weight") * F.col(f"to_{d}") / F.sum("weight").over(Window.partitionBy(d)))
        rows = stored(rows, "fitted")
        off = [rows.groupBy(d).agg(F.abs(F.sum("weight") / F.max(f"to_{d}") - 1).alias("off")) for d in DIMENSIONS]
        worst = off[0].select("off").union(off[1].select("off")).union(off[2].select("off")).agg(F.max("off")).first()[0]
        if worst <= tolerance:
            break
    else:
        if targets is not None:
            raise ValueError(f"targets can't be met by the cells there are: a marginal is off by {worst:.2%} after {most * rounds} passes")
    return rows.select(*DIMENSIONS, "n", "weight", F.lit(worst).alias("fit_error"))


def scale(fitted: DataFrame, short: float) -> float:
    """The weight per token at which a document is certain to stay: cells above it hold at most ``short`` of all weight.

    Cells are counted by weight per token in steps of 0.07 %, so what is sorted here doesn't grow with the cells.
    """
    step = F.floor(F.log2(F.col("weight") / F.col("n")) * STEPS).alias("step")
    above = F.sum("weight").over(Window.orderBy(F.desc("step")))
    steps = fitted.groupBy(step).agg(F.sum("weight").alias("weight")).withColumn("above", above)
    found = steps.where(F.col("above") > short).agg(F.max("step")).first()[0]
    return 2.0 ** (found / STEPS) if found is not None else 1.0


def mix(
    docs: DataFrame, topic: Column | None = None, power: float = 0.9, targets: DataFrame | None = None, seed: int = 17, short: float = 0.05
) -> DataFrame:
    """``docs`` with n_tokens, topic, probability, shortfall, fit_error and kept. Columns of those names are replaced."""
    docs = docs.drop("n_tokens", "probability", "shortfall", "fit_error", "kept")
    docs = docs.withColumn("n_tokens", token_count(F.col("text")))
    docs = docs.withColumn("topic", form_topic(F.col("text"), F.col("n_tokens")) if topic is None else topic)
    cells = stored(docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n")), "token-sums")
    fitted = fit(cells, power, targets)
    wanted = F.col("weight") / F.col("n") / F.lit(scale(fitted, short))
    its = [F.col(d).alias(f"its_{d}") for d in DIMENSIONS]
    chance = fitted.select(
        *its, F.least(wanted, F.lit(1.0)).alias("probability"), F.greatest(1 - 1 / wanted, F.lit(0.0)).alias("shortfall"), "fit_error"
    )
    chance = stored(chance, "probabilities")
    same = [F.col(d).eqNullSafe(F.col(f"its_{d}")) for d in DIMENSIONS]
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / F.lit(float(1 << 53))
    out = docs.join(chance, same[0] & same[1] & same[2], "left").drop(*(f"its_{d}" for d in DIMENSIONS))
    out = out.withColumns({"probability": F.coalesce("probability", F.lit(1.0)), "shortfall": F.coalesce("shortfall", F.lit(0.0))})
    return out.withColumn("kept", (F.col("probability") >= 1) | (draw < F.col("probability")))
