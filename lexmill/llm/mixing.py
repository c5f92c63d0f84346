"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Every document of a source gets the rate that stays closest to 1 (relative entropy) while the
source's words come to its target: ``min(ceiling, exp(lambda * size / mean size))``. The one
multiplier of each source solves the convex dual; every Newton step is one aggregate over the
(source, size) histogram. Rates are then rounded into whole copies along the sizes, largest first.

Cases: a null text or one without words has size 0, rate 1 and takes no words; null is a source of
its own, last in order; equal rows share the copies of their size class; copies are whole, so with a
ceiling of 1.5 a document has at most 2, and all of a source 1.5 on average at most; an empty table gives an
empty result; other columns are carried in ``doc`` or left out, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut, forget
from .common import WORD

#: documents of one size class are numbered in so many parts
PARTS = 64
#: starting points tried for the rounding of each source
OFFSETS = 32


def word_count(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float], share: float, ceiling: float) -> DataFrame:
    """(source, source_size) plus target: shares by weight, stopped at the ceiling, the excess reshared."""
    one = Window.partitionBy(F.lit(0))
    named = one.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")))
    full = ranked.withColumn("cap", ceiling * F.col("source_size"))
    order = one.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # with the sources up to here at their ceiling, the rest shares by this level; the largest level is the one that holds
    level = (share * F.sum("source_size").over(one) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    return full.withColumn("level", level).withColumn("level", F.max("level").over(one)).select(
        "source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def solve_duals(classes: DataFrame, targets: DataFrame, ceiling: float, tolerance: float = 1e-10, rounds: int = 80) -> DataFrame:
    """(source, mean, lam): the multiplier of each source, by Newton steps kept inside a bracket."""
    shape = classes.where("size > 0").groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    rho = F.col("target") / F.col("source_size")
    lowest = F.col("least") / F.col("mean")
    state = cut(shape.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).where("target > 0").select(
        "s.source", "target", "mean",
        F.when(rho >= 1, 0.0).otherwise(F.log(rho) / lowest).alias("lo"),
        F.when(rho >= 1, F.log(F.lit(float(ceiling))) / lowest).otherwise(0.0).alias("hi"),
        # a target at the ceiling needs every document at the ceiling
        F.when(rho >= ceiling * (1 - 1e-12), F.log(F.lit(float(ceiling))) / lowest).otherwise(F.log(rho)).alias("lam"),
    ))
    for _ in range(rounds):
        tilt = F.exp(F.col("lam") * F.col("size") / F.col("mean"))
        words = F.col("n") * F.col("size") * F.least(F.lit(float(ceiling)), tilt)
        slope = F.when(tilt < ceiling, F.col("n") * F.col("size") * F.col("size") / F.col("mean") * tilt).otherwise(0.0)
        sums = classes.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).groupBy(
            "s.source", "target", "mean", "lo", "hi", "lam").agg(F.sum(words).alias("g"), F.sum(slope).alias("dg"))
        low = F.when(F.col("g") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        high = F.when(F.col("g") > F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        miss = F.abs(F.col("g") / F.col("target") - 1)
        step = F.col("lam") - F.log(F.col("g") / F.col("target")) * F.col("g") / F.col("dg")
        moved = sums.withColumn("low", low).withColumn("high", high).select(
            "source", "target", "mean", F.col("low").alias("lo"), F.col("high").alias("hi"), miss.alias("miss"),
            F.when(miss <= tolerance, F.col("lam")).when((F.col("dg") > 0) & (step > F.col("low")) & (step < F.col("high")), step).otherwise(
                (F.col("low") + F.col("high")) / 2).alias("lam"))
        written = cut(moved)
        forget(state)
        state = written
        worst = state.agg(F.max("miss").alias("m")).first().m
        if worst is None or worst <= tolerance:
            break
    return state.select("source", "mean", "lam")


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, ceiling: float = 2.0,
    keep: Sequence[str] | None = None, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
) -> DataFrame:
    """Rows (doc, source, size, source_size, target, rate, copies, taken).

    ``doc`` holds the columns named by ``keep`` (all, if not given). ``share`` times the words of all
    sources is dealt out by the weights, which repeat over the sources in code point order.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("doc")
    sized = docs.select(
        carried, F.col(source_col).alias("source"), word_count(text_col).alias("size"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"),
    ).withColumn("part", F.pmod(F.col("h"), F.lit(PARTS)))
    parts = cut(sized.groupBy("source", "size", "part").agg(F.count("*").alias("n")))
    classes = cut(parts.groupBy("source", "size").agg(F.sum("n").alias("n")))
    totals = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = cut(source_targets(totals, weights, share, ceiling))
    duals = solve_duals(classes, targets, ceiling)

    by_source = Window.partitionBy("source").orderBy(F.col("size").desc())
    rate = F.when(F.col("size") <= 0, 1.0).when(F.col("target") <= 0, 0.0).otherwise(
        F.least(F.lit(float(ceiling)), F.exp(F.col("lam") * F.col("size") / F.col("mean"))))
    rated = (
        classes.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
        .join(duals.alias("d"), F.col("c.source").eqNullSafe(F.col("d.source")), "left")
        .select("c.source", "size", "n", "source_size", "target", rate.alias("rate"))
        .withColumn("whole", F.floor("rate")).withColumn("rest", F.col("rate") - F.col("whole"))
    )
    placed = cut(rated.withColumn("at", F.coalesce(
        F.sum(F.col("n") * F.col("rest")).over(by_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))))
    start = F.col("at") + F.col("offset")
    tried = placed.withColumn("offset", F.explode(F.array(*[F.lit((j + 0.5) / OFFSETS) for j in range(OFFSETS)]))).groupBy("source", "target", "offset").agg(
        F.sum(F.col("size") * (F.col("n") * F.col("whole") + F.floor(start + F.col("n") * F.col("rest")) - F.floor(start))).alias("words"))
    chosen = tried.groupBy("source").agg(F.min_by("offset", F.struct(F.abs(F.col("words") - F.col("target")), "offset")).alias("offset"))
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
    plan = cut(
        numbered.alias("p").join(placed.alias("r"), F.col("p.source").eqNullSafe(F.col("r.source")) & (F.col("p.size") == F.col("r.size")))
        .join(chosen.alias("o"), F.col("p.source").eqNullSafe(F.col("o.source")))
        .select("p.source", "p.size", "part", "skip", "source_size", "target", "rate", "whole", "rest", (F.col("at") + F.col("offset")).alias("at"))
    )
    joined = sized.alias("a").join(
        plan.alias("b"),
        F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size")) & (F.col("a.part") == F.col("b.part")),
    ).select("doc", "a.source", "a.size", "a.part", "h", "skip", "source_size", "target", "rate", "whole", "rest", "at")
    place = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("h")) + F.col("skip")
    extra = F.floor(F.col("at") + F.col("place") * F.col("rest")) - F.floor(F.col("at") + (F.col("place") - 1) * F.col("rest"))
    return joined.withColumn("place", place).withColumn(
        "copies", F.least(F.lit(math.ceil(ceiling)), F.col("whole") + extra).cast("int")).select(
        "doc", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves: every row as many times as it has copies."""
    return mixed.where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
