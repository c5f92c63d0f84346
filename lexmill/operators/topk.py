"""Sorted pages, top-N reports and fixed-seed samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def top_cited(cases: DataFrame, n: int = 10) -> DataFrame:
    """Cases with the most citing tokens, with the year for context; ties by ECLI."""
    year = F.coalesce(F.year(X.parse_date(X.min_tok("date_publication"))).cast("string"), F.lit(""))
    rows = cases.select("ecli", F.size(X.toks("cited_by")).cast("long").alias("in_degree"),
                        F.col("subject_matter").alias("subject"), year.alias("year"))
    return rows.where("in_degree > 0").orderBy(F.desc("in_degree"), F.asc("ecli")).limit(n)


def page(df: DataFrame, after: tuple[object, str] | None, n: int, date: str = "date_decision", key: str = "ecli") -> DataFrame:
    """Next page: date descending with missing dates last, then key; ``after`` is (date, key)."""
    if after:
        day, last = after
        if day is None:
            df = df.where(F.col(date).isNull() & (F.col(key) > last))
        else:
            day = F.lit(day).cast("date")
            df = df.where((F.col(date) < day) | F.col(date).isNull()
                          | ((F.col(date) == day) & (F.col(key) > last)))
    return df.orderBy(F.col(date).desc_nulls_last(), F.col(key).asc()).limit(n)


def seeded(keys: Sequence[str], seed: int) -> Column:
    """Order of a seeded draw: the same in every engine that has md5."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))).cast("binary"))


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """n rows, the same ones for the same seed, whatever the partitioning."""
    return df.orderBy(seeded(keys, seed), *keys).limit(n)


def allocate(counts: DataFrame, n: int, floor: int) -> DataFrame:
    """Rows to draw per stratum: the floor, then a proportional share, then one each until n.

    Works on the grouped counts (one row per stratum).
    """
    total = counts.agg(F.sum("n").alias("total"))
    base = counts.withColumn("base", F.least("n", F.lit(floor)))
    left = base.agg((F.lit(n) - F.sum("base")).alias("left"))
    shared = base.withColumn("left", left.scalar()).withColumn("total", total.scalar())
    extra = F.when(
        (F.col("left") > 0) & (F.col("n") > F.col("base")),
        F.least(F.col("n") - F.col("base"), F.bround(F.col("left") * F.col("n") / F.col("total")).cast("long")),
    ).otherwise(0)
    drawn = shared.withColumn("k", F.col("base") + extra)
    missing = drawn.agg((F.least(F.lit(n), F.max("total")) - F.sum("k")).alias("missing"))
    # Top-up goes round by round over strata with room. Position of the r-th extra row of a
    # stratum is (r, stratum); the first `missing` positions are granted.
    room = (
        drawn.withColumn("missing", missing.scalar())
        .where((F.col("missing") > 0) & (F.col("n") > F.col("k")))
        .select("stratum", F.explode(F.sequence(F.lit(1), F.least(F.col("n") - F.col("k"), F.col("missing")).cast("int"))).alias("round"), "missing")
    )
    order = Window.orderBy("round", "stratum")
    granted = (
        room.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= F.col("missing"))
        .groupBy("stratum").agg(F.count("*").alias("topup"))
    )
    return drawn.join(granted, "stratum", "left").select(
        "stratum", "n", (F.col("k") + F.coalesce("topup", F.lit(0))).alias("k"))


def stratified_sample(df: DataFrame, by: str, keys: Sequence[str], n: int, floor: int, seed: int) -> DataFrame:
    """Seeded sample with a floor per stratum."""
    plan = allocate(df.groupBy(F.col(by).alias("stratum")).agg(F.count("*").alias("n")), n, floor)
    order = Window.partitionBy(by).orderBy(seeded(keys, seed), *keys)
    ranked = df.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= n)
    wanted = plan.select(F.col("stratum").alias(by), "k")
    return ranked.join(wanted, by).where(F.col("__rank") <= F.col("k")).drop("__rank", "k")


def out_degree(edges: DataFrame) -> DataFrame:
    pairs = edges.select("source_case_id", "target_case_id").distinct()
    return pairs.groupBy("source_case_id").agg(F.count("*").alias("degree"))


def top_change(old: DataFrame, new: DataFrame, n: int = 15) -> DataFrame:
    """Sources with the highest old out-degree, with the new one and the difference."""
    before = out_degree(old).withColumnRenamed("degree", "before")
    after = out_degree(new).withColumnRenamed("degree", "after")
    return (
        before.join(after, "source_case_id", "left")
        .select("source_case_id", "before", F.coalesce("after", F.lit(0)).alias("after"))
        .withColumn("dropped", F.col("before") - F.col("after"))
        .orderBy(F.desc("before"), F.asc("source_case_id"))
        .limit(n)
    )


def sample_groups(df: DataFrame, key: str, member: str, n: int = 20, shown: int = 20) -> DataFrame:
    """The first n groups with several members, by key; the count is whole, the list is a sample."""
    pairs = df.select(key, member).distinct()
    groups = pairs.groupBy(key).agg(F.count("*").alias("members")).where("members > 1").orderBy(key).limit(n)
    listed = Window.partitionBy(key).orderBy(member)
    names = (
        pairs.join(F.broadcast(groups.select(key)), key)
        .withColumn("__rank", F.row_number().over(listed)).where(F.col("__rank") <= shown)
        .groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(member)), ";").alias("sample"))
    )
    return groups.join(names, key)
