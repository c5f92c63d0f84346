"""Coverage, topology, counting and report jobs.

Distinct counts and joined sets deduplicate (key, value) first, so one hot key is spread over
its values. Medians work on a (key, length, count) histogram, never on the raw rows of a key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, ids
from ..functions import text as X
from .joins import small_side
from .lineage import cut

#: numbers that may be broadcast: a row is one long
_BROADCAST_KEYS = 1_000_000


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def metrics(df: DataFrame, named: Mapping[str, Column]) -> DataFrame:
    """One aggregation pass, returned as (metric, value) rows."""
    row = df.agg(*[expr.cast("long").alias(name) for name, expr in named.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in named])
    return row.select(F.inline(pairs))


def atoms(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(X.toks(column)).alias("atom"))


def coverage_by_decade(cases: DataFrame, texts: DataFrame) -> DataFrame:
    """Cases per decade, those with a text of 200 or more characters, and the percentage."""
    with_text = texts.where(F.length("text") >= fixed.TEXT_MIN_CHARS).select("ecli").distinct()
    year = F.year(X.parse_date(X.min_tok("date_publication")))
    dated = cases.select("ecli", (F.floor(year / 10) * 10).alias("decade")).where("decade IS NOT NULL")
    flagged = dated.join(with_text.withColumn("has_text", F.lit(1)), "ecli", "left")
    counted = flagged.groupBy("decade").agg(
        F.count("*").alias("cases"), F.count("has_text").alias("with_text"))
    return counted.withColumn("percent", F.round(100 * F.col("with_text") / F.col("cases"), 1))


def atom_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each atom among all atoms of the column."""
    counts = atoms(df, column).groupBy("atom").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n"))
    return counts.withColumn("percent", F.round(100 * F.col("n") / total.scalar(), 1))


def top_atoms(df: DataFrame, column: str, n: int) -> DataFrame:
    counts = atoms(df, column).groupBy("atom").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("atom")).limit(n)


def dup_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg((F.count(column) - F.count_distinct(column)).alias("duplicates"))


def citation_topology(cases: DataFrame, cites: str = "cites", celex: str = "celex") -> DataFrame:
    """All citation tokens, and how many land inside the corpus."""
    targets = atoms(cases, cites).groupBy("atom").agg(F.count("*").alias("n"))
    held = atoms(cases, celex).distinct().withColumn("held", F.lit(1))
    joined = targets.join(held, "atom", "left")
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("held") == 1, F.col("n"))), F.lit(0)).alias("internal"),
        F.coalesce(F.sum(F.when(F.col("held").isNull(), F.col("n"))), F.lit(0)).alias("external"),
    )


def case_medians(lengths: DataFrame, key: str = "case_id") -> DataFrame:
    """Median length per case from its length histogram."""
    histogram = lengths.groupBy(key, "length").agg(F.count("*").alias("n"))
    return histogram.groupBy(key).agg(F.percentile("length", F.lit(0.5), F.col("n")).alias("median"))


def flag_stubs(texts: DataFrame, ratio: float = fixed.STUB_RATIO, min_median: int = fixed.STUB_MIN_MEDIAN,
               excluded_source: str = fixed.SOURCE_RS) -> DataFrame:
    """Stub flag per text; the median must exceed the limit, one source stays out."""
    lengths = texts.where(F.col("text").isNotNull() & (F.col("text_source") != excluded_source)).select(
        "text_id", "case_id", F.length("text").alias("length"))
    flagged = lengths.join(case_medians(lengths), "case_id")
    return flagged.withColumn(
        "is_stub", (F.col("length") < ratio * F.col("median")) & (F.col("median") > min_median))


def stub_index(texts: DataFrame, ratio: float = fixed.STUB_INDEX_RATIO,
               min_median: int = fixed.STUB_INDEX_MIN_MEDIAN) -> DataFrame:
    """Texts far below the median of their ECLI; the median limit is inclusive."""
    rows = texts.select("text_id", "ecli", F.upper("language").alias("language"),
                        F.length("text").alias("length")).where(
        (F.col("length") > 0) & (F.coalesce("ecli", F.lit("")) != "") & (F.coalesce("language", F.lit("")) != ""))
    return (
        rows.join(case_medians(rows, "ecli").where(F.col("median") >= min_median), "ecli")
        .where(F.col("length") < ratio * F.col("median"))
        .select("ecli", "language", "length", "text_id")
    )


def pivot_national(kv: DataFrame, key: str, kinds: Sequence[str]) -> DataFrame:
    """(key, col, val) rows to one column per kind, the greatest value each."""
    return kv.groupBy(key).agg(*[F.max(F.when(F.col("col") == k, F.col("val"))).alias(k) for k in kinds])


def citation_counts(edges: DataFrame) -> DataFrame:
    """Outgoing and incoming edges per case in one pass over the edges."""
    sides = edges.select(F.inline(F.array(
        F.struct(F.col("source_case_id").alias("case_id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("target_case_id").alias("case_id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    ))).where("case_id IS NOT NULL")
    return sides.groupBy("case_id").agg(F.sum("o").alias("cites_count"), F.sum("i").alias("cited_by_count"))


def counted_edges(edges: DataFrame, relations: DataFrame, datasets: DataFrame) -> DataFrame:
    """Resolved edges without self-loops, of counted relation types and registered datasets.

    Both lists are a few rows: a shuffle by relation type would deal all edges to a few tasks.
    """
    return (
        edges.where("target_case_id IS NOT NULL AND source_case_id <> target_case_id")
        .join(small_side(relations.where("counted").select("relation_type").distinct()), "relation_type", "left_semi")
        .join(small_side(datasets.where("counted").select("source_dataset").distinct()), "source_dataset", "left_semi")
    )


def refresh_counts(edges: DataFrame, relations: DataFrame, datasets: DataFrame, cases: DataFrame,
                   subset: DataFrame | None = None) -> DataFrame:
    """Distinct targets and distinct citing cases for every case, or for a subset of cases."""
    counted = counted_edges(edges, relations, datasets).select("source_case_id", "target_case_id")
    if subset is None:
        wanted, counts = cases.select("case_id"), citation_counts(counted.distinct())
    else:
        # sides of other cases are left out before edges are made distinct
        keys = small_side(subset.select("case_id").where("case_id IS NOT NULL").distinct(), _BROADCAST_KEYS)
        wanted = cases.join(keys, "case_id", "left_semi").select("case_id")
        side = lambda mine, other, out: F.struct(F.col(mine).alias("case_id"), F.col(other).alias("other"), F.lit(out).alias("out"))
        sides = counted.select(F.inline(F.array(side("source_case_id", "target_case_id", 1), side("target_case_id", "source_case_id", 0))))
        counts = sides.join(keys, "case_id", "left_semi").distinct().groupBy("case_id").agg(
            F.sum("out").alias("cites_count"), F.sum(1 - F.col("out")).alias("cited_by_count"))
    return wanted.join(counts, "case_id", "left").select(
        "case_id", F.coalesce("cites_count", F.lit(0)).alias("cites_count"),
        F.coalesce("cited_by_count", F.lit(0)).alias("cited_by_count"))


def cited_by(edges: DataFrame, units: DataFrame, cap: int = 300) -> DataFrame:
    """Distinct citing units per target; sources with more than ``cap`` rows do not count."""
    resolved = edges.where("target_case_id IS NOT NULL")
    heavy = edges.groupBy("source_case_id").count().where(F.col("count") > cap).select("source_case_id")
    light = resolved.join(heavy, "source_case_id", "left_anti")
    unit = F.coalesce("unit", F.concat(F.lit("case:"), F.col("source_case_id").cast("string")))
    named = light.join(units, "source_case_id", "left").withColumn("unit", unit)
    return named.select("target_case_id", "unit").distinct().groupBy("target_case_id").agg(
        F.count("*").alias("cited_by"))


def target_catalog(docs: DataFrame, case: str = "case_id") -> DataFrame:
    """One row per case: document kinds, branch, preferred name and conclusion, owned numbers."""
    has = lambda word: F.bool_or(F.contains(F.upper("doctype"), F.lit(word)))
    prefer = lambda c: F.coalesce(
        F.max(F.when(F.col("doctype") == "HEJUD", F.col(c))),
        F.max(F.when(F.col("doctype") == "HFJUD", F.col(c))), F.max(c))
    facts = docs.groupBy(case).agg(
        has("JUD").alias("has_jud"), has("DEC").alias("has_dec"), has("COM").alias("has_com"),
        F.bool_or(F.upper(F.coalesce("doctype_branch", F.lit(""))) == "GRANDCHAMBER").alias("is_gc"),
        prefer("docname").alias("docname"), prefer("conclusion").alias("conclusion"),
        F.min("ecli").alias("ecli"), F.min("item_id").alias("item_id"), F.min("decided").alias("date_decision"),
    )
    numbers = (
        docs.select(case, F.explode(ids.all_appnos("appno")).alias("appno")).distinct()
        .groupBy(case).agg(F.array_sort(F.collect_list("appno")).alias("appnos"))
    )
    kind = X.first_rule(
        [(F.col("has_jud"), F.lit("judgment")), (F.col("has_dec"), F.lit("decision")),
         (F.col("has_com"), F.lit("communicated"))], F.lit("other"))
    own = ids.appno_from_ecli("ecli")
    return (
        facts.join(numbers, case, "left")
        .withColumn("kind", kind)
        .withColumn("appnos", F.coalesce("appnos", F.when(own.isNotNull(), F.array(own)), F.array().cast("array<string>")))
    )


def language_buckets(texts: DataFrame) -> DataFrame:
    """Cases by number of languages."""
    pairs = texts.select("case_id", "language").distinct()
    counts = pairs.groupBy("case_id").agg(F.count("language").alias("n"))
    n = F.col("n")
    bucket = X.first_rule(
        [(n <= 1, F.lit("1")), (n <= 4, F.lit("2-4")), (n <= 9, F.lit("5-9")), (n <= 19, F.lit("10-19"))], F.lit("20+"))
    return counts.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("cases"))


def snapshot(cases: DataFrame, texts: DataFrame, edges: DataFrame) -> DataFrame:
    """Named scalars of the corpus: control metrics must stay, moving ones may change."""
    parts = [
        ("control", metrics(cases, {"cases": F.count("*"), "distinct_eclis": F.count_distinct("ecli")})),
        ("moving", metrics(texts, {
            "texts": F.count("*"), "text_chars": F.sum(F.length("text")),
            "cellar_texts": F.count_if(F.col("text_source") == fixed.SOURCE_CELLAR)})),
        ("control", metrics(edges, {
            "edges": F.count("*"), "resolved_edges": F.count("target_case_id"),
            "citing_cases": F.count_distinct("source_case_id")})),
    ]
    return union_all(df.withColumn("kind", F.lit(kind)) for kind, df in parts)


def diff_snapshots(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both values per metric and the verdict: a control metric may not move."""
    joined = (
        old.select("metric", "kind", F.col("value").alias("before"))
        .join(new.select("metric", F.col("kind").alias("new_kind"), F.col("value").alias("after")), "metric", "full_outer")
        .withColumn("kind", F.coalesce("kind", "new_kind"))
    )
    same = F.col("before").eqNullSafe(F.col("after"))
    verdict = X.first_rule([(same, F.lit("same")), (F.col("kind") == "control", F.lit("violation"))], F.lit("changed"))
    return joined.select("metric", "kind", "before", "after", verdict.alias("verdict"))


def dataset_breakdown(refs: DataFrame) -> DataFrame:
    return refs.groupBy("source_dataset").agg(
        F.count("*").alias("refs"), F.count("legislation_id").alias("with_act"),
        F.count("provision_id").alias("with_provision"),
        F.count_if(F.col("legislation_id").isNotNull() | F.col("provision_id").isNotNull()).alias("resolved"),
        F.count_distinct("case_id").alias("cases"))


def degree_summary(edges: DataFrame) -> DataFrame:
    """Out-degree statistics of distinct pairs; percentiles are nearest rank, not interpolated.

    Percentiles read the histogram of degrees: at most sqrt(2 * edges) rows.
    """
    pairs = edges.select("source_case_id", "target_case_id").distinct()
    degrees = pairs.groupBy("source_case_id").agg(F.count("*").alias("degree"))
    histogram = degrees.groupBy("degree").agg(F.count("*").alias("n"))
    running = Window.orderBy("degree").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = histogram.agg(F.sum("n"))
    ranked = histogram.withColumn("upto", F.sum("n").over(running)).withColumn("sources", total.scalar())
    # value at zero-based position i = smallest degree whose running count exceeds i
    at = lambda p: F.min(F.when(
        F.col("upto") > F.least(F.col("sources") - 1, F.bround(F.lit(p) * (F.col("sources") - 1)).cast("long")),
        F.col("degree")))
    d, n = F.col("degree"), F.col("n")
    out = ranked.agg(
        F.max("sources").alias("sources"), F.sum(d * n).alias("edges"),
        F.round(F.sum(d * n) / F.max("sources"), 2).alias("mean_degree"),
        at(0.50).alias("p50"), at(0.90).alias("p90"), at(0.99).alias("p99"), F.max(d).alias("max_degree"),
        F.coalesce(F.sum(F.when(d > 100, n)), F.lit(0)).alias("over_100"),
        F.coalesce(F.sum(F.when(d > 300, n)), F.lit(0)).alias("over_300"),
        F.coalesce(F.sum(F.when(d > 300, d * n)), F.lit(0)).alias("over_300_edges"),
    )
    targets = pairs.agg(F.count_distinct("target_case_id"))
    return out.withColumn("targets", targets.scalar())


def body_rows(texts: DataFrame) -> DataFrame:
    """Narrow row per text: key, source, digest and flags; the body itself stays behind."""
    return texts.select(
        F.coalesce(X.strip("ecli"), F.lit("")).alias("ecli"),
        F.coalesce(F.lower(X.strip("language")), F.lit("")).alias("language"),
        F.coalesce("text_source", F.lit("")).alias("text_source"),
        F.coalesce(F.col("celex").rlike(fixed.DERIVED_ANYWHERE), F.lit(False)).alias("derived"),
        X.is_blank("text").alias("blank"), X.body_digest("text").alias("digest"),
    )


def shared_body_groups(rows: DataFrame) -> DataFrame:
    """Bodies of 500 or more characters held by several ECLIs in one language (from body rows)."""
    per_ecli = rows.where("digest IS NOT NULL").groupBy("language", "digest", "ecli").agg(
        F.bool_or(F.col("text_source") != fixed.SOURCE_CELLAR).alias("untrusted"))
    return per_ecli.groupBy("language", "digest").agg(
        F.count("*").alias("eclis"), F.bool_or("untrusted").alias("gated")).where("eclis > 1")


def integrity_report(cases: DataFrame, texts: DataFrame) -> DataFrame:
    """(metric, value) rows of a build: duplicates, blanks, malformed and missing rows, sources."""
    c = cases.select(F.coalesce(X.strip("ecli"), F.lit("")).alias("ecli"), ids.primary_celex("celex").alias("celex"))
    x = cut(body_rows(texts))  # the only pass over the bodies
    per_ecli = c.groupBy("ecli").agg(F.count("*").alias("n"))
    known = F.col("ecli") != ""
    case_rows = metrics(per_ecli, {
        "cases_rows": F.sum("n"), "unique_case_eclis": F.count_if(known),
        "blank_case_eclis": F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)),
        "duplicate_case_eclis": F.count_if(known & (F.col("n") > 1))})
    identified = c.where(known & (F.col("celex") != ""))
    celex_users = identified.distinct().groupBy("celex").agg(F.count("*").alias("users"))
    celex_rows = metrics(celex_users, {"duplicate_celex_groups": F.count_if(F.col("users") > 1)})
    malformed = metrics(identified, {"malformed_celex": F.count_if(
        F.col("celex").startswith("6") & ~F.col("celex").rlike(fixed.SECTOR6_PATTERN))})
    per_pair = x.groupBy("ecli", "language").agg(F.count("*").alias("n"), F.bool_or(~F.col("blank")).alias("filled"))
    pair_rows = metrics(per_pair, {
        "fulltexts_rows": F.sum("n"), "duplicate_ecli_language_pairs": F.count_if(F.col("n") > 1)})
    flags = metrics(x, {
        "empty_language_placeholders": F.count_if("blank"),
        "derived_empty_placeholders": F.count_if(F.col("blank") & F.col("derived")),
        "derived_fulltext_bodies": F.count_if(~F.col("blank") & F.col("derived"))})
    case_eclis = per_ecli.where(known).select("ecli")
    text_eclis = per_pair.where(known).groupBy("ecli").agg(F.bool_or("filled").alias("filled"))
    missing = metrics(text_eclis.join(case_eclis, "ecli", "left_anti"), {"fulltext_eclis_not_in_cases": F.count("*")})
    uncovered = metrics(case_eclis.join(text_eclis.where("filled"), "ecli", "left_anti"),
                        {"cases_without_any_fulltext": F.count("*")})
    shared = metrics(shared_body_groups(x), {
        "shared_text_bodies": F.count_if("gated"), "shared_cellar_only_bodies": F.count_if(~F.col("gated"))})
    sources = x.where(~F.col("blank")).groupBy("text_source").agg(F.count("*").alias("value")).select(
        F.concat(F.lit("source:"), "text_source").alias("metric"), "value")
    return union_all([case_rows, celex_rows, malformed, pair_rows, flags, missing, uncovered, shared, sources])


def checksum(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("cites_count"), F.lit(0)).alias("sum_cites"),
        F.coalesce(F.sum("cited_by_count"), F.lit(0)).alias("sum_cited_by"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """(metric, value): child rows whose key has no parent."""
    lone = child.where(F.col(key).isNotNull()).join(parent, child[key] == parent[parent_key], "left_anti")
    return lone.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")


def reconcile(named_counts: Mapping[str, DataFrame], orphan_checks: Iterable[DataFrame]) -> DataFrame:
    """Row counts and orphan checks; the status column marks orphans that are not 0."""
    counts = [df.agg(F.count("*").alias("value")).select(F.lit(n).alias("metric"), "value", F.lit("count").alias("check"))
              for n, df in named_counts.items()]
    checks = [df.select("metric", "value", F.lit("orphan").alias("check")) for df in orphan_checks]
    status = F.when((F.col("check") == "orphan") & (F.col("value") > 0), "fail").otherwise("ok")
    return union_all(counts + checks).withColumn("status", status)


def reconcile_pairs(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts of both sides per name, with the difference."""
    return (
        source.select("name", F.col("n").alias("source_n"))
        .join(target.select("name", F.col("n").alias("target_n")), "name", "full_outer")
        .select("name", F.coalesce("source_n", F.lit(0)).alias("source_n"), F.coalesce("target_n", F.lit(0)).alias("target_n"))
        .withColumn("diff", F.col("target_n") - F.col("source_n"))
        .withColumn("equal", F.col("diff") == 0)
    )


def date_window(cases: DataFrame) -> DataFrame:
    day = X.parse_date(X.min_tok("date_publication"))
    return cases.agg(F.min(day).cast("string").alias("first_day"), F.max(day).cast("string").alias("last_day"))


def reference_counts(refs: DataFrame) -> DataFrame:
    """References per (act, label) with the joined set of datasets."""
    keys = ["raw_resource", "raw_label_id"]
    per_dataset = refs.groupBy(*keys, "source_dataset").agg(F.count("*").alias("n"))
    cases = refs.select(*keys, "case_id").distinct().groupBy(*keys).agg(F.count("*").alias("cases"))
    joined = per_dataset.groupBy(*keys).agg(
        F.sum("n").alias("refs"), F.array_join(F.array_sort(F.collect_list("source_dataset")), ";").alias("sources"))
    same = [joined[k].eqNullSafe(cases[k]) for k in keys]
    return joined.join(cases, same).select(*[joined[k] for k in keys], "refs", "sources", "cases")


def link_stats(records: DataFrame) -> DataFrame:
    """Rows per dataset and outcome."""
    return records.groupBy("source_dataset", "status").agg(F.count("*").alias("n"))


def build_dimension(df: DataFrame, column: str, existing: DataFrame, name: str = "name") -> DataFrame:
    """New distinct values of a column that the dimension does not hold yet."""
    fresh = df.select(F.col(column).alias(name)).where(F.col(name).isNotNull() & (F.col(name) != "")).distinct()
    return fresh.join(existing.select(name), name, "left_anti")
