"""Dedup, ranking and top-1 jobs.

``top_per_key`` filters a ``row_number`` window; Spark then keeps at most k rows per key and
map task before the shuffle, so a key that holds a third of all rows never lands whole in one
task. Group facts are aggregated (map-side combine) and joined back instead of being computed
by whole-partition windows. Text bodies stay out of every ranking: only ids, lengths and
digests are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, ids
from ..functions import text as X
from .lineage import cut


def top_per_key(df: DataFrame, keys: Sequence, order: Sequence[Column], k: int = 1) -> DataFrame:
    """First k rows of each key; null keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") <= k).drop("__rank")


def joined_set(df: DataFrame, keys: Sequence[str], column: str, sep: str = ";") -> DataFrame:
    """Sorted distinct non-blank values per key as one cell; repeats vanish before the gather."""
    values = df.where(~X.is_blank(column)).select(*keys, column).distinct()
    return values.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(column)), sep).alias(column)
    )


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    provenance: str | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """One row per key with merged provenance; rows whose first key is null pass untouched.

    ``extra`` keys count only where the column exists.
    """
    all_keys = list(keys) + [c for c in extra if c in df.columns]
    keyed = df.where(F.col(keys[0]).isNotNull())
    loose = df.where(F.col(keys[0]).isNull())
    best = top_per_key(keyed, all_keys, order)
    if provenance and provenance in df.columns:
        merged = joined_set(keyed, all_keys, provenance).select(
            *[F.col(k).alias(f"__{k}") for k in all_keys], F.col(provenance).alias("__merged"))
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in all_keys]
        best = best.join(merged, same, "left").withColumn(
            provenance, F.coalesce("__merged", F.lit("")))
    return best.select(*df.columns).unionByName(loose)


def dedup_cases(df: DataFrame, position: Sequence[str]) -> DataFrame:
    """One row per ECLI: a reconciled catalogue row first, else the first seen."""
    order = [F.col(c).asc_nulls_last() for c in position]
    if "metadata_catalog_source" in df.columns:
        reconciled = F.coalesce(F.lower("metadata_catalog_source"), F.lit("")) == "infocuria"
        order.insert(0, reconciled.desc())
    return dedup_by_key(df, ["ecli"], order, provenance="source_window")


def text_candidates(texts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Narrow ranking rows: normalised key, effective source, length, rank and digest; bodies are read once."""
    narrow = cut(texts.select(
        *keep,
        "text_id",
        ids.norm_ecli("ecli").alias("ecli"),
        F.upper(X.strip("language")).alias("language"),
        "text_source",
        X.body_length("text").alias("length"),
        X.body_digest("text").alias("digest"),
    ))
    longest = narrow.groupBy("ecli").agg(F.max("length").alias("longest"))
    return (
        narrow.join(longest, "ecli")
        .withColumn("effective_source", X.effective_source("text_source", "length", "longest"))
        .withColumn("rank", X.source_rank("effective_source", "length"))
    )


def best_text(texts: DataFrame, position: Sequence[str] = ("text_id",)) -> DataFrame:
    """Best rendition per (ECLI, language) as narrow rows; ties by input position."""
    candidates = text_candidates(texts, keep=[c for c in position if c != "text_id"])
    order = [F.col("rank").asc()] + [F.col(c).asc() for c in position]
    return top_per_key(candidates, ["ecli", "language"], order)


def latest_per_key(df: DataFrame, keys: Sequence[str], snapshot: str, tie: Sequence[str]) -> DataFrame:
    """Newest snapshot per key, missing snapshots last."""
    order = [F.col(snapshot).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie]
    return top_per_key(df, keys, order)


def doctype_rank(c) -> Column:
    c = F.upper(X.as_col(c))
    return X.first_rule(
        [(F.contains(c, F.lit("JUD")), F.lit(1)), (F.contains(c, F.lit("DEC")), F.lit(2)),
         (F.contains(c, F.lit("COM")), F.lit(3))], F.lit(4))


def case_group_key(ecli, number, reference_date) -> Column:
    """ECLI, else a digest of number and date (number lists can be very long)."""
    fallback = F.concat(
        F.coalesce(X.as_col(number), F.lit("?")), F.lit(":"),
        F.coalesce(X.as_col(reference_date).cast("string"), F.lit("")),
    )
    return F.coalesce(ids.norm_ecli(ecli), F.concat(F.lit("APPNO:"), F.md5(fallback.cast("binary"))))


def canonical_variant(docs: DataFrame) -> DataFrame:
    """One variant per case group: English, French, other; judgment, decision, other; lowest id."""
    language = X.first_rule(
        [(F.col("language_code") == "ENG", F.lit(0)), (F.col("language_code") == "FRE", F.lit(1))], F.lit(2))
    ranked = (
        docs.where(~F.col("doctype").isin("PR", "CLIN", "CLINF"))
        .withColumn("case_key", case_group_key("ecli", "appno", "reference_date"))
        .withColumn("__lang", language)
        .withColumn("__doc", doctype_rank("doctype"))
    )
    order = [F.col("__lang").asc(), F.col("__doc").asc(), F.col("item_id").asc()]
    return top_per_key(ranked, ["case_key"], order).drop("__lang", "__doc")


EDGE_KEY = ("source_case_id", "relation_type", "source_dataset", "target_case_id",
            "target_ecli_raw", "target_celex_raw")


def dedup_edges(edges: DataFrame, keys: Sequence[str] = EDGE_KEY, id_col: str = "edge_id") -> DataFrame:
    """Lowest id per logical edge; null targets count as equal."""
    return top_per_key(edges, list(keys), [F.col(id_col).asc()])


def dedup_law_refs(refs: DataFrame) -> DataFrame:
    """Raw references keep their best-resolved row; resolved-only rows dedup on the resolution."""
    raw = refs.where(F.col("raw_resource").isNotNull())
    resolved_only = refs.where(F.col("raw_resource").isNull())
    raw_best = top_per_key(
        raw.withColumn("__sub", F.coalesce("raw_subdivision", F.lit(""))),
        ["case_id", "role", "source_dataset", "raw_scheme", "raw_resource", "__sub"],
        [F.col("provision_id").desc_nulls_last(), F.col("ref_id").asc()],
    ).drop("__sub")
    resolved_best = top_per_key(
        resolved_only,
        ["case_id", "role", "source_dataset", "legislation_id", "provision_id"],
        [F.col("ref_id").asc()],
    )
    return raw_best.unionByName(resolved_best)


def split_primary(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], id_col: str) -> tuple[DataFrame, DataFrame]:
    """Best row per key, and all the others."""
    primary = top_per_key(rows, keys, order)
    rest = rows.join(primary.select(id_col), id_col, "left_anti")
    return primary, rest


def origin_rank(source) -> Column:
    source = X.as_col(source)
    order = (fixed.SOURCE_RS, fixed.SOURCE_HUDOC, fixed.SOURCE_INFOCURIA, fixed.SOURCE_CELLAR)
    return X.first_rule([(source == s, F.lit(i + 1)) for i, s in enumerate(order)], F.lit(5))


def canonical_text(texts: DataFrame) -> DataFrame:
    """One row per (case, language), the corpus of origin first, then the lowest id."""
    return top_per_key(texts, ["case_id", "language"],
                       [origin_rank("text_source").asc(), F.col("text_id").asc()])


def text_for_scan(texts: DataFrame) -> DataFrame:
    """Row to scan per (case, language): no misfiled rows; decision, extract, other, summary."""
    kind = F.col("document_kind")
    preference = X.first_rule(
        [
            (kind.isin(*fixed.DECISION_KINDS), F.lit(0)),
            (kind == "extract", F.lit(1)),
            (kind == "summary", F.lit(3)),
        ],
        F.lit(2),
    )
    usable = texts.where(~kind.eqNullSafe("misfiled"))
    return top_per_key(usable, ["case_id", "language"],
                       [preference.asc(), origin_rank("text_source").asc(), F.col("text_id").asc()])


def dedup_identifiers(rows: DataFrame) -> DataFrame:
    """One row per (case, scheme, value); a primary row beats a secondary one."""
    return top_per_key(rows, ["case_id", "scheme", "value_normalized"],
                       [F.col("is_primary").desc(), F.col("source").asc(), F.col("value").asc()])


def rank_targets(expected: DataFrame, texts: DataFrame, markers=fixed.JUDGMENT_MARKERS_VERIFY) -> DataFrame:
    """Best stored row per expected (ECLI, CELEX): CELEX match, judgment, trusted source, length."""
    wanted = expected.select(
        ids.norm_ecli("ecli").alias("ecli"), F.upper(X.strip("celex")).alias("expected_celex"))
    rows = texts.select(
        ids.norm_ecli("ecli").alias("ecli"), "text_id", "text_source", "celex",
        F.transform(X.toks("celex"), F.upper).alias("__celexes"),
        F.length(F.coalesce("text", F.lit(""))).alias("length"),
        X.is_blank("text").alias("blank"),
        X.looks_like_judgment("text", markers).alias("judgment"),
    )
    hits = wanted.join(rows, "ecli").withColumn(
        "celex_match", F.array_contains("__celexes", F.col("expected_celex")))
    order = [F.col("celex_match").desc(), F.col("judgment").desc(),
             (F.col("text_source") == fixed.SOURCE_CELLAR).desc(), F.col("length").desc(),
             F.col("text_id").asc()]
    return top_per_key(hits.drop("__celexes"), ["ecli", "expected_celex"], order)


def ordered_strings(docs: DataFrame, case: str, value: str, doctype: str, item: str) -> DataFrame:
    """(case, ordinal, value): distinct strings of a case by document priority.

    A later variant stays only if it cites application numbers the first one lacks.
    """
    ranks = X.first_rule(
        [(F.col(doctype) == d, F.lit(i)) for i, d in enumerate(("HEJUD", "HEDEC", "HFJUD", "HFDEC"))], F.lit(4))
    rows = docs.where(~X.is_blank(value)).select(case, F.col(value).alias("value"), ranks.alias("r"), F.col(item).alias("item"))
    first_seen = rows.groupBy(case, "value").agg(F.min(F.struct("r", "item")).alias("at"))
    lead = first_seen.groupBy(case).agg(F.min_by("value", "at").alias("lead"))
    extra = F.array_except(ids.all_appnos("value"), ids.all_appnos("lead"))
    kept = first_seen.join(lead, case).where((F.col("value") == F.col("lead")) | (F.size(extra) > 0))
    return kept.select(case, "value", F.col("at.r").alias("priority"), F.col("at.item").alias("item"))


def dedup_targets(edges: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One edge per (source, target); the first citing entry wins."""
    return top_per_key(edges, ["source_case_id", "target_case_id"], order)


def article_refs(articles: DataFrame, code_map: DataFrame, broadcast_below: int = 100_000) -> DataFrame:
    """Code map applied to (case, code, kind); one row per (case, provision, kind)."""
    small = code_map.limit(broadcast_below + 1).count() <= broadcast_below
    table = F.broadcast(code_map) if small else code_map
    hits = articles.join(table, "article_code")
    return top_per_key(hits, ["case_id", "provision_id", "kind"],
                       [X.strip("article_code").asc(), F.col("raw_subdivision").asc_nulls_last()])
