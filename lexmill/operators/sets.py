"""Set operations, build comparison and parity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from .aggregates import union_all


def provision_labels(refs: DataFrame, cases: DataFrame, acts: DataFrame, provisions: DataFrame) -> DataFrame:
    """Distinct (ECLI, label) from six label sources.

    References are narrow when they meet the catalogue, and the case comes last, once. The catalogue has one row a key and
    is small beside the references, which need no sorting to meet it.
    """
    r = refs.where("raw_scheme = 'bwb'").select("case_id", "raw_reference", "raw_resource", "raw_subdivision", "raw_label_id")
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    titled = provisions.where(filled("title"))
    act = acts.where(filled("title")).select(F.col("bwb_id").alias("raw_resource"), F.col("title").alias("act_title")).distinct().hint("shuffle_hash")
    titles = lambda df, *keys: df.groupBy(*keys).agg(F.collect_set("title").alias("titles")).hint("shuffle_hash")
    by_label = titles(titled, F.col("bwb_label_id").alias("raw_label_id"))
    by_article = titles(titled.where("element_type = 'artikel'"), F.col("bwb_id").alias("raw_resource"), F.lower("number").alias("article"))
    of_act = F.when(filled("raw_subdivision"), F.array(
        "act_title", F.concat("act_title", F.lit(", Artikel "), "raw_subdivision"), F.concat("act_title", F.lit(", Bijlage "), "raw_subdivision"))).otherwise(F.array("act_title"))
    labels = lambda df, many: df.select("case_id", F.explode(many).alias("label"))
    found = union_all([
        r.where(filled("raw_reference")).select("case_id", F.col("raw_reference").alias("label")),
        labels(r.join(by_label, "raw_label_id"), "titles"),
        labels(r.withColumn("article", F.lower("raw_subdivision")).join(by_article, ["raw_resource", "article"]), "titles"),
        labels(r.join(act, "raw_resource"), of_act),
    ])
    return found.join(cases.select("case_id", "ecli").hint("merge"), "case_id").select("ecli", "label").distinct()


def baseline_diff(new_cases: DataFrame, new_texts: DataFrame, old_cases: DataFrame, old_texts: DataFrame) -> DataFrame:
    """(metric, value): keys lost and gained, trusted texts lost, language pairs lost per language."""
    eclis = lambda df: df.select(X.strip("ecli").alias("ecli")).where("ecli <> ''").distinct()
    filled = lambda df: df.where(~X.is_blank("text"))
    trusted = lambda df: eclis(filled(df).where(F.col("text_source") == fixed.SOURCE_CELLAR))
    pairs = lambda df: filled(df).select(X.strip("ecli").alias("ecli"), F.lower(X.strip("language")).alias("language")).distinct()
    count = lambda df, name: df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")
    lost_pairs = pairs(old_texts).join(pairs(new_texts), ["ecli", "language"], "left_anti")
    return union_all([
        count(eclis(new_cases).join(eclis(old_cases), "ecli", "left_anti"), "new_eclis"),
        count(eclis(old_cases).join(eclis(new_cases), "ecli", "left_anti"), "lost_eclis"),
        count(trusted(old_texts).join(trusted(new_texts), "ecli", "left_anti"), "lost_cellar_eclis"),
        count(lost_pairs, "lost_nonempty_language_pairs"),
        lost_pairs.groupBy("language").agg(F.count("*").alias("value")).select(
            F.concat(F.lit("lost_pairs:"), "language").alias("metric"), "value"),
    ])


def compare_edges(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("source_case_id", "target_case_id")) -> DataFrame:
    """Distinct pairs of both builds with status kept, dropped or added."""
    keys = list(keys)
    sides = old.select(*keys).withColumn("side", F.lit(1)).unionByName(new.select(*keys).withColumn("side", F.lit(2)))
    merged = sides.groupBy(*keys).agg(F.bit_or("side").alias("s"))
    status = X.first_rule([(F.col("s") == 3, F.lit("kept")), (F.col("s") == 1, F.lit("dropped"))], F.lit("added"))
    return merged.select(*keys, status.alias("status"))


def classify_drops(dropped: DataFrame, sources: DataFrame, targets: DataFrame, entries: DataFrame, edges: DataFrame) -> DataFrame:
    """Why a pair was dropped, by eleven ordered reasons.

    sources: case_id, date_decision of cases with a citation string; targets: catalogue rows;
    entries: (source_case_id, decision_cue, appnos); edges: new pairs with the matched number.
    """
    pairs = dropped.select("source_case_id", "target_case_id").distinct()
    src = sources.select(F.col("case_id").alias("source_case_id"), F.col("date_decision").alias("source_date"), F.lit(True).alias("has_scl"))
    tgt = targets.select(F.col("case_id").alias("target_case_id"), "kind", F.col("date_decision").alias("target_date"), F.lit(True).alias("known"))
    owned = targets.select(F.col("case_id").alias("target_case_id"), F.explode("appnos").alias("appno"))
    facts = pairs.join(src, "source_case_id", "left").join(tgt, "target_case_id", "left")
    # one row per (source, number): whether any / every entry with it carries the decision cue
    wanted = pairs.join(owned, "target_case_id")
    cited = entries.select("source_case_id", F.explode("appnos").alias("appno"), "decision_cue").groupBy(
        "source_case_id", "appno").agg(F.bool_or("decision_cue").alias("any_cue"), F.bool_and("decision_cue").alias("all_cue"))
    matched = wanted.join(cited, ["source_case_id", "appno"]).groupBy("source_case_id", "target_case_id").agg(
        F.bool_or("any_cue").alias("any_cue"), F.bool_and("all_cue").alias("all_cue"))
    # numbers a source reaches in the new build: the matched one and all owned by its targets
    reached = edges.select("source_case_id", "appno").unionByName(
        edges.select("source_case_id", "target_case_id").join(owned, "target_case_id").select("source_case_id", "appno")).distinct()
    chosen = wanted.join(reached, ["source_case_id", "appno"], "left_semi").select("source_case_id", "target_case_id").distinct()
    keys = ["source_case_id", "target_case_id"]
    rows = facts.join(matched.withColumn("matched", F.lit(True)), keys, "left").join(chosen.withColumn("chosen", F.lit(True)), keys, "left")
    reason = X.first_rule([
        (F.col("source_case_id") == F.col("target_case_id"), F.lit("self_loop")),
        (F.col("known").isNull(), F.lit("missing_target_metadata")),
        (F.col("kind") == "communicated", F.lit("communicated_target")),
        (F.col("has_scl").isNull(), F.lit("source_no_scl")),
        (F.col("target_date") > F.col("source_date"), F.lit("future_target_date")),
        (F.col("matched").isNull(), F.lit("non_owner_appno_fanout")),
        (F.col("chosen").isNull(), F.lit("unmatched_with_owner_appno_in_scl")),
        ((F.col("kind") == "decision") & ~F.col("any_cue"), F.lit("wrong_doctype_decision_without_dec_cue")),
        ((F.col("kind") == "judgment") & F.col("all_cue"), F.lit("wrong_doctype_judgment_for_dec_cue")),
        (F.col("kind") == "judgment", F.lit("extra_judgment_for_same_appno")),
    ], F.lit("extra_decision_for_same_appno"))
    return rows.select(*keys, reason.alias("reason"))


def parity(expected: DataFrame, actual: DataFrame, keys: Sequence[str], name: str, long_text: Sequence[str] = ()) -> DataFrame:
    """Rows missing or extra per table; nulls match nulls, long texts compare by digest."""
    columns = [F.md5(F.col(k).cast("binary")).alias(k) if k in set(long_text) else F.col(k) for k in keys]
    sides = expected.select(*columns).withColumn("d", F.lit(1)).unionByName(actual.select(*columns).withColumn("d", F.lit(-1)))
    balance = sides.groupBy(*keys).agg(F.sum("d").alias("d")).where("d <> 0")
    status = F.when(F.col("d") > 0, "missing").otherwise("extra")
    return balance.select(F.lit(name).alias("table_name"), *keys, status.alias("status"), F.abs("d").alias("n"))


def column_rows(spark, frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column) rows from DataFrame schemas; no data is read."""
    rows = [(t, c) for t, df in frames.items() for c in df.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def column_coverage(columns: DataFrame, mapping: DataFrame) -> DataFrame:
    """Disposition of every source column; unmapped ones are marked missing."""
    return columns.join(mapping, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", F.coalesce("disposition", F.lit("MISSING")).alias("disposition"))


def conform(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Union of two batches: columns of the first keep their type, missing ones become null."""
    types = dict(df.dtypes)
    cast = extra.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in extra.columns])
    return df.unionByName(cast, allowMissingColumns=True)


