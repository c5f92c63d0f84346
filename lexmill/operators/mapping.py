"""Corpus rows to relational rows: cell fan-out, dimensions, case, text and law tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as X
from .aggregates import union_all
from .lineage import cut


def fan_out(df: DataFrame, keys: Sequence[str], cells: Mapping[str, str], firsts: Mapping[str, str] | None = None) -> DataFrame:
    """One wide row to (key, kind, value) rows: a single pass over all mapped cells; of ``firsts`` only the first token counts."""
    def pairs(tokens: Column, kind: str) -> Column:
        return F.transform(tokens, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    parts = [pairs(X.toks(column), kind) for column, kind in cells.items()]
    parts += [pairs(F.slice(X.toks(column), 1, 1), kind) for column, kind in (firsts or {}).items()]
    return df.select(*keys, F.inline(F.concat(*parts)))


def collect_uris(df: DataFrame, column: str) -> DataFrame:
    """Distinct URIs over the cells of a column."""
    uris = F.filter(X.toks(column), lambda v: v.startswith("http"))
    return df.select(F.explode(uris).alias("uri")).distinct()


def rewrite_cell(df: DataFrame, key: str, column: str, table: DataFrame, old: str, new: str) -> DataFrame:
    """Map URIs through a table, drop unmapped ones, keep first occurrences in order.

    The table may be large, so it is joined token by token. Only rows that hold a URI are
    exploded; a cell is rebuilt from the tokens it started with.
    """
    has_uri = F.exists(X.toks(column), lambda v: v.startswith("http"))
    tokens = df.where(has_uri).select(key, F.posexplode(X.toks(column)).alias("pos", "tok"))
    mapped = (
        tokens.join(table.select(F.col(old).alias("tok"), F.col(new).alias("mapped")), "tok", "left")
        .withColumn("tok", F.when(F.col("tok").startswith("http"), F.col("mapped")).otherwise(F.col("tok")))
        .where(F.col("tok").isNotNull())
    )
    firsts = mapped.groupBy(key, "tok").agg(F.min("pos").alias("pos"))
    cells = firsts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("items"))
    joined = cells.select(key, F.array_join(F.col("items.tok"), ";").alias(column))
    rest = df.withColumn(column, F.when(~has_uri, F.array_join(X.toks(column), ";")).otherwise(""))
    return (
        rest.join(joined.withColumnRenamed(column, "__cell"), key, "left")
        .withColumn(column, F.coalesce("__cell", column))
        .drop("__cell")
    )


def case_identifiers(cases: DataFrame, echr_docs: DataFrame, rs_docs: DataFrame | None = None) -> DataFrame:
    """Identifier rows of every scheme in normal form; a primary row beats a secondary one.

    cases: case_id, ecli, celex_id; echr_docs: case_id, ecli, appno; rs_docs: case_id, ecli_raw,
    zaaknummer, replaces_identifier.
    """
    from .dedup import dedup_identifiers

    def rows(df, scheme, raw, norm, source, primary, celex=None):
        return df.select(
            "case_id", F.lit(scheme).alias("scheme"), raw.alias("value"), norm.alias("value_normalized"), F.lit(source).alias("source"),
            F.lit(primary).alias("is_primary"), (celex if celex is not None else F.lit(None).cast("string")).alias("celex"))

    celex = F.col("celex_id")
    number = ids.case_number("celex_id")
    parts = [
        rows(cases, "ecli", F.col("ecli"), ids.norm_ecli("ecli"), "cases.ecli", True, celex),
        rows(cases, "celex", celex, F.upper(X.strip("celex_id")), "cases.celex_id", True, celex),
        rows(cases, "cjeu_case_number", number, number, "cases.case_number", True, celex),
        rows(echr_docs, "ecli", F.col("ecli"), ids.norm_ecli("ecli"), "documents.ecli", False),
        rows(echr_docs, "echr_appno", F.col("appno"), ids.norm_appno("appno"), "documents.appno", False),
    ]
    if rs_docs is not None:
        docket = F.regexp_replace(F.upper("zaaknummer"), r"\s", "")
        replaced = F.col("replaces_identifier")
        old_ecli = F.when(F.upper(replaced).startswith("ECLI:"), ids.norm_ecli("replaces_identifier"))
        ljn = X.blank_to_null(F.regexp_extract(F.upper(replaced), r"\b([A-Z]{2}[0-9]{4})\b", 1))
        parts += [
            rows(rs_docs, "ecli", F.col("ecli_raw"), ids.norm_ecli("ecli_raw"), "rs.ecli", True),
            rows(rs_docs, "nl_zaaknummer", F.col("zaaknummer"), docket, "rs.zaaknummer", False),
            rows(rs_docs, "ecli", replaced, old_ecli, "rs.replaces", False),
            rows(rs_docs, "ljn", replaced, F.when(old_ecli.isNull(), ljn), "rs.replaces", False),
        ]
    return dedup_identifiers(union_all(parts).where("value_normalized IS NOT NULL"))


# --- corpus rows to relational tables ------------------------------------------

def map_cases(corpus: DataFrame) -> dict[str, DataFrame]:
    """Corpus rows to case, opinion, national, and (key, kind, value) satellite rows."""
    celex = X.first_tok("celex")
    kind = ids.celex_kind("__celex")
    number = ids.case_number("__celex")
    formation = X.first_tok("formation")
    rows = corpus.withColumn("__ecli", ids.norm_ecli("ecli")).withColumn("__celex", celex)
    case = rows.select(
        F.col("__ecli").alias("ecli"), F.col("__celex").alias("celex"),
        F.concat(F.lit("Case "), number).alias("title"),
        X.parse_date(X.min_tok("date_publication")).alias("date_decision"),
        F.coalesce(kind["court"], F.lit("CJEU")).alias("court_code"), ids.norm_lang("language_procedure").alias("lang"),
        kind["doctype"].alias("doctype"), number.alias("case_number"), ids.importance(formation).alias("importance"),
        ids.formation_code(formation).alias("formation_code"), X.first_tok("sector").alias("sector"),
        X.first_tok("type_procedure").alias("proc_type"))
    opinions = rows.where(kind["is_opinion"]).select(F.col("__ecli").alias("ecli"), X.first_tok("agents").alias("advocate_general"))
    keyed = rows.withColumn("ecli", F.col("__ecli"))
    satellites = fan_out(keyed, ["ecli"], {
        "subject_matter": "domain:subject", "type_procedure": "domain:procedure", "judges": "judge:judge",
        "agents": "party:agent", "cites": "cite:cites"}, {"judges": "judge:rapporteur", "origin_country": "party:referring_state"})
    return {
        "case": case, "opinion": opinions,
        "satellite": satellites.distinct(),
    }


def load_dimension_links(values: DataFrame, key: str, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new dimension rows, distinct links) for (key, scheme, name) rows; names are the identity."""
    distinct = values.select(key, "scheme", "name").where("name IS NOT NULL AND name <> ''").distinct()
    new = distinct.select("scheme", "name").distinct().join(existing.select("scheme", "name"), ["scheme", "name"], "left_anti")
    return new, distinct


def load_domains(satellites: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = satellites.where("kind LIKE 'domain:%'").select("ecli", F.substring("kind", 8, 100).alias("scheme"), F.col("value").alias("name"))
    return load_dimension_links(rows, "ecli", existing)


def load_people(satellites: DataFrame, existing_judges: DataFrame, existing_parties: DataFrame) -> dict[str, DataFrame]:
    """New judges and parties, and links with their roles."""
    # four tables come of these rows, so the cells are read, and repeats dropped, once
    satellites = cut(satellites.where("kind LIKE 'judge:%' OR kind LIKE 'party:%'").select("ecli", "kind", "value").distinct())
    judges = satellites.where("kind LIKE 'judge:%'").select("ecli", F.substring("kind", 7, 100).alias("role"), F.col("value").alias("name"))
    parties = satellites.where("kind LIKE 'party:%'").select(
        "ecli", F.substring("kind", 7, 100).alias("role"), F.col("value").alias("name"),
        F.when(F.col("kind") == "party:referring_state", "state").otherwise("agent").alias("role_class"))
    return {
        "judge": judges.select("name").distinct().join(existing_judges.select("name"), "name", "left_anti"),
        "case_judge": judges,
        "party": parties.select("name", "role_class").distinct().join(existing_parties.select("name", "role_class"), ["name", "role_class"], "left_anti"),
        "case_party": parties,
    }


def load_rs(docs: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """Dutch decisions to case, text and formal-relation rows; a relation target stays only if held."""
    kind = X.first_rule([(F.col("document_type") == "Uitspraak", F.lit("judgment")), (F.col("document_type") == "Conclusie", F.lit("opinion"))], F.lit("other"))
    rows = docs.withColumn("ecli", ids.norm_ecli("ecli_raw"))
    case = rows.groupBy("ecli").agg(F.min(F.struct("doc_id", "date_decision", "instance", kind.alias("doctype"), "zaaknummer")).alias("c")).select(
        "ecli", F.col("c.date_decision").alias("date_decision"), F.concat(F.lit("RS:"), "c.instance").alias("court_code"), "c.doctype", F.col("c.zaaknummer").alias("case_number"))
    text = rows.where("summary IS NOT NULL").select("ecli", F.lit("nl").alias("language"), "summary", F.lit("RECHTSPRAAK").alias("text_source"))
    held = case.select(F.col("ecli").alias("target_ecli"))
    formal = (
        relations.withColumn("source_ecli", ids.norm_ecli("source_ecli")).withColumn("target_ecli", ids.norm_ecli("target_raw"))
        .join(case.select(F.col("ecli").alias("source_ecli")), "source_ecli", "left_semi")
        .join(held.withColumn("__held", F.lit(True)), "target_ecli", "left")
        .select("source_ecli", F.when(F.col("__held"), F.col("target_ecli")).alias("target_ecli"), "target_raw", "relation_type"))
    return {"case": case, "text": text, "relation": formal}


def load_law_refs(refs: DataFrame, cases: DataFrame, acts: DataFrame, provisions: DataFrame) -> DataFrame:
    """References of held cases with the act and the newest provision of their label."""
    from .joins import having, latest_provision

    table = acts.groupBy(F.col("bwb_id").alias("raw_resource")).agg(F.min("element_id").alias("act_id"))
    held = having(refs, cases)
    return latest_provision(held.join(table, "raw_resource", "left"), provisions)


def attach_variants(docs: DataFrame) -> DataFrame:
    """Every language variant with the item id of the canonical variant of its case group."""
    from .dedup import canonical_variant, case_group_key

    canon = canonical_variant(docs).select("case_key", F.col("item_id").alias("case_item_id"))
    usable = docs.where(~F.col("doctype").isin("PR", "CLIN", "CLINF"))
    return usable.withColumn("case_key", case_group_key("ecli", "appno", "reference_date")).join(canon, "case_key")


def load_legislation(elements: DataFrame, refs: DataFrame) -> dict[str, DataFrame]:
    """Acts (latest snapshot), stubs for cited but unknown ids, and provisions of known acts."""
    from .dedup import latest_per_key

    acts = latest_per_key(elements.where("element_type = 'wet'"), ["bwb_id"], "snapshot_date", ["element_id"])
    cited = refs.where("raw_scheme = 'bwb' AND raw_resource IS NOT NULL").select(F.col("raw_resource").alias("bwb_id")).distinct()
    stubs = cited.join(acts.select("bwb_id"), "bwb_id", "left_anti")
    known = acts.select("bwb_id").unionByName(stubs)
    parts = elements.where("element_type <> 'wet'").join(known, "bwb_id", "left_semi")
    with_id = latest_per_key(parts.where("lido_id IS NOT NULL"), ["lido_id"], "snapshot_date", ["element_id"])
    without = latest_per_key(parts.where("lido_id IS NULL"), ["bwb_id", "bwb_label_id", "element_type", "number"], "snapshot_date", ["element_id"])
    return {"act": acts, "stub": stubs, "provision": with_id.unionByName(without)}


def fold_registry(registry: DataFrame, cases: DataFrame, loaded: DataFrame) -> DataFrame:
    """Registry rows of held cases whose pair is not loaded yet; a missing label equals a missing label."""
    from .joins import not_yet_loaded

    held = registry.withColumn("ecli", ids.norm_ecli("ecli")).join(cases.select("ecli", "case_id"), "ecli")
    return not_yet_loaded(held, loaded.where("raw_scheme = 'bwb' AND role = 'cited'"), ["case_id", "raw_resource", "raw_label_id"])


def load_segments(segments: DataFrame, cases: DataFrame) -> DataFrame:
    """Segments with vectors, for held cases only."""
    return segments.join(cases.select("case_id"), "case_id", "left_semi")


def law_reference_view(refs: DataFrame, cases: DataFrame) -> DataFrame:
    """Law references in the older column layout, with deep links."""
    rows = refs.where("raw_scheme = 'bwb'").join(cases.select("case_id", "ecli"), "case_id")
    return rows.select(
        "case_id", "ecli", F.col("raw_resource").alias("bwb_resource"), F.coalesce("raw_subdivision", F.lit("")).alias("article"), "version_date",
        F.col("raw_label_id").alias("bwb_label_id"), F.col("source_dataset").alias("source"), F.col("raw_reference").alias("opschrift"),
        ids.law_url("raw_resource", "version_date").alias("legal_provision_url"),
        ids.law_url("raw_resource", "version_date", "raw_label_id").alias("legal_provision_url_lido"))


def attach_cross_texts(stored: DataFrame, incoming: DataFrame, cases: DataFrame, corpora: tuple[str, str]) -> DataFrame:
    """Texts of cases that belong to both corpora get the other rendition; only empty cells are filled."""
    from .maintenance import fill_empty

    both = cases.where(F.array_contains("sources", corpora[0]) & F.array_contains("sources", corpora[1])).select("case_id")
    keys = ["case_id", "language", "text_source"]
    second = incoming.join(both, "case_id", "left_semi").groupBy(*keys).agg(F.min("text").alias("text"))
    mine = stored.join(both, "case_id", "left_semi").groupBy(*keys).agg(F.min("text").alias("text"))
    return fill_empty(mine, second, keys, ["text"])


def current_summaries(versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current rows that are not rejected, keys that break the one-current rule)."""
    key = ["case_id", "scope", "model"]
    current = versions.where("is_current AND status <> 'rejected'")
    broken = current.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    return current, broken
