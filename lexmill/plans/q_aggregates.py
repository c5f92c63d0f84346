"""Coverage, counting and report queries."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import dedup
from .q_columns import toks_sql
from .registry import query

_YEAR = f"year(TRY_CAST(list_min({toks_sql('date_publication')}) AS DATE))"


def relation_types(t):
    return t.edges.select("relation_type").distinct().withColumn("counted", F.col("relation_type") != "joins")


def datasets(t):
    return t.edges.select("source_dataset").distinct().withColumn("counted", F.lit(True))


@query("coverage_by_decade", "A01", f"""
WITH x AS (SELECT DISTINCT ecli FROM fx_texts WHERE length(text) >= 200), c AS (SELECT ecli, CAST(floor({_YEAR} / 10) * 10 AS BIGINT) AS decade FROM fx_cases)
SELECT decade, count(*) AS cases, count(x.ecli) AS with_text, round(100.0 * count(x.ecli) / count(*), 1) AS percent FROM c LEFT JOIN x USING (ecli) WHERE decade IS NOT NULL GROUP BY 1""")
def _(t):
    return A.coverage_by_decade(t.cases, t.texts)


@query("sector_share", "A02", f"""
WITH a AS (SELECT unnest({toks_sql('sector')}) AS atom FROM fx_cases) SELECT atom, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM a), 1) AS percent FROM a GROUP BY 1""")
def _(t):
    return A.atom_share(t.cases, "sector")


@query("top_subjects_and_reasons", "A03", f"""
SELECT * FROM (SELECT 'subject' AS kind, atom, count(*) AS n FROM (SELECT unnest({toks_sql('subject_matter')}) AS atom FROM fx_cases) x GROUP BY 2 ORDER BY n DESC, atom LIMIT 15) a
UNION ALL SELECT * FROM (SELECT 'procedure', atom, count(*) AS n FROM (SELECT unnest({toks_sql('type_procedure')}) AS atom FROM fx_cases) x GROUP BY 2 ORDER BY n DESC, atom LIMIT 10) b
UNION ALL SELECT * FROM (SELECT 'country', atom, count(*) AS n FROM (SELECT unnest({toks_sql('origin_country')}) AS atom FROM fx_cases) x GROUP BY 2 ORDER BY n DESC, atom LIMIT 15) c
UNION ALL SELECT * FROM (SELECT 'language', atom, count(*) AS n FROM (SELECT unnest({toks_sql('language')}) AS atom FROM fx_texts) x GROUP BY 2 ORDER BY n DESC, atom LIMIT 10) d
UNION ALL SELECT * FROM (SELECT 'reason', atom, count(*) AS n FROM (SELECT unnest({toks_sql('missing_reasons')}) AS atom FROM fx_texts) x GROUP BY 2 ORDER BY n DESC, atom LIMIT 5) e""")
def _(t):
    parts = (("subject", t.cases, "subject_matter", 15), ("procedure", t.cases, "type_procedure", 10),
             ("country", t.cases, "origin_country", 15), ("language", t.texts, "language", 10),
             ("reason", t.texts, "missing_reasons", 5))
    return A.union_all(A.top_atoms(df, c, n).select(F.lit(k).alias("kind"), "atom", "n") for k, df, c, n in parts)


@query("duplicate_ecli_count", "A04", "SELECT count(ecli) - count(DISTINCT ecli) AS duplicates FROM fx_case_rows")
def _(t):
    return A.dup_count(t.case_rows, "ecli")


@query("citation_topology", "A05", f"""
WITH e AS (SELECT unnest({toks_sql('cites')}) AS a FROM fx_cases), h AS (SELECT DISTINCT unnest({toks_sql('celex')}) AS a FROM fx_cases)
SELECT count(*) AS total, count(h.a) AS internal, count(*) - count(h.a) AS external FROM e LEFT JOIN h ON h.a = e.a""")
def _(t):
    return A.citation_topology(t.cases)


@query("flag_stubs", "A06", """
WITH m AS (SELECT case_id, quantile_cont(length(text), 0.5) AS median FROM fx_stored_texts WHERE text_source <> 'RECHTSPRAAK' GROUP BY 1)
SELECT text_id, length(text) AS length, round(median, 3) AS median, length(text) < 0.40 * median AND median > 10000 AS is_stub FROM fx_stored_texts JOIN m USING (case_id) WHERE text_source <> 'RECHTSPRAAK'""")
def _(t):
    return A.flag_stubs(t.stored_texts).select("text_id", F.col("length").cast("long").alias("length"), F.round("median", 3).alias("median"), "is_stub")


@query("stub_index", "A07", """
WITH r AS (SELECT text_id, ecli, upper(language) AS language, length(text) AS length FROM fx_texts WHERE length(text) > 0), m AS (SELECT ecli, quantile_cont(length, 0.5) AS med FROM r GROUP BY 1)
SELECT text_id, ecli, language, length FROM r JOIN m USING (ecli) WHERE med >= 900 AND length < 0.25 * med""")
def _(t):
    return A.stub_index(t.texts, min_median=900).withColumn("length", F.col("length").cast("long"))


@query("pivot_national", "A08", """
SELECT case_id, max(CASE WHEN relation_type = 'cites' THEN source_dataset END) AS cites, max(CASE WHEN relation_type = 'appeal_of' THEN source_dataset END) AS appeal_of,
  max(CASE WHEN relation_type = 'joins' THEN source_dataset END) AS joins FROM (SELECT source_case_id AS case_id, relation_type, concat(source_dataset, '/', edge_id) AS source_dataset FROM fx_edges) x GROUP BY 1""")
def _(t):
    kv = t.edges.select(F.col("source_case_id").alias("case_id"), F.col("relation_type").alias("col"),
                        F.concat_ws("/", "source_dataset", "edge_id").alias("val"))
    return A.pivot_national(kv, "case_id", ["cites", "appeal_of", "joins"])


@query("citation_counts", "A09", """
SELECT case_id, CAST(sum(o) AS BIGINT) AS cites_count, CAST(sum(i) AS BIGINT) AS cited_by_count FROM (
 SELECT source_case_id AS case_id, count(*) AS o, 0 AS i FROM fx_edges GROUP BY 1 UNION ALL SELECT target_case_id, 0, count(*) FROM fx_edges WHERE target_case_id IS NOT NULL GROUP BY 1) u GROUP BY 1""")
def _(t):
    return A.citation_counts(t.edges)


_PAIRS = "p AS (SELECT DISTINCT source_case_id AS s, target_case_id AS t FROM fx_edges WHERE target_case_id IS NOT NULL AND source_case_id <> target_case_id AND relation_type <> 'joins')"


@query("refresh_counts", "A10", f"""
WITH {_PAIRS}, o AS (SELECT s AS case_id, count(*) AS n FROM p GROUP BY 1), i AS (SELECT t AS case_id, count(*) AS n FROM p GROUP BY 1)
SELECT case_id, coalesce(o.n, 0) AS cites_count, coalesce(i.n, 0) AS cited_by_count FROM fx_cases LEFT JOIN o USING (case_id) LEFT JOIN i USING (case_id)""")
def _(t):
    return A.refresh_counts(t.edges, relation_types(t), datasets(t), t.cases)


@query("refresh_counts_subset", "A10", f"""
WITH {_PAIRS}, o AS (SELECT s AS case_id, count(*) AS n FROM p GROUP BY 1), i AS (SELECT t AS case_id, count(*) AS n FROM p GROUP BY 1)
SELECT case_id, coalesce(o.n, 0) AS cites_count, coalesce(i.n, 0) AS cited_by_count FROM (SELECT case_id FROM fx_cases WHERE case_id IN (SELECT case_id FROM fx_texts)) c LEFT JOIN o USING (case_id) LEFT JOIN i USING (case_id)""")
def _(t):
    return A.refresh_counts(t.edges, relation_types(t), datasets(t), t.cases, subset=t.texts.select("case_id"))


@query("cited_by_units", "A11", """
WITH heavy AS (SELECT source_case_id FROM fx_edges GROUP BY 1 HAVING count(*) > 8),
 u AS (SELECT o_orderkey AS source_case_id, CASE WHEN o_orderpriority <> '5-LOW' THEN concat('app:', CAST(o_custkey AS VARCHAR)) END AS unit FROM orders)
SELECT target_case_id, count(DISTINCT coalesce(unit, concat('case:', CAST(e.source_case_id AS VARCHAR)))) AS cited_by FROM fx_edges e LEFT JOIN u USING (source_case_id)
WHERE target_case_id IS NOT NULL AND e.source_case_id NOT IN (SELECT source_case_id FROM heavy) GROUP BY 1""")
def _(t):
    unit = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("app:"), F.col("o_custkey").cast("string")))
    units = t.orders.select(F.col("o_orderkey").alias("source_case_id"), unit.alias("unit"))
    return A.cited_by(t.edges, units, cap=8)


@query("target_catalog", "A12", """
SELECT g AS case_id, CASE WHEN bool_or(doctype LIKE '%JUD%') THEN 'judgment' WHEN bool_or(doctype LIKE '%DEC%') THEN 'decision' WHEN bool_or(doctype LIKE '%COM%') THEN 'communicated' ELSE 'other' END AS kind,
  bool_or(doctype_branch = 'GRANDCHAMBER') AS is_gc, coalesce(max(CASE WHEN doctype = 'HEJUD' THEN docname END), max(CASE WHEN doctype = 'HFJUD' THEN docname END), max(docname)) AS docname,
  coalesce(max(CASE WHEN doctype = 'HEJUD' THEN conclusion END), max(CASE WHEN doctype = 'HFJUD' THEN conclusion END), max(conclusion)) AS conclusion,
  string_agg(DISTINCT appno, ';' ORDER BY appno) AS appnos FROM fx_echr_docs GROUP BY 1""")
def _(t):
    docs = t.echr_docs.withColumnRenamed("g", "case_id")
    return A.target_catalog(docs).select("case_id", "kind", "is_gc", "docname", "conclusion", F.array_join("appnos", ";").alias("appnos"))


@query("language_buckets", "A13", """
SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 4 THEN '2-4' WHEN n <= 9 THEN '5-9' WHEN n <= 19 THEN '10-19' ELSE '20+' END AS bucket, count(*) AS cases
FROM (SELECT case_id, count(DISTINCT concat(language, '/', source_window)) AS n FROM fx_texts GROUP BY 1) x GROUP BY 1""")
def _(t):
    return A.language_buckets(t.texts.select("case_id", F.concat_ws("/", "language", "source_window").alias("language")))


_SNAP = """SELECT 'cases' AS metric, 'control' AS kind, count(*) AS value FROM fx_cases UNION ALL SELECT 'distinct_eclis', 'control', count(DISTINCT ecli) FROM fx_cases
UNION ALL SELECT 'texts', 'moving', count(*) FROM {x} UNION ALL SELECT 'text_chars', 'moving', CAST(sum(length(text)) AS BIGINT) FROM {x}
UNION ALL SELECT 'cellar_texts', 'moving', count(*) FROM {x} WHERE text_source = 'CELLAR_ITEM' UNION ALL SELECT 'edges', 'control', count(*) FROM {e}
UNION ALL SELECT 'resolved_edges', 'control', count(target_case_id) FROM {e} UNION ALL SELECT 'citing_cases', 'control', count(DISTINCT source_case_id) FROM {e}"""


@query("corpus_snapshot", "A14", _SNAP.format(x="fx_texts", e="fx_edges"))
def _(t):
    return A.snapshot(t.cases, t.texts, t.edges)


@query("snapshot_diff", "A14", f"""
WITH a AS ({_SNAP.format(x='fx_texts', e='fx_edges')}), b AS ({_SNAP.format(x='fx_stored_texts', e="(SELECT * FROM fx_edges WHERE relation_type <> 'joins')")})
SELECT metric, kind, a.value AS before, b.value AS after, CASE WHEN a.value = b.value THEN 'same' WHEN kind = 'control' THEN 'violation' ELSE 'changed' END AS verdict FROM a JOIN b USING (metric, kind)""")
def _(t):
    return A.diff_snapshots(A.snapshot(t.cases, t.texts, t.edges),
                            A.snapshot(t.cases, t.stored_texts, t.edges.where("relation_type <> 'joins'")))


@query("dataset_breakdown", "A15", """
SELECT source_dataset, count(*) AS refs, count(legislation_id) AS with_act, count(provision_id) AS with_provision,
 count(CASE WHEN legislation_id IS NOT NULL OR provision_id IS NOT NULL THEN 1 END) AS resolved, count(DISTINCT case_id) AS cases FROM fx_law_refs GROUP BY 1""")
def _(t):
    return A.dataset_breakdown(t.law_refs)


@query("degree_summary", "A16", """
WITH p AS (SELECT DISTINCT source_case_id AS s, target_case_id AS t FROM fx_edges WHERE target_case_id IS NOT NULL), d AS (SELECT s, count(*) AS degree FROM p GROUP BY 1), l AS (SELECT list(degree ORDER BY degree) AS v, count(*) AS n FROM d)
SELECT n AS sources, (SELECT count(*) FROM p) AS edges, (SELECT count(DISTINCT t) FROM p) AS targets, round((SELECT count(*) FROM p) / n, 2) AS mean_degree,
 v[CAST(round_even(0.5 * (n - 1), 0) AS BIGINT) + 1] AS p50, v[CAST(round_even(0.9 * (n - 1), 0) AS BIGINT) + 1] AS p90, v[CAST(round_even(0.99 * (n - 1), 0) AS BIGINT) + 1] AS p99,
 list_max(v) AS max_degree, len(list_filter(v, lambda x: x > 100)) AS over_100, len(list_filter(v, lambda x: x > 300)) AS over_300, coalesce(CAST(list_sum(list_filter(v, lambda x: x > 300)) AS BIGINT), 0) AS over_300_edges FROM l""")
def _(t):
    return A.degree_summary(t.edges.where("target_case_id IS NOT NULL"))


@query("shared_bodies", "A17", r"""
WITH r AS (SELECT DISTINCT ecli, lower(language) AS language, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest, text_source FROM fx_texts WHERE length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 500)
SELECT language, digest, count(DISTINCT ecli) AS eclis, bool_or(text_source <> 'CELLAR_ITEM') AS gated FROM r GROUP BY 1, 2 HAVING count(DISTINCT ecli) > 1""")
def _(t):
    return A.shared_body_groups(A.body_rows(t.texts))


@query("integrity_report", "A18", r"""
WITH c AS (SELECT ecli, trim(split_part(split_part(celex, ';', 1), '_', 1)) AS celex FROM (SELECT coalesce(ecli, '') AS ecli, celex FROM fx_case_rows) q),
 x AS (SELECT ecli, language, text_source, regexp_matches(celex, '_(SUM|RES|INF)\b') AS derived, trim(text) = '' AS blank, text FROM fx_texts),
 s AS (SELECT lower(language) AS language, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest, count(DISTINCT ecli) AS n, bool_or(text_source <> 'CELLAR_ITEM') AS gated FROM x WHERE length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 500 GROUP BY 1, 2 HAVING count(DISTINCT ecli) > 1)
SELECT 'cases_rows' AS metric, count(*) AS value FROM c UNION ALL SELECT 'unique_case_eclis', count(DISTINCT ecli) FROM c WHERE ecli <> '' UNION ALL SELECT 'blank_case_eclis', count(*) FROM c WHERE ecli = ''
UNION ALL SELECT 'duplicate_case_eclis', count(*) FROM (SELECT ecli FROM c WHERE ecli <> '' GROUP BY 1 HAVING count(*) > 1) d
UNION ALL SELECT 'duplicate_celex_groups', count(*) FROM (SELECT celex FROM c WHERE ecli <> '' AND celex <> '' GROUP BY 1 HAVING count(DISTINCT ecli) > 1) d
UNION ALL SELECT 'malformed_celex', count(*) FROM c WHERE ecli <> '' AND celex LIKE '6%' AND NOT regexp_matches(celex, '^6\d{4}[A-Z]{1,2}\d{4}(\(\d{2}\))?$')
UNION ALL SELECT 'fulltexts_rows', count(*) FROM x UNION ALL SELECT 'duplicate_ecli_language_pairs', count(*) FROM (SELECT 1 FROM x GROUP BY ecli, language HAVING count(*) > 1) d
UNION ALL SELECT 'empty_language_placeholders', count(*) FROM x WHERE blank UNION ALL SELECT 'derived_empty_placeholders', count(*) FROM x WHERE blank AND derived UNION ALL SELECT 'derived_fulltext_bodies', count(*) FROM x WHERE NOT blank AND derived
UNION ALL SELECT 'fulltext_eclis_not_in_cases', count(DISTINCT ecli) FROM x WHERE ecli NOT IN (SELECT ecli FROM c) UNION ALL SELECT 'cases_without_any_fulltext', count(DISTINCT ecli) FROM c WHERE ecli <> '' AND ecli NOT IN (SELECT ecli FROM x WHERE NOT blank)
UNION ALL SELECT 'shared_text_bodies', count(*) FROM s WHERE gated UNION ALL SELECT 'shared_cellar_only_bodies', count(*) FROM s WHERE NOT gated
UNION ALL SELECT concat('source:', text_source), count(*) FROM x WHERE NOT blank GROUP BY text_source""")
def _(t):
    return A.integrity_report(t.case_rows, t.texts)


@query("counts_checksum", "A19", """
WITH n AS (SELECT source_case_id AS c FROM fx_edges UNION SELECT target_case_id FROM fx_edges WHERE target_case_id IS NOT NULL)
SELECT (SELECT count(*) FROM n) AS rows, count(source_case_id) AS sum_cites, count(target_case_id) AS sum_cited_by FROM fx_edges""")
def _(t):
    return A.checksum(A.citation_counts(t.edges))


@query("reconcile", "A20", """
SELECT *, CASE WHEN "check" = 'orphan' AND value > 0 THEN 'fail' ELSE 'ok' END AS status FROM (
SELECT 'cases' AS metric, count(*) AS value, 'count' AS "check" FROM fx_cases UNION ALL SELECT 'edges', count(*), 'count' FROM fx_edges UNION ALL SELECT 'texts', count(*), 'count' FROM fx_texts
UNION ALL SELECT 'edge_target_orphans', count(*), 'orphan' FROM fx_edges WHERE target_case_id IS NOT NULL AND target_case_id NOT IN (SELECT case_id FROM fx_cases)
UNION ALL SELECT 'edge_source_orphans', count(*), 'orphan' FROM fx_edges WHERE source_case_id NOT IN (SELECT case_id FROM fx_cases)
UNION ALL SELECT 'text_orphans', count(*), 'orphan' FROM fx_texts WHERE case_id NOT IN (SELECT case_id FROM fx_cases)) u""")
def _(t):
    cases = t.cases.select(F.col("case_id").alias("parent_id"))
    return A.reconcile({"cases": t.cases, "edges": t.edges, "texts": t.texts}, [
        A.orphans(t.edges, "target_case_id", cases, "parent_id", "edge_target_orphans"),
        A.orphans(t.edges, "source_case_id", cases, "parent_id", "edge_source_orphans"),
        A.orphans(t.texts, "case_id", cases, "parent_id", "text_orphans")])


@query("reconcile_source_and_target", "A21", """
WITH s AS (SELECT relation_type AS name, count(*) AS n FROM fx_raw_edges GROUP BY 1), d AS (SELECT relation_type AS name, count(*) AS n FROM fx_edges GROUP BY 1)
SELECT name, coalesce(s.n, 0) AS source_n, coalesce(d.n, 0) AS target_n, coalesce(d.n, 0) - coalesce(s.n, 0) AS diff, coalesce(d.n, 0) = coalesce(s.n, 0) AS equal FROM s FULL JOIN d USING (name)""")
def _(t):
    side = lambda df: df.groupBy(F.col("relation_type").alias("name")).agg(F.count("*").alias("n"))
    return A.reconcile_pairs(side(t.raw_edges), side(t.edges))


@query("date_window", "A22", f"""
SELECT CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day FROM (SELECT TRY_CAST(list_min({toks_sql('date_publication')}) AS DATE) AS d FROM fx_cases) x""")
def _(t):
    return A.date_window(t.cases)


@query("reference_counts", "A23", """
SELECT raw_resource, raw_label_id, count(*) AS refs, string_agg(DISTINCT source_dataset, ';' ORDER BY source_dataset) AS sources, count(DISTINCT case_id) AS cases FROM fx_law_refs GROUP BY 1, 2""")
def _(t):
    return A.reference_counts(t.law_refs)


@query("link_outcomes", "A24", """
SELECT source_dataset, CASE WHEN target_case_id = source_case_id THEN 'self_skipped' WHEN target_case_id IS NOT NULL THEN 'resolved' WHEN target_ecli_raw IS NOT NULL THEN 'unresolved_ecli' ELSE 'unresolved_ref' END AS status, count(*) AS n FROM fx_edges GROUP BY 1, 2""")
def _(t):
    status = X.first_rule([
        (F.col("target_case_id") == F.col("source_case_id"), F.lit("self_skipped")),
        (F.col("target_case_id").isNotNull(), F.lit("resolved")),
        (F.col("target_ecli_raw").isNotNull(), F.lit("unresolved_ecli"))], F.lit("unresolved_ref"))
    return A.link_stats(t.edges.withColumn("status", status))


@query("new_dimension_values", "A25", """
SELECT DISTINCT agents AS name FROM fx_cases WHERE agents NOT IN (SELECT concat('Agent ', CAST(n_nationkey AS VARCHAR)) FROM nation)""")
def _(t):
    existing = t.nation.select(F.concat(F.lit("Agent "), F.col("n_nationkey").cast("string")).alias("name"))
    return A.build_dimension(t.cases, "agents", existing)
