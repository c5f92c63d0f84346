"""Set and comparison queries."""

from pyspark.sql import functions as F

from ..functions import citations as C
from ..functions import ids
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import dedup
from ..operators import sets as U
from .registry import query

_ACTS = "acts AS (SELECT bwb_id, title FROM (SELECT *, row_number() OVER (PARTITION BY bwb_id ORDER BY snapshot_date DESC NULLS LAST, element_id) rn FROM fx_law_elements WHERE element_type = 'wet') a WHERE rn = 1)"


def acts(t):
    return dedup.latest_per_key(t.law_elements.where("element_type = 'wet'"), ["bwb_id"], "snapshot_date", ["element_id"])


@query("provision_labels", "U01", f"""
WITH {_ACTS}, r AS (SELECT l.*, ecli FROM fx_law_refs l JOIN fx_cases USING (case_id) WHERE raw_scheme = 'bwb')
SELECT ecli, raw_reference AS label FROM r WHERE raw_reference <> '' UNION SELECT ecli, e.title FROM r JOIN fx_law_elements e ON e.bwb_label_id = raw_label_id WHERE e.title <> ''
UNION SELECT ecli, e.title FROM r JOIN fx_law_elements e ON e.bwb_id = raw_resource AND e.element_type = 'artikel' AND lower(e.number) = lower(raw_subdivision) WHERE e.title <> ''
UNION SELECT ecli, a.title FROM r JOIN acts a ON a.bwb_id = raw_resource WHERE a.title <> ''
UNION SELECT ecli, concat(a.title, ', Artikel ', raw_subdivision) FROM r JOIN acts a ON a.bwb_id = raw_resource WHERE a.title <> '' AND raw_subdivision <> ''
UNION SELECT ecli, concat(a.title, ', Bijlage ', raw_subdivision) FROM r JOIN acts a ON a.bwb_id = raw_resource WHERE a.title <> '' AND raw_subdivision <> ''""")
def _(t):
    return U.provision_labels(t.law_refs, t.cases, acts(t), t.law_elements)


@query("baseline_diff", "U02", """
WITH nc AS (SELECT DISTINCT ecli FROM fx_cases WHERE sector <> '8'), oc AS (SELECT DISTINCT ecli FROM fx_cases WHERE sector <> '6'),
 nt AS (SELECT * FROM fx_texts WHERE trim(text) <> '' AND text_source <> 'INFOCURIA_BLOB_HTML'), ot AS (SELECT * FROM fx_stored_texts WHERE trim(text) <> ''),
 lp AS (SELECT DISTINCT ecli, lower(language) AS l FROM ot WHERE (ecli, lower(language)) NOT IN (SELECT ecli, lower(language) FROM nt))
SELECT 'new_eclis' AS metric, count(*) AS value FROM nc WHERE ecli NOT IN (SELECT ecli FROM oc) UNION ALL SELECT 'lost_eclis', count(*) FROM oc WHERE ecli NOT IN (SELECT ecli FROM nc)
UNION ALL SELECT 'lost_cellar_eclis', count(DISTINCT ecli) FROM ot WHERE text_source = 'CELLAR_ITEM' AND ecli NOT IN (SELECT ecli FROM nt WHERE text_source = 'CELLAR_ITEM')
UNION ALL SELECT 'lost_nonempty_language_pairs', count(*) FROM lp UNION ALL SELECT concat('lost_pairs:', l), count(*) FROM lp GROUP BY l""")
def _(t):
    return U.baseline_diff(t.cases.where("sector <> '8'"), t.texts.where("text_source <> 'INFOCURIA_BLOB_HTML'"),
                           t.cases.where("sector <> '6'"), t.stored_texts)


@query("compare_edge_builds", "U03", """
WITH o AS (SELECT DISTINCT source_case_id, target_case_id FROM fx_edges WHERE target_case_id IS NOT NULL AND relation_type <> 'joins'),
 n AS (SELECT DISTINCT source_case_id, target_case_id FROM fx_edges WHERE target_case_id IS NOT NULL AND source_dataset = 'ds_O')
SELECT source_case_id, target_case_id, CASE WHEN n.k IS NULL THEN 'dropped' WHEN o.k IS NULL THEN 'added' ELSE 'kept' END AS status
FROM (SELECT *, 1 AS k FROM o) o FULL JOIN (SELECT *, 1 AS k FROM n) n USING (source_case_id, target_case_id)""")
def _(t):
    resolved = t.edges.where("target_case_id IS NOT NULL")
    return U.compare_edges(resolved.where("relation_type <> 'joins'"), resolved.where("source_dataset = 'ds_O'"))


def _catalog(t):
    return A.target_catalog(t.echr_docs.withColumnRenamed("g", "case_id"))


def _scl_entries(t):
    entry = t.scl.select("source_case_id", F.explode(C.split_citations("scl")).alias("entry"))
    return entry.select("source_case_id", "entry", ids.all_appnos("entry").alias("appnos"), C.cue_flags("entry")["decision_cue"].alias("decision_cue"))


@query("classify_dropped_edges", "U04", r"""
WITH cat AS MATERIALIZED (SELECT g AS t, CASE WHEN bool_or(doctype LIKE '%JUD%') THEN 'judgment' WHEN bool_or(doctype LIKE '%DEC%') THEN 'decision' ELSE 'communicated' END AS kind, min(decided) AS d, min(appno) AS appno, bool_or(doctype_branch = 'GRANDCHAMBER') AS gc FROM fx_echr_docs GROUP BY 1),
 src AS MATERIALIZED (SELECT source_case_id AS s, min(source_date) AS d FROM fx_scl WHERE line_no <> 7 GROUP BY 1),
 ent AS (SELECT source_case_id AS s, trim(unnest(string_split(scl, ';'))) AS e FROM fx_scl),
 num AS (SELECT s, ltrim(regexp_extract(e, '(\d+/\d\d)', 1), '0') AS appno, contains(e, '(dec.)') AS cue FROM ent),
 cited AS MATERIALIZED (SELECT s, appno, bool_or(cue) AS any_cue, bool_and(cue) AS all_cue FROM num GROUP BY 1, 2),
 cand AS MATERIALIZED (SELECT DISTINCT s, t, c.appno, gc FROM cited c JOIN cat ON cat.appno = c.appno),
 new AS MATERIALIZED (SELECT DISTINCT s, appno FROM cand WHERE NOT gc),
 dropped AS MATERIALIZED (SELECT s, t FROM cand WHERE gc UNION SELECT source_case_id, target_case_id FROM fx_edges WHERE target_case_id IS NOT NULL AND relation_type <> 'joins')
SELECT p.s AS source_case_id, p.t AS target_case_id, CASE WHEN p.s = p.t THEN 'self_loop' WHEN cat.t IS NULL THEN 'missing_target_metadata' WHEN kind = 'communicated' THEN 'communicated_target' WHEN src.s IS NULL THEN 'source_no_scl'
  WHEN cat.d > src.d THEN 'future_target_date' WHEN cited.s IS NULL THEN 'non_owner_appno_fanout'
  WHEN new.s IS NULL THEN 'unmatched_with_owner_appno_in_scl'
  WHEN kind = 'decision' AND NOT any_cue THEN 'wrong_doctype_decision_without_dec_cue' WHEN kind = 'judgment' AND all_cue THEN 'wrong_doctype_judgment_for_dec_cue'
  WHEN kind = 'judgment' THEN 'extra_judgment_for_same_appno' ELSE 'extra_decision_for_same_appno' END AS reason
FROM dropped p LEFT JOIN cat ON cat.t = p.t LEFT JOIN src ON src.s = p.s LEFT JOIN cited ON cited.s = p.s AND cited.appno = cat.appno LEFT JOIN new ON new.s = p.s AND new.appno = cat.appno""")
def _(t):
    catalog, entries = _catalog(t), _scl_entries(t)
    sources = t.scl.where("line_no <> 7").groupBy(F.col("source_case_id").alias("case_id")).agg(F.min("source_date").alias("date_decision"))
    owned = catalog.select(F.col("case_id").alias("target_case_id"), "is_gc", F.explode("appnos").alias("appno"))
    cand = entries.select("source_case_id", F.explode("appnos").alias("appno")).distinct().join(owned, "appno")
    new = cand.where("NOT is_gc")
    legacy = t.edges.where("target_case_id IS NOT NULL AND relation_type <> 'joins'").select("source_case_id", "target_case_id")
    dropped = cand.where("is_gc").select("source_case_id", "target_case_id").unionByName(legacy)
    return U.classify_drops(dropped, sources, catalog, entries, new)


@query("parity_check", "U05", """
WITH e AS (SELECT ecli, language, md5(text) AS text FROM fx_texts), a AS (SELECT ecli, language, md5(text) AS text FROM fx_stored_texts),
 c AS (SELECT ecli, language, text, sum(d) AS d FROM (SELECT *, 1 AS d FROM e UNION ALL SELECT *, -1 FROM a) u GROUP BY 1, 2, 3)
SELECT 'case_text' AS table_name, ecli, language, text, CASE WHEN d > 0 THEN 'missing' ELSE 'extra' END AS status, CAST(abs(d) AS BIGINT) AS n FROM c WHERE d <> 0""")
def _(t):
    cols = ["ecli", "language", "text"]
    return U.parity(t.texts.select(*cols), t.stored_texts.select(*cols), cols, "case_text", long_text=["text"])


@query("column_coverage", "U06", """
SELECT table_name, column_name, CASE WHEN n > 0 THEN concat('mapped to ', kind) ELSE 'MISSING' END AS disposition FROM (
 SELECT 'orders' AS table_name, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS column_name) c
LEFT JOIN (SELECT 'o_orderkey' AS m, 'key' AS kind, count(*) AS n FROM orders UNION ALL SELECT 'o_orderdate', 'date', count(*) FROM orders UNION ALL SELECT 'o_custkey', 'key', count(*) FROM orders) m ON m.m = column_name""")
def _(t):
    columns = U.column_rows(t.spark, {"orders": t.orders})
    used = A.metrics(t.orders, {c: F.count(c) for c in ("o_orderkey", "o_orderdate", "o_custkey")}).where("value > 0")
    kind = F.when(F.col("metric") == "o_orderdate", "date").otherwise("key")
    mapping = used.select(F.lit("orders").alias("table_name"), F.col("metric").alias("column_name"),
                          F.concat(F.lit("mapped to "), kind).alias("disposition"))
    return U.column_coverage(columns, mapping)


@query("schema_union", "U07", """
SELECT case_id, ecli, celex, CAST(NULL AS VARCHAR) AS note FROM fx_cases UNION ALL SELECT CAST(g AS BIGINT), ecli, NULL, docname FROM fx_echr_docs""")
def _(t):
    extra = t.echr_docs.select(F.col("g").cast("string").alias("case_id"), "ecli", F.col("docname").alias("note"))
    return U.conform(t.cases.select("case_id", "ecli", "celex"), extra)
