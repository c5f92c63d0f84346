"""Warehouse mapping queries."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import mapping as W
from ..operators.aggregates import union_all
from .q_columns import _FORMATION_CASE, _LANG, toks_sql
from .q_linking import ECHR_BASE
from .registry import query

_SAT = f"""sat AS (SELECT DISTINCT ecli, 'domain:subject' AS kind, unnest({toks_sql('subject_matter')}) AS value FROM fx_cases UNION SELECT ecli, 'domain:procedure', unnest({toks_sql('type_procedure')}) FROM fx_cases UNION SELECT ecli, 'judge:judge', unnest({toks_sql('judges')}) FROM fx_cases
 UNION SELECT ecli, 'party:agent', unnest({toks_sql('agents')}) FROM fx_cases UNION SELECT ecli, 'cite:cites', unnest({toks_sql('cites')}) FROM fx_cases UNION SELECT ecli, 'judge:rapporteur', trim(split_part(judges, ';', 1)) FROM fx_cases UNION SELECT ecli, 'party:referring_state', origin_country FROM fx_cases)"""


@query("map_case_rows", "W01", f"""
WITH x AS (SELECT ecli, {toks_sql('celex')}[1] AS celex, list_min({toks_sql('date_publication')}) AS day, lower(coalesce({toks_sql('language_procedure')}[1], '')) AS word, lower(coalesce({toks_sql('formation')}[1], '')) AS f, {toks_sql('sector')}[1] AS sector, {toks_sql('type_procedure')}[1] AS proc_type FROM fx_cases),
 y AS (SELECT *, {_FORMATION_CASE} AS formation_code, concat(substring(celex, 6, 1), '-', CAST(CAST(substring(celex, 8, 4) AS INT) AS VARCHAR), '/', substring(celex, 4, 2)) AS case_number FROM x)
SELECT ecli, celex, concat('Case ', case_number) AS title, CAST(TRY_CAST(day AS DATE) AS VARCHAR) AS date_decision, CASE substring(celex, 6, 1) WHEN 'C' THEN 'CJEU' WHEN 'T' THEN 'EGC' ELSE 'CST' END AS court_code, coalesce(m.iso, CASE WHEN length(word) = 2 THEN word END) AS lang,
  CASE substring(celex, 7, 1) WHEN 'J' THEN 'judgment' WHEN 'O' THEN 'order' ELSE 'opinion' END AS doctype, case_number, CAST(CASE WHEN formation_code IN ('GC', 'FC') THEN 1 WHEN formation_code IN ('1C','2C','3C','4C','5C') THEN 2 WHEN formation_code IS NOT NULL THEN 3 WHEN f <> '' THEN 4 END AS BIGINT) AS importance, formation_code, sector, proc_type
FROM y LEFT JOIN (VALUES {_LANG}) m(name, iso) ON m.name = word""")
def _(t):
    return W.map_cases(t.cases)["case"].withColumn("date_decision", F.col("date_decision").cast("string")).withColumn("importance", F.col("importance").cast("long"))


@query("map_satellite_rows", "W01", f"WITH {_SAT} SELECT * FROM sat UNION ALL SELECT ecli, 'opinion', agents FROM fx_cases WHERE substring(celex_id, 7, 1) = 'C'")
def _(t):
    mapped = W.map_cases(t.cases)
    opinions = mapped["opinion"].select("ecli", F.lit("opinion").alias("kind"), F.col("advocate_general").alias("value"))
    return mapped["satellite"].unionByName(opinions)


@query("load_domains", "W02", f"""WITH {_SAT}, v AS (SELECT DISTINCT ecli, substring(kind, 8) AS scheme, value AS name FROM sat WHERE kind LIKE 'domain:%')
SELECT 'link' AS part, * FROM v UNION ALL SELECT DISTINCT 'new', NULL, scheme, name FROM v WHERE name <> 'VAT'""")
def _(t):
    existing = t.cases.select(F.lit("subject").alias("scheme"), F.lit("VAT").alias("name")).distinct()
    new, links = W.load_domains(W.map_cases(t.cases)["satellite"], existing)
    return links.select(F.lit("link").alias("part"), "ecli", "scheme", "name").unionByName(new.select(F.lit("new").alias("part"), F.lit(None).cast("string").alias("ecli"), "scheme", "name"))


@query("load_people", "W03", f"""WITH {_SAT}
SELECT 'case_judge' AS part, ecli, substring(kind, 7) AS role, value AS name FROM sat WHERE kind LIKE 'judge:%' UNION ALL SELECT 'case_party', ecli, substring(kind, 7), value FROM sat WHERE kind LIKE 'party:%'
UNION ALL SELECT DISTINCT 'judge', NULL, NULL, value FROM sat WHERE kind LIKE 'judge:%' AND value NOT IN (SELECT full_name FROM fx_people) UNION ALL SELECT DISTINCT 'party', NULL, CASE kind WHEN 'party:agent' THEN 'agent' ELSE 'state' END, value FROM sat WHERE kind LIKE 'party:%' AND NOT (kind = 'party:agent' AND value IN (SELECT concat('Agent ', CAST(n_nationkey AS VARCHAR)) FROM nation))""")
def _(t):
    parties = t.nation.select(F.concat(F.lit("Agent "), F.col("n_nationkey").cast("string")).alias("name"), F.lit("agent").alias("role_class"))
    r = W.load_people(W.map_cases(t.cases)["satellite"], t.people.select(F.col("full_name").alias("name")), parties)
    none = F.lit(None).cast("string")
    return union_all([
        r["case_judge"].select(F.lit("case_judge").alias("part"), "ecli", "role", "name"), r["case_party"].select(F.lit("case_party").alias("part"), "ecli", "role", "name"),
        r["judge"].select(F.lit("judge").alias("part"), none.alias("ecli"), none.alias("role"), "name"),
        r["party"].select(F.lit("party").alias("part"), none.alias("ecli"), F.col("role_class").alias("role"), "name")])


@query("load_dutch_cases", "W04", """
SELECT 'case' AS part, ecli, CASE document_type WHEN 'Uitspraak' THEN 'judgment' WHEN 'Conclusie' THEN 'opinion' ELSE 'other' END AS a, concat('RS:', instance) AS b FROM fx_rs_docs UNION ALL SELECT 'text', ecli, summary, 'RECHTSPRAAK' FROM fx_rs_docs WHERE summary IS NOT NULL
UNION ALL SELECT 'relation', s.ecli, CASE WHEN d.ecli IS NOT NULL THEN d.ecli END, e.relation_type FROM fx_edges e JOIN fx_rs_docs s ON s.doc_id = e.source_case_id LEFT JOIN fx_rs_docs d ON d.doc_id = e.target_case_id WHERE e.relation_type = 'appeal_of'""")
def _(t):
    name = lambda c: F.concat(F.lit("ecli:nl:hr:"), (F.lit(1995) + F.col(c) % 7).cast("string"), F.lit(":"), F.col(c).cast("string"))
    relations = t.edges.where("relation_type = 'appeal_of'").select(name("source_case_id").alias("source_ecli"), name("target_case_id").alias("target_raw"), "relation_type")
    r = W.load_rs(t.rs_docs, relations)
    row = lambda part, df, a, b, ecli="ecli": df.select(F.lit(part).alias("part"), F.col(ecli).alias("ecli"), F.col(a).alias("a"), F.col(b).alias("b"))
    return union_all([row("case", r["case"], "doctype", "court_code"), row("text", r["text"], "summary", "text_source"), row("relation", r["relation"], "target_ecli", "relation_type", "source_ecli")])


@query("load_law_references", "W05", """
WITH a AS (SELECT bwb_id, min(element_id) AS act_id FROM fx_law_elements WHERE element_type = 'wet' GROUP BY 1), p AS (SELECT bwb_label_id, element_id, row_number() OVER (PARTITION BY bwb_label_id ORDER BY snapshot_date DESC NULLS LAST, element_id) rn FROM fx_law_elements)
SELECT ref_id, act_id, p.element_id AS latest_provision_id FROM fx_law_refs r LEFT JOIN a ON a.bwb_id = raw_resource LEFT JOIN p ON p.bwb_label_id = raw_label_id AND rn = 1 WHERE case_id IN (SELECT case_id FROM fx_cases WHERE sector = '6')""")
def _(t):
    return W.load_law_refs(t.law_refs, t.cases.where("sector = '6'"), t.law_elements.where("element_type = 'wet'"), t.law_elements).select("ref_id", "act_id", "latest_provision_id")


@query("attach_variants", "W06", """
WITH v AS (SELECT *, coalesce(upper(trim(ecli)), concat('APPNO:', md5(concat(coalesce(appno, '?'), ':', coalesce(CAST(reference_date AS VARCHAR), ''))))) AS case_key FROM fx_echr_docs),
 c AS (SELECT case_key, item_id FROM (SELECT *, row_number() OVER (PARTITION BY case_key ORDER BY CASE language_code WHEN 'ENG' THEN 0 WHEN 'FRE' THEN 1 ELSE 2 END, CASE WHEN doctype LIKE '%JUD%' THEN 1 WHEN doctype LIKE '%DEC%' THEN 2 WHEN doctype LIKE '%COM%' THEN 3 ELSE 4 END, item_id) AS rn FROM v) x WHERE rn = 1)
SELECT v.item_id, c.item_id AS case_item_id FROM v JOIN c USING (case_key)""")
def _(t):
    return W.attach_variants(t.echr_docs).select("item_id", "case_item_id")


@query("load_legislation", "W07", """
WITH acts AS (SELECT element_id, bwb_id FROM (SELECT *, row_number() OVER (PARTITION BY bwb_id ORDER BY snapshot_date DESC NULLS LAST, element_id) rn FROM fx_law_elements WHERE element_type = 'wet') a WHERE rn = 1),
 stub AS (SELECT DISTINCT raw_resource AS bwb_id FROM fx_law_refs WHERE raw_resource IS NOT NULL AND raw_resource NOT IN (SELECT bwb_id FROM acts)), k AS (SELECT bwb_id FROM acts UNION SELECT bwb_id FROM stub), e AS (SELECT * FROM fx_law_elements WHERE element_type <> 'wet' AND bwb_id IN (SELECT bwb_id FROM k))
SELECT 'act' AS part, bwb_id, element_id FROM acts UNION ALL SELECT 'stub', bwb_id, NULL FROM stub
UNION ALL SELECT 'provision', bwb_id, element_id FROM (SELECT *, row_number() OVER (PARTITION BY lido_id ORDER BY snapshot_date DESC NULLS LAST, element_id) rn FROM e WHERE lido_id IS NOT NULL) x WHERE rn = 1
UNION ALL SELECT 'provision', bwb_id, element_id FROM (SELECT *, row_number() OVER (PARTITION BY bwb_id, bwb_label_id, element_type, number ORDER BY snapshot_date DESC NULLS LAST, element_id) rn FROM e WHERE lido_id IS NULL) y WHERE rn = 1""")
def _(t):
    r = W.load_legislation(t.law_elements, t.law_refs)
    row = lambda part: r[part].select(F.lit(part).alias("part"), "bwb_id", "element_id" if part != "stub" else F.lit(None).cast("long").alias("element_id"))
    return union_all(row(p) for p in ("act", "stub", "provision"))


@query("fold_registry", "W08", """
WITH g AS (SELECT ' ' || ecli AS ecli, l_partkey AS raw_label_id, concat('BWBR', lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS raw_resource FROM lineitem JOIN fx_cases ON case_id = l_suppkey * 7 + l_linenumber)
SELECT c.case_id, raw_resource, raw_label_id FROM g JOIN fx_cases c ON c.ecli = upper(trim(g.ecli)) WHERE NOT EXISTS (SELECT 1 FROM fx_law_refs o WHERE o.raw_scheme = 'bwb' AND o.case_id = c.case_id AND o.raw_resource = g.raw_resource AND o.raw_label_id IS NOT DISTINCT FROM g.raw_label_id)""")
def _(t):
    key = F.col("l_suppkey") * 7 + F.col("l_linenumber")
    registry = t.lineitem.join(t.cases.select("case_id", "ecli"), F.col("case_id") == key).select(
        F.concat(F.lit(" "), "ecli").alias("ecli"), F.col("l_partkey").alias("raw_label_id"), F.concat(F.lit("BWBR"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("raw_resource"))
    return W.fold_registry(registry, t.cases, t.law_refs).select("case_id", "raw_resource", "raw_label_id")


@query("load_segments", "W09", """
SELECT vec_id AS segment_id, CAST(vec_id AS BIGINT) AS case_id, CAST(len(embedding) AS BIGINT) AS dims, label FROM embeddings WHERE vec_id IN (SELECT case_id FROM fx_cases WHERE sector <> '8')""")
def _(t):
    segments = t.embeddings.select(F.col("vec_id").alias("segment_id"), F.col("vec_id").alias("case_id"), "embedding", "label")
    out = W.load_segments(segments, t.cases.where("sector <> '8'"))
    return out.select("segment_id", "case_id", F.size("embedding").cast("long").alias("dims"), "label")


@query("law_reference_view", "W10", """
SELECT case_id, ecli, raw_resource AS bwb_resource, coalesce(raw_subdivision, '') AS article, CAST(version_date AS VARCHAR) AS version_date, raw_label_id AS bwb_label_id, source_dataset AS source, raw_reference AS opschrift,
 'http://wetten.overheid.nl/id/' || raw_resource || '/' || coalesce(CAST(version_date AS VARCHAR), '1900-01-01') || '/0' AS legal_provision_url,
 'http://linkeddata.overheid.nl/terms/bwb/id/' || raw_resource || '/' || CAST(raw_label_id AS VARCHAR) || '/' || coalesce(CAST(version_date AS VARCHAR), '1900-01-01') || '/' || coalesce(CAST(version_date AS VARCHAR), '1900-01-01') AS legal_provision_url_lido
FROM fx_law_refs JOIN fx_cases USING (case_id) WHERE raw_scheme = 'bwb'""")
def _(t):
    return W.law_reference_view(t.law_refs, t.cases).withColumn("version_date", F.col("version_date").cast("string"))


@query("attach_cross_texts", "W11", """
WITH b AS (SELECT case_id FROM fx_cases WHERE sector = '6;8'), n AS (SELECT case_id, language, text_source, min(text) AS text FROM fx_stored_texts WHERE case_id IN (SELECT case_id FROM b) GROUP BY 1, 2, 3), o AS (SELECT case_id, language, text_source, min(text) AS text FROM fx_texts WHERE case_id IN (SELECT case_id FROM b) GROUP BY 1, 2, 3)
SELECT coalesce(o.case_id, n.case_id) AS case_id, coalesce(o.language, n.language) AS language, coalesce(o.text_source, n.text_source) AS text_source, md5(CASE WHEN trim(coalesce(o.text, '')) = '' THEN coalesce(n.text, o.text) ELSE o.text END) AS body
FROM o FULL JOIN n ON n.case_id = o.case_id AND n.language = o.language AND n.text_source = o.text_source""")
def _(t):
    cases = t.cases.select("case_id", X.toks("sector").alias("sources"))
    out = W.attach_cross_texts(t.texts, t.stored_texts, cases, ("6", "8"))
    return out.select("case_id", "language", "text_source", F.md5(F.col("text").cast("binary")).alias("body"))


@query("case_identifiers", "W12", rf"""
WITH i AS (SELECT case_id, 'ecli' AS scheme, ecli AS v, 'cases.ecli' AS source FROM fx_cases UNION ALL SELECT case_id, 'celex', celex_id, 'cases.celex_id' FROM fx_cases UNION ALL SELECT case_id, 'cjeu_case_number', concat(substring(celex_id, 6, 1), '-', CAST(CAST(substring(celex_id, 8, 4) AS INT) AS VARCHAR), '/', substring(celex_id, 4, 2)), 'cases.case_number' FROM fx_cases
 UNION ALL SELECT DISTINCT {ECHR_BASE} + g, 'ecli', ecli, 'documents.ecli' FROM fx_echr_docs UNION ALL SELECT DISTINCT {ECHR_BASE} + g, 'echr_appno', appno, 'documents.appno' FROM fx_echr_docs
 UNION ALL SELECT 2 * {ECHR_BASE} + doc_id, 'ecli', ecli, 'rs.ecli' FROM fx_rs_docs UNION ALL SELECT 2 * {ECHR_BASE} + doc_id, 'nl_zaaknummer', replace(zaaknummer, ' ', ''), 'rs.zaaknummer' FROM fx_rs_docs
 UNION ALL SELECT 2 * {ECHR_BASE} + doc_id, 'ecli', replaces_identifier, 'rs.replaces' FROM fx_rs_docs WHERE replaces_identifier LIKE 'ECLI%' UNION ALL SELECT 2 * {ECHR_BASE} + doc_id, 'ljn', substring(replaces_identifier, 5), 'rs.replaces' FROM fx_rs_docs WHERE replaces_identifier LIKE 'LJN%')
SELECT case_id, scheme, v AS value_normalized, source, source LIKE 'cases%' OR source = 'rs.ecli' AS is_primary FROM i WHERE v IS NOT NULL""")
def _(t):
    echr = t.echr_docs.withColumn("case_id", F.col("g") + ECHR_BASE)
    rs = t.rs_docs.withColumn("case_id", F.col("doc_id") + 2 * ECHR_BASE)
    return W.case_identifiers(t.cases, echr, rs).select("case_id", "scheme", "value_normalized", "source", "is_primary")


_VERSIONS = """v AS (SELECT conv_id AS case_id, turn AS version, role AS scope, CASE WHEN turn > 2 THEN 'm2' ELSE 'm1' END AS model, length(text) % 2 = 0 AS is_current, CASE WHEN length(text) % 5 = 0 THEN 'rejected' ELSE 'approved' END AS status FROM conversations)"""


@query("current_summaries", "W13", f"""WITH {_VERSIONS}, c AS (SELECT * FROM v WHERE is_current AND status <> 'rejected')
SELECT 'current' AS part, case_id, scope, model, version FROM c UNION ALL SELECT 'broken', case_id, scope, model, count(*) FROM c GROUP BY 2, 3, 4 HAVING count(*) > 1""")
def _(t):
    size = F.length("text")
    versions = t.conversations.select(F.col("conv_id").alias("case_id"), F.col("turn").alias("version"), F.col("role").alias("scope"), F.when(F.col("turn") > 2, "m2").otherwise("m1").alias("model"),
                                      (size % 2 == 0).alias("is_current"), F.when(size % 5 == 0, "rejected").otherwise("approved").alias("status"))
    current, broken = W.current_summaries(versions)
    return current.select(F.lit("current").alias("part"), "case_id", "scope", "model", "version").unionByName(
        broken.select(F.lit("broken").alias("part"), "case_id", "scope", "model", F.col("n").alias("version")))
