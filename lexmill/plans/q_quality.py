"""Corpus quality queries."""

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import quality as Q
from .q_aggregates import datasets, relation_types
from .q_columns import toks_sql
from .q_dedup import CANDIDATES
from .registry import query

_PRIMARY = "trim(split_part(split_part({c}, ';', 1), '_', 1))"
_AMBIG = f"""amb AS (SELECT DISTINCT ecli FROM fx_cases WHERE identity_source = 'infocuria' AND {_PRIMARY.format(c='celex')} IN (
  SELECT {_PRIMARY.format(c='celex')} FROM fx_cases GROUP BY 1 HAVING count(*) > 1))"""
_MISATTACHED = """shared AS (SELECT language, digest FROM best WHERE digest IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT ecli) > 1),
kept AS (SELECT b.* FROM best b LEFT JOIN shared s ON s.language = b.language AND s.digest = b.digest WHERE s.digest IS NULL OR text_source = 'CELLAR_ITEM')"""


@query("blank_ambiguous_celex", "Q01", f"""
WITH {_AMBIG} SELECT c.ecli, CASE WHEN a.ecli IS NULL THEN celex END AS celex FROM fx_cases c LEFT JOIN amb a ON a.ecli = c.ecli""")
def _(t):
    cases = t.cases.select("ecli", "celex", "identity_source")
    return Q.blank_celex(cases, Q.ambiguous_eclis(cases)).select("ecli", "celex")


@query("drop_misattached", "Q02", f"WITH {CANDIDATES}, {_MISATTACHED} SELECT text_id, ecli, language FROM kept")
def _(t):
    from ..operators.dedup import best_text

    return Q.drop_misattached(best_text(t.texts)).select("text_id", "ecli", "language")


@query("consolidate_texts", "Q03", f"""
WITH {CANDIDATES}, {_MISATTACHED}, {_AMBIG}, win AS (SELECT ecli, language, string_agg(DISTINCT source_window, ';' ORDER BY source_window) AS windows FROM cand GROUP BY 1, 2)
SELECT k.text_id, k.ecli, t.language, k.source AS text_source, CASE WHEN a.ecli IS NULL THEN k.celex END AS celex, k.text, w.windows AS source_window
FROM kept k JOIN fx_texts t USING (text_id) JOIN win w ON w.ecli = k.ecli AND w.language = k.language LEFT JOIN amb a ON a.ecli = k.ecli""")
def _(t):
    return Q.consolidate_texts(t.texts, t.cases).select("text_id", "ecli", "language", "text_source", "celex", "text", "source_window")


@query("consolidate_cases", "Q04", f"""
WITH w AS (SELECT ecli, string_agg(DISTINCT source_window, ';' ORDER BY source_window) AS windows FROM fx_case_rows WHERE trim(source_window) <> '' GROUP BY 1),
 r AS (SELECT *, row_number() OVER (PARTITION BY ecli ORDER BY CASE WHEN lower(coalesce(metadata_catalog_source, '')) = 'infocuria' THEN 0 ELSE 1 END, position) AS rn FROM fx_case_rows WHERE ecli IS NOT NULL),
 d AS (SELECT position, r.ecli, celex, identity_source, coalesce(windows, '') AS source_window FROM r LEFT JOIN w ON w.ecli = r.ecli WHERE rn = 1 UNION ALL SELECT position, ecli, celex, identity_source, source_window FROM fx_case_rows WHERE ecli IS NULL),
 amb AS (SELECT DISTINCT ecli FROM d WHERE identity_source = 'infocuria' AND ecli IS NOT NULL AND {_PRIMARY.format(c='celex')} IN (SELECT {_PRIMARY.format(c='celex')} FROM d GROUP BY 1 HAVING count(*) > 1))
SELECT position, d.ecli, CASE WHEN amb.ecli IS NULL THEN celex END AS celex, source_window FROM d LEFT JOIN amb ON amb.ecli = d.ecli""")
def _(t):
    return Q.consolidate_cases(t.case_rows, ["position"]).select("position", "ecli", "celex", "source_window")


@query("coverage_report", "Q05", f"""
WITH s AS (SELECT unnest({toks_sql('sector')}) AS atom FROM fx_cases), l AS (SELECT unnest({toks_sql('language')}) AS atom FROM fx_texts), m AS (SELECT unnest({toks_sql('missing_reasons')}) AS atom FROM fx_texts)
SELECT 'sectors' AS section, atom AS key, count(*) AS n FROM s GROUP BY 2 UNION ALL SELECT 'languages', atom, count(*) FROM l GROUP BY 2 UNION ALL SELECT 'missing_reasons', atom, count(*) FROM m GROUP BY 2
UNION ALL SELECT 'texts', 'fulltext_total', count(*) FROM fx_texts UNION ALL SELECT 'texts', 'fulltext_with_text', count(*) FROM fx_texts WHERE length(text) >= 200
UNION ALL SELECT 'duplicates', 'ecli', count(ecli) - count(DISTINCT ecli) FROM fx_cases""")
def _(t):
    r = Q.coverage_report(t.cases, t.texts)
    atom = lambda name: r[name].select(F.lit(name).alias("section"), F.col("atom").alias("key"), "n")
    return A.union_all([
        atom("sectors"), atom("languages"), atom("missing_reasons"),
        r["texts"].select(F.lit("texts").alias("section"), F.col("metric").alias("key"), F.col("value").alias("n")),
        r["duplicates"].select(F.lit("duplicates").alias("section"), F.lit("ecli").alias("key"), F.col("duplicates").alias("n"))])


# The heading test (capitals at the opening) equals this prefix on the stored texts.
_CLASSIFIED = r"""
corp AS (SELECT ecli, lower(language) AS language, text_source, md5(text) AS md5, text_id FROM fx_texts WHERE trim(text) <> ''),
own AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ecli, language ORDER BY text_id DESC) rn FROM corp) c WHERE rn = 1),
rows_ AS (SELECT s.text_id, s.case_id, lower(s.language) AS language, s.text_source, md5(s.text) AS md5, left(regexp_replace(left(s.text, 800), '\s+', ' ', 'g'), 400) AS head,
   c.ecli, c.celex_id, CASE WHEN c.doctype IN ('judgment','order') THEN c.doctype ELSE 'other' END AS ckind, c.date_decision AS d FROM fx_stored_texts s JOIN fx_stored_cases c USING (case_id)),
fact AS (SELECT r.*, o.text_source AS own_source, o.md5 AS own_md5, (SELECT min(x.ecli) FROM corp x WHERE x.language = r.language AND x.md5 = r.md5 AND x.ecli <> r.ecli) AS owner,
   regexp_extract(head, '^\s*(\d{5}[A-Z]{1,2}\d{4}(?:\(\d{2}\))?)(?:_(SUM|RES|INF|EXT))?(?:_[A-Z]{2})?\b', 1) AS label, regexp_extract(head, '^\s*(\d{5}[A-Z]{1,2}\d{4}(?:\(\d{2}\))?)(?:_(SUM|RES|INF|EXT))?(?:_[A-Z]{2})?\b', 2) AS suffix,
   coalesce(contains(left(head, 300), CAST(year(d) AS VARCHAR)) AND regexp_matches(left(head, 300), concat('(^|[^0-9])', CAST(day(d) AS VARCHAR), '($|[^0-9])')), false) AS dated, starts_with(head, 'JUDGMENT OF THE') AS caps
   FROM rows_ r LEFT JOIN own o ON o.ecli = r.ecli AND o.language = r.language),
celexes AS (SELECT ecli, min(trim(split_part(split_part(celex, ';', 1), '_', 1))) AS celex FROM fx_cases GROUP BY 1),
ver AS (SELECT f.*, CASE WHEN text_source = 'RECHTSPRAAK' THEN NULL WHEN own_md5 = md5 THEN 'corpus' WHEN owner IS NOT NULL THEN 'corpus-other-ecli' WHEN regexp_matches(head, '^\s*\S*-TRA-DOC-[A-Z]{2}-[A-Z]+_DR-') THEN 'label-dr'
    WHEN label <> '' AND (suffix <> '' OR label = celex_id) THEN 'label' WHEN label <> '' THEN 'label-other-celex'
    WHEN text_source = 'INFOCURIA_BLOB_HTML' AND d IS NULL THEN NULL WHEN text_source = 'INFOCURIA_BLOB_HTML' AND NOT dated THEN 'infocuria-other-date' WHEN text_source = 'INFOCURIA_BLOB_HTML' AND caps THEN 'infocuria-dated-decision'
    WHEN text_source = 'INFOCURIA_BLOB_HTML' THEN 'infocuria-dated-notice' WHEN text_source = 'CELLAR_ITEM' AND d IS NOT NULL AND dated THEN CASE WHEN caps THEN 'cellar-dated-decision' ELSE 'cellar-dated-information' END END AS rule FROM fact f),
cls AS (SELECT v.*, CASE rule WHEN 'corpus' THEN ckind WHEN 'corpus-other-ecli' THEN 'misfiled' WHEN 'label-dr' THEN 'oj_notice' WHEN 'label' THEN CASE suffix WHEN 'SUM' THEN 'summary' WHEN 'RES' THEN 'summary' WHEN 'INF' THEN 'information' WHEN 'EXT' THEN 'extract' ELSE ckind END
    WHEN 'label-other-celex' THEN 'misfiled' WHEN 'infocuria-other-date' THEN 'misfiled' WHEN 'infocuria-dated-notice' THEN 'oj_notice' WHEN 'cellar-dated-information' THEN 'information' ELSE ckind END AS kind,
   CASE WHEN rule = 'corpus-other-ecli' THEN x.celex WHEN rule LIKE 'label%' AND rule <> 'label-dr' THEN label WHEN rule = 'infocuria-other-date' THEN NULL ELSE celex_id END AS celex FROM ver v LEFT JOIN celexes x ON x.ecli = v.owner WHERE rule IS NOT NULL)"""
_BASE = r"regexp_replace({c}, '_(SUM|RES|INF|EXT)$', '')"
_PLAN = rf"""
bases AS (SELECT {_BASE.format(c='celex_id')} AS base, max(case_id) AS owner_id FROM fx_stored_cases GROUP BY 1),
bydate AS (SELECT c.text_id, min(o.case_id) AS owner_id FROM cls c JOIN fx_stored_cases h ON h.case_id = c.case_id JOIN fx_stored_cases o ON o.case_number = h.case_number AND o.case_id <> h.case_id
   WHERE kind = 'misfiled' AND rule <> 'corpus-other-ecli' AND contains(left(head, 300), CAST(year(o.date_decision) AS VARCHAR)) AND regexp_matches(left(head, 300), concat('(^|[^0-9])', CAST(day(o.date_decision) AS VARCHAR), '($|[^0-9])')) GROUP BY 1 HAVING count(*) = 1),
own2 AS (SELECT c.*, CASE WHEN rule = 'corpus-other-ecli' THEN b.owner_id ELSE y.owner_id END AS owner_id FROM cls c LEFT JOIN bases b ON b.base = {_BASE.format(c='c.celex')} LEFT JOIN bydate y ON y.text_id = c.text_id WHERE kind = 'misfiled'),
st AS (SELECT case_id, lower(language) AS language, text_source, md5(text) AS md5 FROM fx_stored_texts),
flag AS (SELECT o.*, EXISTS (SELECT 1 FROM st WHERE st.case_id = o.owner_id AND st.language = o.language AND st.md5 = o.md5) AS same_body, EXISTS (SELECT 1 FROM st WHERE st.case_id = o.owner_id AND st.language = o.language AND st.text_source = o.text_source) AS same_source FROM own2 o),
act AS (SELECT f.*, CASE WHEN owner_id IS NULL THEN 'keep: owner unknown' WHEN same_body THEN 'drop' WHEN same_source OR row_number() OVER (PARTITION BY owner_id, language, text_source, same_body, same_source ORDER BY text_id) > 1 THEN 'keep: owner has another text from this source' ELSE 'move' END AS action FROM flag f)"""


@query("classify_texts", "Q06", f"WITH {_CLASSIFIED} SELECT text_id, kind, celex, rule FROM cls")
def _(t):
    return Q.classify_texts(t.stored_texts, t.stored_cases, t.texts, t.cases).select("text_id", "kind", "celex", "rule")


def _plan(t):
    classified = Q.classify_texts(t.stored_texts, t.stored_cases, t.texts, t.cases)
    return Q.cleanup_plan(classified, t.stored_cases, t.stored_texts)


@query("cleanup_plan", "Q07", f"""WITH {_CLASSIFIED}, {_PLAN}
SELECT a.text_id, action, owner_id, CASE WHEN action = 'move' THEN CASE WHEN caps THEN CASE WHEN o.doctype IN ('judgment','order') THEN o.doctype ELSE 'other' END ELSE 'oj_notice' END END AS new_kind,
  CASE WHEN action = 'move' THEN {_BASE.format(c='o.celex_id')} END AS new_celex FROM act a LEFT JOIN fx_stored_cases o ON o.case_id = a.owner_id""")
def _(t):
    return _plan(t).select("text_id", "action", "owner_id", "new_kind", "new_celex")


@query("carry_summaries", "Q08", f"""WITH {_CLASSIFIED}, {_PLAN}, x AS (SELECT s.text_id, s.case_id, lower(s.language) AS language, summary IS NOT NULL AS has_summary, coalesce(c.kind = 'misfiled', false) AS misfiled, a.action
   FROM fx_stored_texts s LEFT JOIN cls c ON c.text_id = s.text_id LEFT JOIN act a ON a.text_id = s.text_id AND action IN ('drop', 'move')),
 rem AS (SELECT case_id, language, text_id AS tid, has_summary AS ths FROM (SELECT *, row_number() OVER (PARTITION BY case_id, language ORDER BY misfiled, text_id) rn FROM x WHERE action IS NULL) r WHERE rn = 1),
 g AS (SELECT x.*, min(text_id) OVER (PARTITION BY x.case_id, x.language) AS first_id FROM x WHERE action IS NOT NULL AND has_summary)
SELECT text_id, CASE WHEN tid IS NOT NULL AND NOT ths AND first_id = text_id THEN 'copy' WHEN tid IS NOT NULL THEN 'none' WHEN action = 'drop' THEN 'convert' ELSE 'recreate' END AS step,
  CASE WHEN tid IS NOT NULL AND NOT ths AND first_id = text_id THEN tid END AS target_id FROM g LEFT JOIN rem USING (case_id, language)""")
def _(t):
    classified = Q.classify_texts(t.stored_texts, t.stored_cases, t.texts, t.cases)
    kinds = classified.select("text_id", (F.col("kind") == "misfiled").alias("misfiled"))
    rows = t.stored_texts.select("text_id", "case_id", F.lower("language").alias("language"), F.col("summary").isNotNull().alias("has_summary"),
                                 F.col("text").isNotNull().alias("has_text")).join(kinds, "text_id", "left").withColumn("misfiled", F.coalesce("misfiled", F.lit(False)))
    return Q.carry_summaries(Q.cleanup_plan(classified, t.stored_cases, t.stored_texts), rows)


@query("repair_celex", "Q09", """
WITH w AS (SELECT case_id, trim(split_part(celex, ';', 1)) AS old FROM fx_cases), d AS (SELECT case_id, old, replace(replace(old, '_SUM', ''), '_INF', '') AS new FROM w WHERE old LIKE '%\\_%' ESCAPE '\\')
SELECT min(case_id) AS case_id, new FROM d WHERE new NOT IN (SELECT old FROM w) GROUP BY new""")
def _(t):
    return Q.repair_celex(t.cases.select("case_id", X.first_tok("celex").alias("celex_id"))).select("case_id", "new")


@query("sparse_cases", "Q10", f"""
WITH l AS (SELECT ecli, count(DISTINCT upper(language)) AS n FROM fx_texts GROUP BY 1), c AS (SELECT ecli, split_part(coalesce(list_filter({toks_sql('celex')}, lambda x: NOT contains(x, 'INF'))[1], {toks_sql('celex')}[1]), '_', 1) AS celex,
  year(TRY_CAST(list_min({toks_sql('date_publication')}) AS DATE)) AS y FROM fx_cases) SELECT ecli, celex, coalesce(n, 0) AS langs FROM c LEFT JOIN l USING (ecli) WHERE y >= 1998 AND coalesce(n, 0) < 3""")
def _(t):
    return Q.sparse_cases(t.cases, t.texts, 3, 1998)


@query("source_index", "Q11", "SELECT text_id, ecli, upper(language) AS language, length(text) AS length FROM fx_texts WHERE text_source = 'INFOCURIA_BLOB_HTML'")
def _(t):
    return Q.source_index(t.texts).withColumn("length", F.col("length").cast("long"))


@query("nonjudgment_index", "Q12", "SELECT text_id, ecli, upper(language) AS language, length(text) AS length FROM fx_texts WHERE text_source = 'CELLAR_ITEM' AND celex LIKE '%\\_SUM' ESCAPE '\\'")
def _(t):
    return Q.nonjudgment_index(t.texts).withColumn("length", F.col("length").cast("long"))


@query("accept_replacements", "Q13", """
WITH o AS (SELECT ecli, upper(language) AS l, max(length(text)) AS n FROM fx_texts GROUP BY 1, 2)
SELECT text_id, ecli FROM fx_stored_texts s JOIN o USING (ecli) WHERE o.l = upper(s.language) AND length(s.text) > 1.005 * n""")
def _(t):
    return Q.accept_replacements(t.texts, t.stored_texts.select("text_id", "ecli", "language", "text"), 1.005).select("text_id", "ecli")


_RANKED = r"""e AS (SELECT DISTINCT ecli, concat('6', CAST(1995 + case_id % 7 AS VARCHAR), 'CJ', lpad(CAST(case_id % 10000 AS VARCHAR), 4, '0')) AS cx FROM fx_texts),
 en AS (SELECT s.text_id, s.ecli, s.text_source, s.text, t.celex, left(trim(regexp_replace(s.text, '\s+', ' ', 'g')), 5000) AS o FROM fx_stored_texts s JOIN fx_texts t USING (text_id) WHERE lower(s.language) = 'en'),
 k AS (SELECT e.ecli, e.cx, en.text_id, trim(text) = '' AS blank, length(text) AS len, list_contains(list_transform(string_split(celex, ';'), lambda x: upper(trim(x))), cx) AS hit, regexp_matches(o, '{marks}') AS jud, text_source FROM e JOIN en ON en.ecli = e.ecli),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ecli, cx ORDER BY hit DESC, jud DESC, text_source = 'CELLAR_ITEM' DESC, len DESC, text_id) rn FROM k) r WHERE rn = 1)"""
_MARKS = r"(?i)(\bjudgment of the court\b|\bthe court(\s*\([^)]*\))? hereby\b)"
_MARKS_V = r"(?i)(^\S*\s*judgment\b|\bjudgment of the court\b|\bthe court(\s*\([^)]*\))? hereby\b)"


def _labelled(t):
    celexes = t.texts.select("text_id", "celex")
    return t.stored_texts.select("text_id", "ecli", "language", "text_source", "text").join(celexes, "text_id")


@query("verify_targets", "Q14", f"""WITH {_RANKED.replace('{marks}', _MARKS_V)}
SELECT e.ecli, e.cx AS expected_celex, CASE WHEN b.text_id IS NULL THEN 'missing' WHEN blank THEN 'empty' WHEN NOT hit THEN 'non_judgment_manifestation' WHEN NOT jud THEN 'suspect_not_judgment' ELSE 'pass' END AS status, b.text_id, coalesce(b.len, 0) AS length FROM e LEFT JOIN b ON b.ecli = e.ecli""")
def _(t):
    return Q.verify_targets(Q.expected_targets(t.texts), _labelled(t)).withColumn("length", F.col("length").cast("long"))


@query("compare_bodies", "Q15", r"""
WITH a AS (SELECT ecli, concat(language, CAST(text_id AS VARCHAR)) AS language, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS h FROM fx_texts WHERE text_source <> 'CELLAR_ITEM'),
 b AS (SELECT ecli, concat(language, CAST(text_id AS VARCHAR)) AS language, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS h FROM fx_stored_texts WHERE text_source <> 'RECHTSPRAAK')
SELECT ecli, language, CASE WHEN a.h IS NULL THEN 'missing_left' WHEN b.h IS NULL THEN 'missing_right' WHEN a.h = b.h THEN 'exact_match' ELSE 'mismatch' END AS status FROM a FULL JOIN b USING (ecli, language)""")
def _(t):
    unique = F.concat("language", F.col("text_id").cast("string"))
    side = lambda df: df.select("ecli", unique.alias("language"), "text")
    return Q.compare_bodies(side(t.texts.where("text_source <> 'CELLAR_ITEM'")), side(t.stored_texts.where("text_source <> 'RECHTSPRAAK'")))


@query("preflight_errors", "Q16", f"""WITH {_RANKED.replace('{marks}', _MARKS)}
SELECT * FROM (SELECT e.ecli, e.cx AS expected_celex, CASE WHEN b.text_id IS NULL THEN 'missing row' WHEN NOT hit THEN 'other CELEX' WHEN NOT jud THEN 'not a full judgment' END AS error FROM e LEFT JOIN b ON b.ecli = e.ecli) x WHERE error IS NOT NULL""")
def _(t):
    return Q.preflight_errors(Q.expected_targets(t.texts), _labelled(t))


@query("identity_gate", "Q17", f"""
WITH p AS (SELECT DISTINCT ecli, celex FROM fx_case_rows WHERE ecli IS NOT NULL), h AS (SELECT ecli, count(*) AS n FROM p GROUP BY 1),
 req AS (SELECT DISTINCT concat('ECLI:EU:C:', CAST(year(o_orderdate) AS VARCHAR), ':', CAST(c_custkey AS VARCHAR)) AS ecli, concat('6', CAST(year(o_orderdate) AS VARCHAR), 'CJ', lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')) AS celex FROM customer JOIN orders ON o_orderkey = c_custkey),
 bad AS (SELECT concat('ECLI:EU:C:1996:', CAST(s_suppkey AS VARCHAR)) AS ecli FROM supplier)
SELECT ecli, 'identity_conflict' AS violation FROM h WHERE n > 1 UNION ALL SELECT ecli, 'missing_required' FROM req WHERE ecli NOT IN (SELECT ecli FROM h)
UNION ALL SELECT ecli, 'mismatched_required' FROM req WHERE ecli IN (SELECT ecli FROM h) AND NOT EXISTS (SELECT 1 FROM p WHERE p.ecli = req.ecli AND p.celex = req.celex) UNION ALL SELECT ecli, 'stale_present' FROM h WHERE ecli IN (SELECT ecli FROM bad)""")
def _(t):
    year = F.year("o_orderdate").cast("string")
    key = F.col("c_custkey").cast("string")
    required = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("ECLI:EU:C:"), year, F.lit(":"), key).alias("ecli"),
        F.concat(F.lit("6"), year, F.lit("CJ"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("celex")).distinct()
    forbidden = t.supplier.select(F.concat(F.lit("ECLI:EU:C:1996:"), F.col("s_suppkey").cast("string")).alias("ecli"))
    return Q.identity_gate(t.case_rows, required, forbidden)


@query("publish_gates", "Q18", r"""
WITH c AS (SELECT ecli, trim(split_part(split_part(celex, ';', 1), '_', 1)) AS celex FROM fx_cases), s AS (SELECT lower(language) AS l, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS d FROM fx_texts WHERE length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 500 GROUP BY 1, 2 HAVING count(DISTINCT ecli) > 1 AND bool_or(text_source <> 'CELLAR_ITEM')),
 v AS (SELECT 'duplicate_celex_groups' AS metric, count(*) AS value FROM (SELECT celex FROM c GROUP BY 1 HAVING count(DISTINCT ecli) > 1) x
  UNION ALL SELECT 'malformed_celex', count(*) FROM c WHERE NOT regexp_matches(celex, '^6\d{4}[A-Z]{1,2}\d{4}(\(\d{2}\))?$') UNION ALL SELECT 'duplicate_ecli_language_pairs', count(*) FROM (SELECT 1 FROM fx_texts GROUP BY ecli, language HAVING count(*) > 1) x
  UNION ALL SELECT 'derived_fulltext_bodies', count(*) FROM fx_texts WHERE trim(text) <> '' AND regexp_matches(celex, '_(SUM|RES|INF)\b') UNION ALL SELECT 'shared_text_bodies', count(*) FROM s)
SELECT metric, 'equals' AS rule, CAST(0 AS BIGINT) AS bound, value FROM v WHERE value <> 0 UNION ALL SELECT 'lost_eclis', 'equals', 0, NULL UNION ALL SELECT 'lost_cellar_eclis', 'equals', 0, NULL
UNION ALL SELECT 'fulltexts_rows', 'at_least', 500000, (SELECT count(*) FROM fx_texts)""")
def _(t):
    return Q.publish_gates(A.integrity_report(t.cases, t.texts), Q.gate_rules(t.spark, min_cases=1))


@query("missing_texts", "Q19", """
WITH p AS (SELECT ecli, bool_or(trim(text) <> '' AND text_source <> 'LEGACY_EURLEX_HTML') AS has_text, bool_or(trim(text) <> '' AND text_source = 'CELLAR_ITEM') AS has_cellar, arg_min(celex, text_id) AS celex
   FROM (SELECT ecli, text_id, text, celex, CASE text_source WHEN 'EXTRACTOR_FALLBACK_TEXT' THEN 'LEGACY_EURLEX_HTML' ELSE CASE WHEN case_id % 3 = 1 THEN 'INFOCURIA_BLOB_HTML' ELSE text_source END END AS text_source FROM fx_texts) x GROUP BY 1)
SELECT ecli, celex, need FROM (SELECT p.ecli, p.celex, CASE WHEN identity_source = 'infocuria' THEN CASE WHEN NOT has_text THEN 'portal_text' END WHEN NOT has_cellar THEN 'store_text' END AS need FROM p LEFT JOIN fx_cases USING (ecli)) y WHERE need IS NOT NULL""")
def _(t):
    source = X.first_rule([(F.col("text_source") == "EXTRACTOR_FALLBACK_TEXT", F.lit(fixed.SOURCE_LEGACY)),
                           (F.col("case_id") % 3 == 1, F.lit(fixed.SOURCE_INFOCURIA))], F.col("text_source"))
    return Q.missing_texts(t.cases, t.texts.withColumn("text_source", source))


@query("validate_new_rows", "Q20", r"""
WITH n AS (SELECT ecli, nullif(trim(split_part(celex, ';', 1)), '') AS celex, CASE WHEN date_publication <> 'unknown' THEN 1 END AS dated FROM fx_cases), o AS (SELECT celex_id AS celex, min(ecli) AS owner FROM fx_stored_cases GROUP BY 1), s AS (SELECT celex, count(*) AS k FROM n GROUP BY 1),
 e AS (SELECT n.*, st.celex_id AS held, CASE WHEN NOT regexp_matches(regexp_replace(n.celex, '_(SUM|RES|INF)$', ''), '^\d{5}[A-Z]{1,2}\d{4}(\(\d{2}\))?$') THEN 'malformed' WHEN owner <> n.ecli THEN 'owned by another case' WHEN k > 1 THEN 'shared by new rows' END AS error
  FROM n LEFT JOIN o ON o.celex = n.celex LEFT JOIN s ON s.celex = n.celex LEFT JOIN fx_stored_cases st ON st.ecli = n.ecli)
SELECT ecli, celex, error, CASE WHEN error IS NULL THEN concat_ws(';', CASE WHEN dated IS NULL THEN 'no date' END, CASE WHEN held <> celex THEN 'other CELEX held' END) ELSE '' END AS warnings, error IS NULL AS valid FROM e""")
def _(t):
    new = t.cases.select("ecli", X.first_tok("celex").alias("celex"), X.parse_date(X.min_tok("date_publication")).alias("date_decision"))
    return Q.validate_new(new, t.stored_cases)


@query("count_drift", "Q21", """
WITH st AS (SELECT case_id, sum(o) AS o, sum(i) AS i FROM (SELECT source_case_id AS case_id, count(*) AS o, 0 AS i FROM fx_edges GROUP BY 1 UNION ALL SELECT target_case_id, 0, count(*) FROM fx_edges WHERE target_case_id IS NOT NULL GROUP BY 1) u GROUP BY 1),
 p AS (SELECT DISTINCT source_case_id AS s, target_case_id AS t FROM fx_edges WHERE target_case_id IS NOT NULL AND source_case_id <> target_case_id AND relation_type <> 'joins'),
 nw AS (SELECT case_id, coalesce(a.n, 0) AS o, coalesce(b.n, 0) AS i FROM fx_cases LEFT JOIN (SELECT s AS case_id, count(*) AS n FROM p GROUP BY 1) a USING (case_id) LEFT JOIN (SELECT t AS case_id, count(*) AS n FROM p GROUP BY 1) b USING (case_id))
SELECT case_id, CAST(coalesce(st.o, 0) - coalesce(nw.o, 0) AS BIGINT) AS cites_drift, CAST(coalesce(st.i, 0) - coalesce(nw.i, 0) AS BIGINT) AS cited_by_drift FROM st FULL JOIN nw USING (case_id) WHERE coalesce(st.o, 0) <> coalesce(nw.o, 0) OR coalesce(st.i, 0) <> coalesce(nw.i, 0)""")
def _(t):
    return Q.count_drift(A.citation_counts(t.edges), A.refresh_counts(t.edges, relation_types(t), datasets(t), t.cases))
