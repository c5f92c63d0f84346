"""Dedup, ranking, top-N and sampling queries."""

from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as X
from ..operators import dedup, quality, topk
from .registry import query

COLLAPSE = r"trim(regexp_replace({c}, '\s+', ' ', 'g'))"

# Ranking rows of the texts view, as the checks see them.
CANDIDATES = r"""
cand AS (SELECT text_id, ecli, upper(language) AS language, text_source, source_window, celex, text,
    length(trim(text)) AS len,
    CASE WHEN length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 500 THEN md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) END AS digest,
    max(length(trim(text))) OVER (PARTITION BY ecli) AS longest FROM fx_texts),
eff AS (SELECT *, CASE WHEN text_source = 'INFOCURIA_BLOB_HTML' AND len > 0 AND longest >= 10000 AND len < 0.25 * longest THEN 'INFOCURIA_OJ_NOTICE' ELSE text_source END AS source FROM cand),
rnk AS (SELECT *, row_number() OVER (PARTITION BY ecli, language ORDER BY
    CASE WHEN len = 0 THEN 4 WHEN source = 'CELLAR_ITEM' THEN 0 WHEN source = 'INFOCURIA_OJ_NOTICE' THEN 3 WHEN source = 'INFOCURIA_BLOB_HTML' THEN 2 ELSE 1 END, text_id) AS rn FROM eff),
best AS (SELECT * FROM rnk WHERE rn = 1)"""


@query("dedup_cases", "G01", """
WITH w AS (SELECT ecli, string_agg(DISTINCT source_window, ';' ORDER BY source_window) AS windows FROM fx_case_rows WHERE trim(source_window) <> '' GROUP BY 1),
 r AS (SELECT *, row_number() OVER (PARTITION BY ecli ORDER BY CASE WHEN lower(coalesce(metadata_catalog_source, '')) = 'infocuria' THEN 0 ELSE 1 END, position) AS rn FROM fx_case_rows WHERE ecli IS NOT NULL)
SELECT position, r.ecli, celex, metadata_catalog_source, identity_source, coalesce(windows, '') AS source_window, text_language FROM r LEFT JOIN w ON w.ecli = r.ecli WHERE rn = 1
UNION ALL SELECT * FROM (SELECT position, ecli, celex, metadata_catalog_source, identity_source, source_window, text_language FROM fx_case_rows WHERE ecli IS NULL) n""")
def _(t):
    return dedup.dedup_cases(t.case_rows, ["position"])


@query("dedup_with_extra_keys", "G02", """
WITH w AS (SELECT ecli, text_language, string_agg(DISTINCT source_window, ';' ORDER BY source_window) AS windows FROM fx_case_rows WHERE trim(source_window) <> '' GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY ecli, text_language ORDER BY position) AS rn FROM fx_case_rows WHERE ecli IS NOT NULL)
SELECT position, r.ecli, r.text_language, coalesce(windows, '') AS source_window FROM r LEFT JOIN w ON w.ecli = r.ecli AND w.text_language = r.text_language WHERE rn = 1
UNION ALL SELECT position, ecli, text_language, source_window FROM fx_case_rows WHERE ecli IS NULL""")
def _(t):
    rows = t.case_rows.select("position", "ecli", "text_language", "source_window")
    return dedup.dedup_by_key(rows, ["ecli"], [F.col("position").asc()], "source_window",
                              extra=["text_language", "absent_column"])


@query("best_text", "G03", f"""
WITH {CANDIDATES} SELECT text_id, ecli, language, source AS effective_source, len AS length, digest FROM best""")
def _(t):
    return dedup.best_text(t.texts).select("text_id", "ecli", "language", "effective_source",
                                           F.col("length").cast("long").alias("length"), "digest")


@query("latest_snapshot", "G04", """
SELECT element_id, lido_id, bwb_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM (
 SELECT *, row_number() OVER (PARTITION BY lido_id ORDER BY snapshot_date DESC NULLS LAST, element_id) AS rn FROM fx_law_elements WHERE lido_id IS NOT NULL) x WHERE rn = 1
UNION ALL SELECT element_id, lido_id, bwb_id, CAST(snapshot_date AS VARCHAR) FROM (
 SELECT *, row_number() OVER (PARTITION BY bwb_id, bwb_label_id, element_type, number ORDER BY snapshot_date DESC NULLS LAST, element_id) AS rn FROM fx_law_elements WHERE lido_id IS NULL) y WHERE rn = 1""")
def _(t):
    out = ["element_id", "lido_id", "bwb_id", F.col("snapshot_date").cast("string").alias("snapshot_date")]
    elements = t.law_elements
    known = dedup.latest_per_key(elements.where("lido_id IS NOT NULL"), ["lido_id"], "snapshot_date", ["element_id"])
    loose = dedup.latest_per_key(elements.where("lido_id IS NULL"),
                                 ["bwb_id", "bwb_label_id", "element_type", "number"], "snapshot_date", ["element_id"])
    return known.select(*out).unionByName(loose.select(*out))


@query("canonical_variant", "G05", """
WITH v AS (SELECT *, coalesce(upper(trim(ecli)), concat('APPNO:', md5(concat(coalesce(appno, '?'), ':', coalesce(CAST(reference_date AS VARCHAR), ''))))) AS case_key FROM fx_echr_docs WHERE doctype NOT IN ('PR','CLIN','CLINF'))
SELECT case_key, item_id, docname FROM (SELECT *, row_number() OVER (PARTITION BY case_key ORDER BY CASE language_code WHEN 'ENG' THEN 0 WHEN 'FRE' THEN 1 ELSE 2 END,
  CASE WHEN doctype LIKE '%JUD%' THEN 1 WHEN doctype LIKE '%DEC%' THEN 2 WHEN doctype LIKE '%COM%' THEN 3 ELSE 4 END, item_id) AS rn FROM v) x WHERE rn = 1""")
def _(t):
    return dedup.canonical_variant(t.echr_docs).select("case_key", "item_id", "docname")


@query("dedup_edges", "G06", """
SELECT min(edge_id) AS edge_id, source_case_id, target_case_id, target_ecli_raw, target_celex_raw, relation_type, source_dataset FROM fx_edges GROUP BY ALL""")
def _(t):
    return dedup.dedup_edges(t.edges).select("edge_id", "source_case_id", "target_case_id", "target_ecli_raw",
                                             "target_celex_raw", "relation_type", "source_dataset")


@query("dedup_law_refs", "G07", """
SELECT ref_id, provision_id FROM (SELECT *, row_number() OVER (PARTITION BY case_id, role, source_dataset, raw_scheme, raw_resource, coalesce(raw_subdivision, '') ORDER BY provision_id DESC NULLS LAST, ref_id) rn FROM fx_law_refs WHERE raw_resource IS NOT NULL) x WHERE rn = 1
UNION ALL SELECT ref_id, provision_id FROM (SELECT *, row_number() OVER (PARTITION BY case_id, role, source_dataset, legislation_id, provision_id ORDER BY ref_id) rn FROM fx_law_refs WHERE raw_resource IS NULL) y WHERE rn = 1""")
def _(t):
    return dedup.dedup_law_refs(t.law_refs).select("ref_id", "provision_id")


@query("primary_and_remainder", "G08", """
SELECT item_id, CASE WHEN row_number() OVER (PARTITION BY g, language_code ORDER BY CASE WHEN doctype LIKE '%JUD%' THEN 1 WHEN doctype LIKE '%DEC%' THEN 2 ELSE 3 END, item_id) = 1 THEN 'primary' ELSE 'secondary' END AS part
FROM fx_echr_docs""")
def _(t):
    order = [F.least(dedup.doctype_rank("doctype"), F.lit(3)).asc(), F.col("item_id").asc()]
    primary, rest = dedup.split_primary(t.echr_docs, ["g", "language_code"], order, "item_id")
    return (primary.select("item_id", F.lit("primary").alias("part"))
            .unionByName(rest.select("item_id", F.lit("secondary").alias("part"))))


@query("canonical_text", "G09", """
SELECT text_id, case_id, language FROM (SELECT *, row_number() OVER (PARTITION BY case_id, language ORDER BY CASE text_source WHEN 'RECHTSPRAAK' THEN 1 WHEN 'HUDOC' THEN 2 WHEN 'INFOCURIA_BLOB_HTML' THEN 3 WHEN 'CELLAR_ITEM' THEN 4 ELSE 5 END, text_id) rn FROM fx_stored_texts) x WHERE rn = 1""")
def _(t):
    return dedup.canonical_text(t.stored_texts.select("text_id", "case_id", "language", "text_source")).select("text_id", "case_id", "language")


@query("text_for_scan", "G10", """
SELECT text_id, case_id, language, document_kind FROM (SELECT *, row_number() OVER (PARTITION BY case_id, language ORDER BY CASE WHEN document_kind IN ('judgment','order') THEN 0 WHEN document_kind = 'extract' THEN 1 WHEN document_kind = 'summary' THEN 3 ELSE 2 END,
   CASE text_source WHEN 'RECHTSPRAAK' THEN 1 WHEN 'HUDOC' THEN 2 WHEN 'INFOCURIA_BLOB_HTML' THEN 3 WHEN 'CELLAR_ITEM' THEN 4 ELSE 5 END, text_id) rn
 FROM (SELECT *, CASE quality WHEN 1 THEN CASE WHEN toxic = 1 THEN 'extract' ELSE 'judgment' END WHEN 0 THEN CASE WHEN toxic = 1 THEN 'misfiled' ELSE 'summary' END END AS document_kind
   FROM fx_stored_texts LEFT JOIN labels ON labels.doc_id = text_id) k WHERE document_kind IS DISTINCT FROM 'misfiled') x WHERE rn = 1""")
def _(t):
    kind = X.first_rule([
        ((F.col("quality") == 1) & (F.col("toxic") == 1), F.lit("extract")),
        (F.col("quality") == 1, F.lit("judgment")),
        ((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit("misfiled")),
        (F.col("quality") == 0, F.lit("summary")),
    ])
    labels = t.labels.withColumnRenamed("doc_id", "text_id").withColumn("document_kind", kind)
    rows = t.stored_texts.select("text_id", "case_id", "language", "text_source").join(
        labels.select("text_id", "document_kind"), "text_id", "left")
    return dedup.text_for_scan(rows).select("text_id", "case_id", "language", "document_kind")


@query("dedup_identifiers", "G11", """
WITH r AS (SELECT source_case_id AS case_id, relation_type AS scheme, coalesce(target_ecli_raw, CAST(target_case_id AS VARCHAR), target_celex_raw) AS v, source_dataset, weight > 40 AS is_primary, edge_id FROM fx_edges)
SELECT case_id, scheme, v AS value_normalized, source, is_primary, value FROM (SELECT *, source_dataset AS source, edge_id AS value, row_number() OVER (PARTITION BY case_id, scheme, v ORDER BY is_primary DESC, source_dataset, edge_id) rn FROM r) x WHERE rn = 1""")
def _(t):
    rows = t.edges.select(F.col("source_case_id").alias("case_id"), F.col("relation_type").alias("scheme"),
                          F.coalesce("target_ecli_raw", F.col("target_case_id").cast("string"), "target_celex_raw").alias("value_normalized"),
                          F.col("source_dataset").alias("source"), (F.col("weight") > 40).alias("is_primary"),
                          F.col("edge_id").alias("value"))
    return dedup.dedup_identifiers(rows)


@query("rank_target_rows", "G12", r"""
WITH e AS (SELECT DISTINCT ecli, concat('6', CAST(1995 + case_id % 7 AS VARCHAR), 'CJ', lpad(CAST(case_id % 10000 AS VARCHAR), 4, '0')) AS expected_celex FROM fx_texts),
 j AS (SELECT e.*, text_id, text_source, length(text) AS length, list_contains(list_transform(string_split(celex, ';'), lambda x: upper(trim(x))), expected_celex) AS celex_match,
   regexp_matches(left(trim(regexp_replace(text, '\s+', ' ', 'g')), 5000), '(?i)(^\S*\s*judgment\b|\bjudgment of the court\b|\bthe court(\s*\([^)]*\))? hereby\b)') AS judgment FROM e JOIN fx_texts USING (ecli))
SELECT ecli, expected_celex, text_id, celex_match, judgment, length FROM (SELECT *, row_number() OVER (PARTITION BY ecli, expected_celex ORDER BY celex_match DESC, judgment DESC, text_source = 'CELLAR_ITEM' DESC, length DESC, text_id) rn FROM j) x WHERE rn = 1""")
def _(t):
    return dedup.rank_targets(quality.expected_targets(t.texts), t.texts).select(
        "ecli", "expected_celex", "text_id", "celex_match", "judgment", F.col("length").cast("long").alias("length"))


@query("ordered_citation_strings", "G13", r"""
WITH d AS (SELECT s.source_case_id AS case_id, s.scl AS value, CASE line_no WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE 4 END AS r, concat(CAST(line_no AS VARCHAR), '-', CAST(tie AS VARCHAR)) AS item FROM fx_scl s),
 f AS (SELECT case_id, value, min(struct_pack(r := r, item := item)) AS pos_at FROM d GROUP BY 1, 2),
 l AS (SELECT case_id, arg_min(value, pos_at) AS lead FROM f GROUP BY 1)
SELECT case_id, value, CAST(pos_at.r AS BIGINT) AS priority, pos_at.item AS item FROM f JOIN l USING (case_id)
WHERE value = lead OR len(list_filter(list_transform(regexp_extract_all(value, '\d+/\d\d'), lambda x: ltrim(x, '0')), lambda x: NOT list_contains(list_transform(regexp_extract_all(lead, '\d+/\d\d'), lambda y: ltrim(y, '0')), x))) > 0""")
def _(t):
    doctype = X.first_rule([(F.col("line_no") == i + 1, F.lit(d)) for i, d in enumerate(("HEJUD", "HEDEC", "HFJUD", "HFDEC"))], F.lit("HJUD"))
    docs = t.scl.select(F.col("source_case_id").alias("case_id"), "scl", doctype.alias("doctype"),
                        F.concat_ws("-", "line_no", "tie").alias("item"))
    return dedup.ordered_strings(docs, "case_id", "scl", "doctype", "item").withColumn("priority", F.col("priority").cast("long"))


@query("article_references", "G15", """
WITH a AS (SELECT g AS case_id, trim(unnest(string_split(article, ';'))) AS article_code, 'applied' AS kind FROM fx_echr_docs
   UNION ALL SELECT g, trim(unnest(string_split(violation, ';'))), 'violation' FROM fx_echr_docs),
 m AS (SELECT DISTINCT article_code, CASE WHEN article_code LIKE 'P%' THEN article_code ELSE split_part(article_code, '-', 1) END AS provision_id, article_code AS raw_subdivision FROM a)
SELECT case_id, provision_id, kind, article_code FROM (SELECT *, row_number() OVER (PARTITION BY case_id, provision_id, kind ORDER BY trim(article_code), raw_subdivision) rn FROM a JOIN m USING (article_code)) x WHERE rn = 1""")
def _(t):
    d = t.echr_docs
    codes = (d.select(F.col("g").alias("case_id"), F.explode(X.toks("article")).alias("article_code"), F.lit("applied").alias("kind"))
             .unionByName(d.select(F.col("g").alias("case_id"), F.explode(X.toks("violation")).alias("article_code"), F.lit("violation").alias("kind"))))
    code = F.col("article_code")
    table = codes.select("article_code").distinct().select(
        code, F.when(ids.protocol(code).isNotNull(), code).otherwise(F.split_part(code, F.lit("-"), F.lit(1))).alias("provision_id"),
        code.alias("raw_subdivision"))
    return dedup.article_refs(codes, table).select("case_id", "provision_id", "kind", "article_code")


@query("first_entry_per_target", "G16", """
SELECT source_case_id, target_case_id, edge_id FROM (SELECT *, row_number() OVER (PARTITION BY source_case_id, target_case_id ORDER BY weight, edge_id) rn FROM fx_edges WHERE target_case_id IS NOT NULL) x WHERE rn = 1""")
def _(t):
    edges = t.edges.where("target_case_id IS NOT NULL")
    return dedup.dedup_targets(edges, [F.col("weight").asc(), F.col("edge_id").asc()]).select("source_case_id", "target_case_id", "edge_id")


@query("top_cited_cases", "K01", """
SELECT ecli, (length(cited_by) - length(replace(cited_by, ';', ''))) AS in_degree, subject_matter AS subject,
 coalesce(CAST(year(TRY_CAST(list_min(list_transform(string_split(date_publication, ';'), lambda x: trim(x))) AS DATE)) AS VARCHAR), '') AS year
FROM fx_cases WHERE cited_by <> '' ORDER BY in_degree DESC, ecli LIMIT 10""")
def _(t):
    return topk.top_cited(t.cases, 10)


@query("cursor_page", "K02", """
SELECT ecli, CAST(date_decision AS VARCHAR) AS day FROM fx_stored_cases
WHERE date_decision < DATE '1998-05-10' OR date_decision IS NULL OR (date_decision = DATE '1998-05-10' AND ecli > 'ECLI:EU:C:1998:3') ORDER BY date_decision DESC NULLS LAST, ecli LIMIT 50""")
def _(t):
    rows = topk.page(t.stored_cases, ("1998-05-10", "ECLI:EU:C:1998:3"), 50)
    return rows.select("ecli", F.col("date_decision").cast("string").alias("day"))


@query("stratified_sample", "K03", """
WITH e AS (SELECT edge_id, concat(relation_type, '/', source_dataset) AS stratum_code FROM fx_edges), c AS (SELECT stratum_code AS stratum, count(*) AS n FROM e GROUP BY 1),
 b AS (SELECT *, least(n, 25) AS base, sum(n) OVER () AS total, 320 - sum(least(n, 25)) OVER () AS rest FROM c),
 d AS (SELECT stratum, n, base + CASE WHEN rest > 0 THEN least(n - base, CAST(round_even(CAST(rest AS DOUBLE) * n / total, 0) AS BIGINT)) ELSE 0 END AS k, total FROM b),
 m AS (SELECT *, least(320, total) - sum(k) OVER () AS missing, row_number() OVER (ORDER BY CASE WHEN n > k THEN 0 ELSE 1 END, stratum) AS pos FROM d),
 w AS (SELECT stratum, k + CASE WHEN n > k AND pos <= missing THEN 1 ELSE 0 END AS k FROM m)
SELECT edge_id, stratum_code FROM (SELECT *, row_number() OVER (PARTITION BY stratum_code ORDER BY md5(concat(edge_id, '|20261126')), edge_id) AS r FROM e) x JOIN w ON stratum = stratum_code WHERE r <= k""")
def _(t):
    edges = t.edges.select("edge_id", F.concat_ws("/", "relation_type", "source_dataset").alias("stratum_code"))
    return topk.stratified_sample(edges, "stratum_code", ["edge_id"], 320, 25, 20261126)


@query("stratum_allocation", "K03", """
WITH c AS (SELECT relation_type AS stratum, count(*) AS n FROM fx_edges GROUP BY 1), b AS (SELECT *, least(n, 25) AS base, sum(n) OVER () AS total, 320 - sum(least(n, 25)) OVER () AS rest FROM c),
 d AS (SELECT stratum, n, base + least(n - base, CAST(round_even(CAST(rest AS DOUBLE) * n / total, 0) AS BIGINT)) AS k, total FROM b),
 m AS (SELECT *, least(320, total) - sum(k) OVER () AS missing, row_number() OVER (ORDER BY stratum) AS pos FROM d)
SELECT stratum, n, CAST(k + CASE WHEN pos <= missing THEN 1 ELSE 0 END AS BIGINT) AS k FROM m""")
def _(t):
    return topk.allocate(t.edges.groupBy(F.col("relation_type").alias("stratum")).agg(F.count("*").alias("n")), 320, 25)


@query("seeded_sample", "K04", "SELECT edge_id, source_case_id FROM fx_edges ORDER BY md5(concat(edge_id, '|20261126')), edge_id LIMIT 60")
def _(t):
    return topk.sample_rows(t.edges.select("edge_id", "source_case_id"), ["edge_id"], 60, 20261126)


@query("top_degree_change", "K05", """
WITH o AS (SELECT source_case_id, count(DISTINCT target_case_id) AS b FROM fx_edges WHERE target_case_id IS NOT NULL GROUP BY 1),
 n AS (SELECT source_case_id, count(DISTINCT target_case_id) AS a FROM fx_edges WHERE target_case_id IS NOT NULL AND relation_type = 'cites' GROUP BY 1)
SELECT source_case_id, b AS before, coalesce(a, 0) AS after, b - coalesce(a, 0) AS dropped FROM o LEFT JOIN n USING (source_case_id) ORDER BY b DESC, source_case_id LIMIT 15""")
def _(t):
    resolved = t.edges.where("target_case_id IS NOT NULL")
    return topk.top_change(resolved, resolved.where("relation_type = 'cites'"), 15)


@query("largest_group_sample", "K06", """
WITH g AS (SELECT celex_id, count(DISTINCT ecli) AS members FROM fx_cases GROUP BY 1 HAVING count(DISTINCT ecli) > 1 ORDER BY celex_id LIMIT 20)
SELECT celex_id, members, string_agg(ecli, ';' ORDER BY ecli) AS sample FROM g JOIN fx_cases USING (celex_id) GROUP BY 1, 2""")
def _(t):
    return topk.sample_groups(t.cases, "celex_id", "ecli", 20)
