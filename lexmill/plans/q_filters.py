"""Filter and search queries."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import filters as S
from ..operators import postings as P
from .q_columns import toks_sql
from .registry import query

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


@query("date_and_sector_filter", "F01", f"""
SELECT case_id, ecli FROM fx_cases WHERE TRY_CAST({toks_sql('date_publication')}[1] AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1999-06-30' AND sector = '6'""")
def _(t):
    return S.filter_cases(t.cases, "1996-03-01", "1999-06-30", "6").select("case_id", "ecli")


@query("keyword_filter", "F02", "SELECT case_id FROM fx_cases WHERE subject_matter ILIKE '%vat%' AND subject_matter ILIKE '%urgent%'")
def _(t):
    return S.filter_keywords(t.cases, "subject_matter", ["VAT", "Urgent"]).select("case_id")


@query("text_match_terms", "F03", f"""
WITH w AS (SELECT text_id, {_WORDS} AS w FROM fx_texts)
SELECT text_id, list_contains(w, 'der') AND list_contains(w, 'und') AS all_terms, list_contains(w, 'the') OR list_contains(w, 'les') AS any_term,
 contains(concat(' ', array_to_string(w, ' '), ' '), ' de la ') AS phrase FROM w""")
def _(t):
    asked = P.ask(t.spark, all_terms=("all", ["der", "und"]), any_term=("any", ["the", "les"]), phrase=("phrase", ["de", "la"]))
    hits = P.search(P.write_index(t.texts, ["text_id"]), asked)
    tests = {c: F.coalesce(F.bool_or(F.col("query_id") == c), F.lit(False)) for c in ("all_terms", "any_term", "phrase")}
    return t.texts.select("text_id").join(hits, "text_id", "left").groupBy("text_id").agg(*[v.alias(c) for c, v in tests.items()])


@query("text_match_scan", "F03", f"""
WITH w AS (SELECT text_id, {_WORDS} AS w FROM fx_texts)
SELECT text_id FROM w WHERE list_contains(w, 'der') AND contains(concat(' ', array_to_string(w, ' '), ' '), ' der die ')""")
def _(t):
    return t.texts.where(S.text_match("text", ["der"], ["der", "die"])).select("text_id")


@query("article_filter_modes", "F04", """
WITH a AS (SELECT DISTINCT item_id, trim(unnest(string_split(article, ';'))) AS c FROM fx_echr_docs)
SELECT item_id, 'any' AS mode FROM a WHERE c IN ('6', 'P1-1') GROUP BY 1 UNION ALL SELECT item_id, 'all' FROM a WHERE c IN ('6', 'P1-1') GROUP BY 1 HAVING count(*) = 2""")
def _(t):
    articles = t.echr_docs.select("item_id", F.lit("applied").alias("kind"), F.explode(X.toks("article")).alias("article_code"))
    modes = [S.cases_with_articles(articles, ["6", "P1-1"], "applied", m).withColumn("mode", F.lit(m)) for m in ("any", "all")]
    return modes[0].unionByName(modes[1])


@query("domain_overlap_filter", "F05", f"SELECT doc_id FROM fx_rs_docs WHERE list_has_any({toks_sql('domains_cell')}, ['Belastingrecht', 'Strafrecht'])")
def _(t):
    return S.filter_domains(t.rs_docs.withColumn("domains", X.toks("domains_cell")), "domains", ["Belastingrecht", "Strafrecht"]).select("doc_id")


@query("corpus_membership_filter", "F06", "SELECT case_id FROM fx_cases WHERE contains(sector, '8')")
def _(t):
    return S.in_corpus(t.cases.withColumn("sources", X.toks("sector")), "8").select("case_id")


@query("number_and_title_search", "F07", "SELECT doc_id FROM fx_rs_docs WHERE zaaknummer ILIKE '%awb 12%' OR instance ILIKE '%awb 12%'")
def _(t):
    return S.number_like(t.rs_docs, ["zaaknummer", "instance"], "awb 12").select("doc_id")


@query("judgments_and_decisions", "F08", "SELECT item_id, doctype FROM fx_echr_docs WHERE doctype ILIKE '%JUD%' OR doctype ILIKE '%DEC%'")
def _(t):
    return S.judgments_decisions(t.echr_docs).select("item_id", "doctype")


@query("drop_always_null_columns", "F09", "SELECT ecli, nonviolation, item_id FROM fx_echr_docs")
def _(t):
    rows = t.echr_docs.select("ecli", "item_id", F.lit(None).cast("string").alias("empty_note"), F.lit("  ").alias("blank_note"), "nonviolation")
    return S.drop_always_null(rows)


@query("privacy_guard", "F10", """
SELECT ecli, ecli LIKE 'ECLI:EU:%' AS allowed FROM (SELECT ecli FROM fx_cases UNION ALL SELECT ecli FROM fx_rs_docs UNION ALL SELECT coalesce(ecli, item_id) FROM fx_echr_docs) u""")
def _(t):
    rows = t.cases.select("ecli").unionAll(t.rs_docs.select("ecli")).unionAll(t.echr_docs.select(F.coalesce("ecli", "item_id").alias("ecli")))
    ok, bad = S.guard_ecli(rows, "ECLI:EU:")
    return S.guard_or_fail(ok, "ECLI:EU:").withColumn("allowed", F.lit(True)).unionByName(bad.withColumn("allowed", F.lit(False)))


@query("dark_dataset_violations", "F11", """
SELECT source_dataset, count(*) AS links, CASE source_dataset WHEN 'body-cite' THEN 'counted' WHEN 'legacy-ddb' THEN 'active' ELSE 'not registered' END AS reason
FROM (SELECT source AS source_dataset FROM fx_raw_edges) e WHERE source_dataset <> 'formal-relation' GROUP BY 1""")
def _(t):
    links = t.raw_edges.withColumnRenamed("source", "source_dataset")
    known = links.select("source_dataset").distinct().where("source_dataset <> 'other'")
    return S.dark_violations(links, known.withColumn("counted", F.col("source_dataset") == "body-cite")
                             .withColumn("active", F.col("source_dataset") == "legacy-ddb"))
