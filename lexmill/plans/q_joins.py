"""Key resolution and lookup queries."""

from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as X
from ..operators import dedup
from ..operators import joins as J
from .q_columns import toks_sql
from .registry import query

RULES = (
    ("Rossi", "Rino Rossi", "CJEU", "ECLI:EU:C:", 1990, 1996),
    ("Rossi", "Lucia Serena Rossi", "CJEU", "ECLI:EU:C:", 1998, 2026),
    ("Rossi", "Third Rossi", "EGC", "ECLI:EU:T:", 1994, 1999),
    ("Rossi", "Fourth Rossi", "EGC", "ECLI:EU:T:", 1999, 2001),
)
RULES_SQL = "(VALUES " + ", ".join(str(r) for r in RULES) + ") r(source_name, target_name, rule_court, ecli_prefix, min_year, max_year)"


def era_rules(t):
    return t.spark.createDataFrame(RULES, "source_name string, target_name string, rule_court string, ecli_prefix string, min_year int, max_year int")


def clean_raw_edges(t):
    return t.raw_edges.select("line_no", "weight", "source_item", "target_item", "source",
                              F.coalesce("relation_type", F.lit("cites")).alias("relation_type"),
                              ids.norm_ecli("source_ecli").alias("source_ecli"), ids.norm_ecli("target_ecli").alias("target_ecli_raw"))


@query("resolve_ecli_targets", "J01", """
SELECT line_no, source_ecli, t.case_id AS target_case_id, CASE WHEN t.case_id IS NULL THEN tgt END AS target_ecli_raw FROM (
  SELECT line_no, upper(trim(source_ecli)) AS source_ecli, upper(trim(target_ecli)) AS tgt FROM fx_raw_edges) e LEFT JOIN fx_cases t ON t.ecli = e.tgt""")
def _(t):
    edges = clean_raw_edges(t).select("line_no", "source_ecli", "target_ecli_raw")
    return J.resolve_targets(edges, t.cases, "target_ecli_raw", "ecli", keep_raw=False)


@query("resolve_celex_targets", "J01", """
WITH c AS (SELECT celex_id, min(case_id) AS case_id FROM fx_cases GROUP BY 1)
SELECT edge_id, target_celex_raw, c.case_id AS target_case_id FROM fx_edges e LEFT JOIN c ON c.celex_id = e.target_celex_raw WHERE target_celex_raw IS NOT NULL""")
def _(t):
    edges = t.edges.where("target_celex_raw IS NOT NULL").select("edge_id", "target_celex_raw")
    return J.resolve_targets(edges, t.cases, "target_celex_raw", "celex_id", keep_raw=True)


@query("resolve_by_item", "J02", """
SELECT line_no, CAST(source_item AS BIGINT) AS source_case_id, o.o_orderkey AS target_case_id, weight FROM fx_raw_edges e LEFT JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = target_item""")
def _(t):
    docs = t.orders.select(F.col("o_orderkey").cast("string").alias("item_id"), F.col("o_orderkey").alias("case_id"))
    return J.resolve_by_item(t.raw_edges.select("line_no", "source_item", "target_item", "weight"), docs).select(
        "line_no", "source_case_id", "target_case_id", "weight")


@query("resolve_by_priority", "J03", """
WITH r AS (SELECT edge_id AS ref_id, source_case_id, target_ecli_raw AS te, target_celex_raw AS tc, CAST(target_case_id AS VARCHAR) AS ti FROM fx_edges),
 cx AS (SELECT celex_id, min(case_id) AS case_id FROM fx_cases GROUP BY 1),
 x AS (SELECT ref_id, source_case_id, coalesce(e.case_id, cx.case_id, i.case_id) AS target_case_id, CASE WHEN e.case_id IS NOT NULL THEN 'ecli' WHEN cx.case_id IS NOT NULL THEN 'celex_id' ELSE 'item_id' END AS scheme
   FROM r LEFT JOIN fx_cases e ON e.ecli = te LEFT JOIN cx ON cx.celex_id = tc LEFT JOIN fx_cases i ON CAST(i.case_id AS VARCHAR) = ti)
SELECT * FROM x WHERE target_case_id <> source_case_id""")
def _(t):
    refs = t.edges.select(F.col("edge_id").alias("ref_id"), "source_case_id", F.col("target_ecli_raw").alias("target_ecli"),
                          F.col("target_celex_raw").alias("target_celex"), F.col("target_case_id").cast("string").alias("target_item"))
    cases = t.cases.select("case_id", "ecli", "celex_id", F.col("case_id").cast("string").alias("item_id"))
    return J.resolve_case_key(refs, cases)


@query("resolve_alias_eclis", "J04", """
WITH v AS (SELECT DISTINCT target_ecli_raw AS value FROM fx_edges WHERE target_ecli_raw IS NOT NULL UNION SELECT DISTINCT replaces_identifier FROM fx_rs_docs WHERE replaces_identifier IS NOT NULL),
 a AS (SELECT ecli AS value, 0 AS via, case_id FROM fx_cases WHERE sector <> '8' UNION ALL SELECT replaces_identifier, 1, doc_id FROM fx_rs_docs),
 b AS (SELECT value, via, case_id, row_number() OVER (PARTITION BY value ORDER BY via, case_id) rn FROM a)
SELECT v.value, b.case_id, CAST(b.via AS BIGINT) AS via FROM v LEFT JOIN b ON b.value = v.value AND rn = 1""")
def _(t):
    values = (t.edges.select(F.col("target_ecli_raw").alias("value")).union(t.rs_docs.select("replaces_identifier"))
              .where("value IS NOT NULL").distinct())
    aliases = t.rs_docs.select(F.lit("ecli").alias("scheme"), F.col("replaces_identifier").alias("value_normalized"), F.col("doc_id").alias("case_id"))
    return J.resolve_alias(values, t.cases.where("sector <> '8'"), aliases).withColumn("via", F.col("via").cast("long"))


@query("latest_provision", "J05", """
WITH p AS (SELECT bwb_label_id, element_id, row_number() OVER (PARTITION BY bwb_label_id ORDER BY snapshot_date DESC NULLS LAST, element_id) rn FROM fx_law_elements)
SELECT ref_id, p.element_id AS latest_provision_id FROM fx_law_refs r LEFT JOIN p ON p.bwb_label_id = r.raw_label_id AND rn = 1""")
def _(t):
    return J.latest_provision(t.law_refs, t.law_elements).select("ref_id", "latest_provision_id")


@query("pairs_not_yet_loaded", "J06", """
SELECT ref_id FROM fx_law_refs n WHERE NOT EXISTS (SELECT 1 FROM fx_law_refs o WHERE o.source_dataset = 'rs_lido_ref' AND o.case_id = n.case_id AND o.raw_resource IS NOT DISTINCT FROM n.raw_resource AND o.raw_label_id IS NOT DISTINCT FROM n.raw_label_id)""")
def _(t):
    return J.not_yet_loaded(t.law_refs, t.law_refs.where("source_dataset = 'rs_lido_ref'"),
                            ["case_id", "raw_resource", "raw_label_id"]).select("ref_id")


@query("absent_acts", "J07", """
SELECT DISTINCT raw_resource AS bwb_id FROM fx_law_refs WHERE raw_resource IS NOT NULL AND raw_resource NOT IN (SELECT bwb_id FROM fx_law_elements)""")
def _(t):
    cited = t.law_refs.select(F.col("raw_resource").alias("bwb_id")).where("bwb_id IS NOT NULL").distinct()
    return J.absent(cited, t.law_elements, "bwb_id")


@query("cases_having_texts", "J08", "SELECT case_id, ecli FROM fx_cases WHERE case_id IN (SELECT case_id FROM fx_texts)")
def _(t):
    return J.having(t.cases, t.texts).select("case_id", "ecli")


@query("join_either_key", "J09", """
WITH s AS (SELECT item_id AS staged, CASE WHEN g % 5 = 0 THEN NULL ELSE ecli END AS e FROM fx_echr_docs), c AS (SELECT ecli, min(g) AS case_id FROM fx_echr_docs WHERE ecli IS NOT NULL GROUP BY 1)
SELECT staged, c.case_id FROM s JOIN c ON c.ecli = s.e WHERE e IS NOT NULL UNION ALL SELECT staged, d.g FROM s JOIN fx_echr_docs d ON d.item_id = staged WHERE e IS NULL""")
def _(t):
    cases = t.echr_docs.select(F.col("g").alias("case_id"), "ecli", "item_id")
    staged = t.echr_docs.select(F.col("item_id").alias("staged"), F.col("ecli").alias("staged_ecli"))
    return J.join_either(staged, cases, "staged_ecli", "staged", "case_id").select("staged", "case_id")


@query("link_values_to_dimension", "J10", f"""
SELECT DISTINCT case_id, n_nationkey AS dim_id FROM (SELECT case_id, replace(unnest({toks_sql('judges')}), 'Judge ', 'NATION_') AS name FROM fx_cases) x JOIN nation ON n_name = name""")
def _(t):
    dim = t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("dim_id"))
    names = F.transform(X.toks("judges"), lambda j: F.replace(j, F.lit("Judge "), F.lit("NATION_")))
    return J.link_values(t.cases, "case_id", names, dim, "name", "dim_id")


@query("assign_by_era", "J11", f"""
WITH l AS (SELECT case_id, person_id, role, court_code, ecli, CAST(year(date_decision) AS INT) AS y FROM fx_person_links JOIN fx_people USING (person_id) WHERE full_name = 'Rossi'),
 h AS (SELECT case_id, person_id, role, target_name FROM l JOIN {RULES_SQL} ON (court_code = rule_court OR (court_code = '' AND starts_with(ecli, ecli_prefix))) AND y BETWEEN min_year AND max_year)
SELECT case_id, person_id, role, min(target_name) AS target_name FROM h GROUP BY 1, 2, 3 HAVING count(*) = 1""")
def _(t):
    links = t.person_links.join(t.people.select("person_id", "full_name"), "person_id")
    return J.assign_by_era(links, era_rules(t), ["case_id", "person_id", "role"])


@query("match_by_date_and_token", "J12", """
WITH e AS (SELECT o_orderkey AS entry_id, CAST(o_orderdate AS DATE) AS d, concat(CAST(o_orderkey % 100000 AS VARCHAR), '/', CASE WHEN o_orderstatus = 'O' THEN left(CAST(o_custkey AS VARCHAR), 1) ELSE CAST(o_custkey AS VARCHAR) END) AS token FROM orders
  UNION ALL SELECT -r.doc_id, r.date_decision, substring(replace(lower(zaaknummer), ' ', ''), 1 + CAST(r.doc_id % 3 AS INT), 4) FROM fx_rs_docs r)
SELECT entry_id, doc_id FROM e JOIN fx_rs_docs r ON r.date_decision = e.d WHERE length(token) >= 4 AND contains(replace(lower(zaaknummer), ' ', ''), token)""")
def _(t):
    cust = F.col("o_custkey").cast("string")
    tail = F.when(F.col("o_orderstatus") == "O", F.left(cust, F.lit(1))).otherwise(cust)
    entries = t.orders.select(F.col("o_orderkey").alias("entry_id"), F.col("o_orderdate").cast("date").alias("date_decision"),
                              F.concat((F.col("o_orderkey") % 100000).cast("string"), F.lit("/"), tail).alias("token"))
    # short pieces of docket numbers, mostly without a digit
    number = F.replace(F.lower("zaaknummer"), F.lit(" "), F.lit(""))
    pieces = t.rs_docs.select((-F.col("doc_id")).alias("entry_id"), "date_decision", F.substring(number, (F.col("doc_id") % 3 + 1).cast("int"), F.lit(4)).alias("token"))
    entries = entries.unionByName(pieces)
    return J.match_by_date_and_token(entries, t.rs_docs).select("entry_id", "doc_id")


@query("match_by_court_date", "J13", """
WITH e AS (SELECT o_orderkey AS entry_id, CAST(o_orderdate AS DATE) AS d, CASE o_custkey % 3 WHEN 0 THEN 'Hoge Raad' WHEN 1 THEN 'Rechtbank Amsterdam' ELSE 'Gerechtshof Den Haag' END AS court FROM orders)
SELECT entry_id, min(doc_id) AS doc_id FROM e JOIN fx_rs_docs r ON r.date_decision = e.d AND r.instance = e.court GROUP BY 1 HAVING count(*) = 1""")
def _(t):
    court = X.first_rule([(F.col("o_custkey") % 3 == 0, F.lit("Hoge Raad")), (F.col("o_custkey") % 3 == 1, F.lit("Rechtbank Amsterdam"))], F.lit("Gerechtshof Den Haag"))
    entries = t.orders.select(F.col("o_orderkey").alias("entry_id"), F.col("o_orderdate").cast("date").alias("date_decision"), court.alias("court"))
    return J.match_by_court_date(entries, t.rs_docs)


@query("targets_not_in_the_future", "J14", """
SELECT edge_id FROM fx_edges e JOIN fx_cases s ON s.case_id = e.source_case_id JOIN fx_stored_cases g ON g.case_id = e.target_case_id WHERE NOT coalesce(g.date_decision > s.date_decision, false)""")
def _(t):
    src = t.cases.select(F.col("case_id").alias("source_case_id"), F.col("date_decision").alias("source_date"))
    tgt = t.stored_cases.select(F.col("case_id").alias("target_case_id"), F.col("date_decision").alias("target_date"))
    # both tables have a row for each case: a broadcast, chosen by their file size, would hold all of them in every executor
    joined = t.edges.select("edge_id", "source_case_id", "target_case_id").join(src.hint("merge"), "source_case_id").join(tgt.hint("merge"), "target_case_id")
    return J.not_future(joined, "source_date", "target_date").select("edge_id")


@query("shared_number_pairs", "J15", """
SELECT DISTINCT a.item_id AS lead_item, b.item_id AS other_item FROM fx_echr_docs a JOIN fx_echr_docs b ON a.appno = b.appno AND a.item_id <> b.item_id WHERE a.doctype_branch = 'GRANDCHAMBER' AND a.doctype LIKE '%JUD%' AND b.doctype LIKE '%JUD%'""")
def _(t):
    judgments = t.echr_docs.where("doctype LIKE '%JUD%'")
    return J.shared_number_pairs(judgments.select("item_id", "appno"), judgments.where("doctype_branch = 'GRANDCHAMBER'"))


@query("lookup_act_with_alternatives", "J16", """
WITH a AS (SELECT bwb_id, min(element_id) AS act_id FROM fx_law_elements WHERE element_type = 'wet' GROUP BY 1), p AS (SELECT a.act_id, number, min(element_id) AS provision_id FROM fx_law_elements e JOIN a USING (bwb_id) WHERE element_type = 'artikel' GROUP BY 1, 2),
 r AS (SELECT ref_id, raw_resource AS i0, concat('BWBR', lpad(CAST(legislation_id * 4 AS VARCHAR), 9, '0')) AS i1, lower(raw_subdivision) AS article FROM fx_law_refs WHERE raw_resource IS NOT NULL)
SELECT ref_id, coalesce(x.act_id, y.act_id) AS act_id, p.provision_id FROM r LEFT JOIN a x ON x.bwb_id = i0 LEFT JOIN a y ON y.bwb_id = i1 LEFT JOIN p ON p.act_id = coalesce(x.act_id, y.act_id) AND p.number = article""")
def _(t):
    acts = t.law_elements.where("element_type = 'wet'").groupBy(F.col("bwb_id").alias("identifier")).agg(F.min("element_id").alias("act_id"))
    articles = t.law_elements.where("element_type = 'artikel'").join(acts, F.col("bwb_id") == F.col("identifier")).select(
        "act_id", F.col("number").alias("article_label"), F.col("element_id").alias("provision_id"))
    other = F.concat(F.lit("BWBR"), F.lpad((F.col("legislation_id") * 4).cast("string"), 9, "0"))
    refs = t.law_refs.where("raw_resource IS NOT NULL").select("ref_id", F.col("raw_resource").alias("identifier"),
                                                               F.array_compact(F.array(other)).alias("alternatives"), F.col("raw_subdivision").alias("article"))
    return J.lookup_act(refs, acts, articles).select("ref_id", "act_id", "provision_id")


@query("opinion_parent_by_uri", "J17", """
WITH n AS (SELECT case_number, min(case_id) AS parent FROM fx_stored_cases GROUP BY 1)
SELECT o.case_id, n.parent AS parent_case_id FROM fx_stored_cases o LEFT JOIN n ON n.case_number = concat('C-', CAST(o.case_id % 9000 AS VARCHAR), '/95')""")
def _(t):
    uri = F.concat(F.lit("http://x.example/resource/case/C-"), (F.col("case_id") % 9000).cast("string"), F.when(F.col("case_id") % 2 == 0, "%2F95").otherwise("/95"))
    opinions = t.stored_cases.select("case_id", uri.alias("parent_raw"))
    return J.opinion_parent(opinions, t.stored_cases).select("case_id", "parent_case_id")


@query("opinion_links_by_celex", "J18", r"""
WITH d AS (SELECT celex_id, min(case_id) AS case_id FROM fx_cases GROUP BY 1), o AS (SELECT case_id, celex_id FROM fx_cases WHERE regexp_matches(celex_id, '^6\d{4}CC\d{4}$'))
SELECT o.case_id AS source_case_id, coalesce(j.case_id, r.case_id) AS target_case_id, CASE WHEN j.case_id IS NOT NULL THEN 'CJ' ELSE 'CO' END AS letters
FROM o LEFT JOIN d j ON j.celex_id = replace(o.celex_id, 'CC', 'CJ') LEFT JOIN d r ON r.celex_id = replace(o.celex_id, 'CC', 'CO') WHERE j.case_id IS NOT NULL OR r.case_id IS NOT NULL""")
def _(t):
    return J.opinion_links(t.cases.select("case_id", "celex_id"))


@query("cases_with_texts", "J19", """
SELECT c.ecli, c.celex, t.celex AS celex_text, t.text_id, t.language FROM fx_cases c LEFT JOIN fx_texts t ON t.ecli = c.ecli""")
def _(t):
    return J.cases_with_texts(t.cases.select("ecli", "celex"), t.texts.select("ecli", "celex", "text_id", "language"))


@query("merge_conflicts", "J20", """
WITH m AS (SELECT c_custkey AS old_id, c_custkey - 1 AS new_id FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT old_id, new_id, count(*) AS conflicts FROM m JOIN fx_person_links a ON a.person_id = old_id WHERE EXISTS (SELECT 1 FROM fx_person_links b WHERE b.person_id = new_id AND b.case_id // 40 = a.case_id // 40 AND b.role = a.role) GROUP BY 1, 2""")
def _(t):
    merges = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("old_id"), (F.col("c_custkey") - 1).alias("new_id"))
    links = t.person_links.select("person_id", F.floor(F.col("case_id") / 40).alias("case_id"), "role")
    return J.merge_conflicts(links, merges)


@query("documents_with_text", "J21", """
WITH c AS (SELECT * FROM (SELECT text_id, case_id, language, row_number() OVER (PARTITION BY case_id, language ORDER BY CASE text_source WHEN 'RECHTSPRAAK' THEN 1 WHEN 'INFOCURIA_BLOB_HTML' THEN 3 WHEN 'CELLAR_ITEM' THEN 4 ELSE 5 END, text_id) rn FROM fx_stored_texts) x WHERE rn = 1)
SELECT d.item_id, c.text_id FROM (SELECT item_id, g AS case_id, CASE language_code WHEN 'ENG' THEN 'en' ELSE 'fr' END AS language FROM fx_echr_docs) d LEFT JOIN c USING (case_id, language)""")
def _(t):
    docs = t.echr_docs.select("item_id", F.col("g").alias("case_id"), ids.norm_hudoc_lang("language_code").alias("language"))
    texts = dedup.canonical_text(t.stored_texts.select("text_id", "case_id", "language", "text_source"))
    return J.documents_with_text(docs, texts).select("item_id", "text_id")
