"""Input views derived from the driver's tables.

Each view is one SELECT that both Spark and the checking engine accept. Row counts grow
with the base tables: keys come from order, part and document keys, never from a fixed
modulus alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Reused scalar snippets -------------------------------------------------------
_DAY = "CAST({0} AS DATE)"
_STR = "CAST({0} AS STRING)"
_LETTERS = (
    "concat(CASE {k} % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'T' ELSE 'F' END, "
    "CASE {s} WHEN 'F' THEN 'J' WHEN 'O' THEN 'O' ELSE 'C' END)"
)
_CELEX = (
    "concat('6', {y}, " + _LETTERS + ", lpad(CAST({k} % 10000 AS STRING), 4, '0'), "
    "CASE WHEN {k} >= 10000 THEN concat('(', lpad(CAST(CAST(floor({k} / 10000) AS BIGINT) % 100 AS STRING), 2, '0'), ')') "
    "ELSE '' END)"
)


def celex_sql(key: str, status: str, year: str) -> str:
    return _CELEX.format(k=key, s=status, y=year)


def ecli_sql(key: str) -> str:
    return f"concat('ECLI:EU:C:', CAST(1995 + {key} % 7 AS STRING), ':', CAST({key} AS STRING))"


_YEAR = "CAST(year(o_orderdate) AS STRING)"
_ODATE = "CAST(o_orderdate AS DATE)"
_PLUS30 = "CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE)"
_MONTHS3 = "'JanFebMarAprMayJunJulAugSepOctNovDec'"


def appno_sql(h: str) -> str:
    return (
        f"concat(CAST(CAST(floor({h} / 100) AS BIGINT) % 899999 + 1 AS STRING), '/', "
        f"lpad(CAST({h} % 100 AS STRING), 2, '0'))"
    )


def group_date_sql(g: str) -> str:
    """Decision date of an application group."""
    return f"CAST(DATE '1995-01-01' + CAST({g} % 2400 AS INT) AS DATE)"


VIEWS: dict[str, str] = {
    # cases: one row per ECLI; CELEX repeats per (customer, year, status)
    "fx_cases": f"""
SELECT o_orderkey AS case_id,
  {ecli_sql('o_orderkey')} AS ecli,
  CASE o_orderpriority
    WHEN '5-LOW' THEN concat({celex_sql('o_custkey', 'o_orderstatus', _YEAR)}, '_SUM')
    WHEN '4-NOT SPECIFIED' THEN concat({celex_sql('o_custkey', 'o_orderstatus', _YEAR)}, '_INF; ', {celex_sql('o_custkey', 'o_orderstatus', _YEAR)})
    WHEN '3-MEDIUM' THEN CASE WHEN o_orderstatus = 'P' THEN concat({celex_sql('o_custkey', 'o_orderstatus', _YEAR)}, '.01')
                         ELSE {celex_sql('o_custkey', 'o_orderstatus', _YEAR)} END
    ELSE {celex_sql('o_custkey', 'o_orderstatus', _YEAR)} END AS celex,
  {celex_sql('o_custkey', 'o_orderstatus', _YEAR)} AS celex_id,
  CASE o_orderstatus WHEN 'F' THEN '6' WHEN 'O' THEN '8' ELSE '6;8' END AS sector,
  CASE WHEN o_orderstatus = 'P' THEN concat(CAST({_PLUS30} AS STRING), '; ', CAST({_ODATE} AS STRING))
       WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'unknown'
       ELSE CAST({_ODATE} AS STRING) END AS date_publication,
  {_ODATE} AS date_decision,
  substring(CAST({_ODATE} AS STRING), 1, 7) AS source_window,
  concat(' ', o_orderpriority, '; ', CASE WHEN o_custkey % 2 = 0 THEN 'VAT' ELSE '' END, ';') AS subject_matter,
  CASE WHEN o_orderkey % 3 = 0 THEN 'infocuria' ELSE 'cellar' END AS identity_source,
  CASE o_custkey % 6 WHEN 0 THEN 'English' WHEN 1 THEN ' french;German' WHEN 2 THEN 'nl'
       WHEN 3 THEN 'Klingon' WHEN 4 THEN 'GERMAN' END AS language_procedure,
  CASE o_custkey % 8 WHEN 0 THEN 'Grand Chamber' WHEN 1 THEN 'Première chambre' WHEN 2 THEN 'Full Court'
       WHEN 3 THEN 'Tenth Chamber' WHEN 4 THEN 'Second Chamber; extended' WHEN 5 THEN '' WHEN 6 THEN 'Single judge' END AS formation,
  concat({celex_sql('(o_custkey + 1)', "'F'", _YEAR)}, ';; http://res.example/cellar/', CAST(o_custkey % 50 AS STRING),
         '; ', {celex_sql('(o_custkey + 2)', 'o_orderstatus', _YEAR)}, ';', {celex_sql('(o_custkey + 1)', "'F'", _YEAR)}) AS cites,
  repeat('x; ', CAST(o_custkey % 5 AS INT)) AS cited_by,
  CASE o_custkey % 4 WHEN 0 THEN 'Reference for a preliminary ruling; Costs' WHEN 1 THEN 'Appeal - successful'
       WHEN 2 THEN 'Appeal - unfounded' END AS type_procedure,
  concat('Judge ', CAST(o_custkey % 97 AS STRING), '; Judge ', CAST(o_custkey % 89 AS STRING)) AS judges,
  concat('Agent ', CAST(o_custkey % 53 AS STRING)) AS agents,
  concat('Country ', CAST(o_custkey % 25 AS STRING)) AS origin_country,
  o_totalprice AS price
FROM {{orders}}
""",
    # raw window rows: the same ECLI returns in several windows, some rows lack an ECLI
    "fx_case_rows": f"""
SELECT o_orderkey AS position,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
       ELSE concat('ECLI:EU:C:', {_YEAR}, ':', CAST(o_custkey AS STRING)) END AS ecli,
  {celex_sql('o_custkey', 'o_orderstatus', _YEAR)} AS celex,
  CASE o_orderstatus WHEN 'F' THEN 'InfoCuria' WHEN 'O' THEN 'CELLAR' END AS metadata_catalog_source,
  CASE WHEN o_custkey % 3 = 0 THEN 'infocuria' ELSE 'cellar' END AS identity_source,
  CASE WHEN o_orderpriority = '1-URGENT' THEN ' ' ELSE substring(CAST({_ODATE} AS STRING), 1, 7) END AS source_window,
  CASE o_custkey % 3 WHEN 0 THEN 'EN' WHEN 1 THEN 'FR' ELSE 'DE' END AS text_language
FROM {{orders}}
""",
    # texts: five renditions per ECLI over four languages
    "fx_texts": f"""
SELECT doc_id AS text_id, CAST(floor(doc_id / 5) AS BIGINT) AS case_id,
  {ecli_sql('CAST(floor(doc_id / 5) AS BIGINT)')} AS ecli,
  lang AS language,
  CASE doc_id % 3 WHEN 0 THEN 'CELLAR_ITEM' WHEN 1 THEN 'INFOCURIA_BLOB_HTML' ELSE 'EXTRACTOR_FALLBACK_TEXT' END AS text_source,
  concat('6', CAST(1995 + CAST(floor(doc_id / 5) AS BIGINT) % 7 AS STRING), 'CJ',
         lpad(CAST(CAST(floor(doc_id / 5) AS BIGINT) % 10000 AS STRING), 4, '0'),
         CASE doc_id % 4 WHEN 0 THEN '_SUM' WHEN 1 THEN ';62000CJ0001' ELSE '' END) AS celex,
  CASE WHEN n_chars < 100 THEN '   ' ELSE text END AS text,
  n_chars, source AS source_window,
  CASE WHEN n_chars < 400 THEN 'too_short; no_html' WHEN n_chars < 900 THEN 'no_html' END AS missing_reasons
FROM {{documents}}
""",
    # stored texts whose bodies carry labels, other headings or another document's text
    "fx_stored_texts": f"""
SELECT doc_id AS text_id, CAST(floor(doc_id / 5) AS BIGINT) AS case_id,
  {ecli_sql('CAST(floor(doc_id / 5) AS BIGINT)')} AS ecli,
  lang AS language,
  CASE doc_id % 4 WHEN 0 THEN 'CELLAR_ITEM' WHEN 3 THEN 'RECHTSPRAAK' ELSE 'INFOCURIA_BLOB_HTML' END AS text_source,
  CASE doc_id % 9
    WHEN 0 THEN concat('61995CJ', lpad(CAST(CAST(floor(doc_id / 5) AS BIGINT) % 10000 AS STRING), 4, '0'), '_SUM_EN ', text)
    WHEN 1 THEN concat('JUDGMENT OF THE COURT 5 May 1997 ', text)
    WHEN 2 THEN concat('Judgment of the Court of ', CAST(doc_id % 28 + 1 AS STRING), ' May ', CAST(1995 + doc_id % 7 AS STRING), ' - X v Y ', text)
    WHEN 3 THEN concat('C-TRA-DOC-EN-ARRET_DR-0012 ', text)
    WHEN 4 THEN concat('61996CJ', lpad(CAST((CAST(floor(doc_id / 5) AS BIGINT) + 1) % 10000 AS STRING), 4, '0'), ' ', text)
    WHEN 5 THEN concat('61997CJ0003_INF ', text)
    ELSE text END AS text,
  CASE WHEN doc_id % 2 = 0 THEN concat('summary ', CAST(doc_id AS STRING)) END AS summary
FROM {{documents}}
""",
    # warehouse cases of the stored texts: number and date shared by neighbours
    "fx_stored_cases": f"""
SELECT o_orderkey AS case_id, {ecli_sql('o_orderkey')} AS ecli,
  concat('6', CAST(1995 + o_orderkey % 7 AS STRING), 'CJ', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'),
    CASE WHEN o_orderkey >= 10000 THEN concat('(', lpad(CAST(CAST(floor(o_orderkey / 10000) AS BIGINT) % 100 AS STRING), 2, '0'), ')') ELSE '' END,
    CASE WHEN o_orderpriority = '5-LOW' THEN '_SUM' ELSE '' END) AS celex_id,
  concat('C-', CAST(CAST(floor(o_orderkey / 3) AS BIGINT) AS STRING), '/95') AS case_number,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN
    CAST(concat(CAST(1995 + o_orderkey % 7 AS STRING), '-05-', lpad(CAST(o_orderkey % 28 + 1 AS STRING), 2, '0')) AS DATE) END AS date_decision,
  CASE o_orderstatus WHEN 'F' THEN 'judgment' WHEN 'O' THEN 'order' END AS doctype
FROM {{orders}}
""",
    # citation edges with repeats, self-loops and three unresolved states
    "fx_edges": f"""
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-',
    CAST(l_suppkey AS STRING), '-', CAST(CAST(l_shipdate AS DATE) AS STRING)) AS edge_id,
  l_orderkey AS source_case_id,
  CASE WHEN l_returnflag = 'N' AND l_linenumber < 6 THEN NULL
       WHEN l_linenumber = 7 THEN l_orderkey
       WHEN l_linenumber IN (5, 6) THEN l_orderkey + 1
       ELSE l_partkey * 8 + l_suppkey * 13 END AS target_case_id,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' AND l_linenumber < 6
       THEN {ecli_sql('(l_partkey * 8)')} END AS target_ecli_raw,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' AND l_linenumber < 6
       THEN {celex_sql('l_partkey', "'F'", "CAST(1995 + l_suppkey % 7 AS STRING)")} END AS target_celex_raw,
  CASE l_returnflag WHEN 'R' THEN 'cites' WHEN 'A' THEN 'appeal_of' ELSE 'joins' END AS relation_type,
  concat('ds_', l_linestatus) AS source_dataset,
  CAST(l_quantity AS INT) AS weight, CAST(l_shipdate AS DATE) AS seen_on
FROM {{lineitem}}
""",
    # the same rows as raw ECLI pairs, badly spaced and cased
    "fx_raw_edges": f"""
SELECT concat(' ', lower({ecli_sql('l_orderkey')})) AS source_ecli,
  concat({ecli_sql('(l_partkey * 8 + l_suppkey * 13)')}, ' ') AS target_ecli,
  CAST(l_orderkey AS STRING) AS source_item, CAST(l_partkey * 8 + l_suppkey * 13 AS STRING) AS target_item,
  CASE l_returnflag WHEN 'R' THEN 'cites' WHEN 'A' THEN 'appeal_of' END AS relation_type,
  CASE l_linenumber % 4 WHEN 0 THEN 'body-cite' WHEN 1 THEN 'legacy-ddb' WHEN 2 THEN 'formal-relation' ELSE 'other' END AS source,
  l_linenumber AS line_no, l_quantity AS weight
FROM {{lineitem}}
""",
    # Strasbourg documents: language variants of a case, shared application numbers
    "fx_echr_docs": f"""
SELECT item_id, g,
  CASE WHEN g % 5 = 0 THEN NULL ELSE
    concat('ECLI:CE:ECHR:', substring(CAST(d AS STRING), 1, 4), ':', replace(substring(CAST(d AS STRING), 6, 5), '-', ''),
           CASE g % 3 WHEN 0 THEN 'DEC' ELSE 'JUD' END,
           lpad(CAST(CAST(floor(h / 100) AS BIGINT) % 899999 + 1 AS STRING), 7, '0'), lpad(CAST(h % 100 AS STRING), 2, '0')) END AS ecli,
  CASE k % 2 WHEN 0 THEN 'ENG' ELSE 'FRE' END AS language_code,
  CASE WHEN g % 3 = 0 THEN CASE k % 2 WHEN 0 THEN 'HEDEC' ELSE 'HFDEC' END
       WHEN g % 11 = 0 THEN 'HECOM'
       ELSE CASE k % 2 WHEN 0 THEN 'HEJUD' ELSE 'HFJUD' END END AS doctype,
  CASE WHEN g % 7 = 0 THEN 'GRANDCHAMBER' ELSE 'CHAMBER' END AS doctype_branch,
  concat('CASE OF NAME', CAST(g AS STRING), ' v. STATE',
    CASE WHEN g % 13 = 0 THEN CASE k % 2 WHEN 0 THEN ' (JUST SATISFACTION)' ELSE ' (SATISFACTION ÉQUITABLE)' END
      WHEN g % 17 = 0 THEN CASE k % 2 WHEN 0 THEN ' (REVISION)' ELSE ' (RÉVISION)' END ELSE '' END) AS docname,
  CASE g % 4 WHEN 0 THEN 'Violation of Art. 6' WHEN 1 THEN 'Non-pecuniary damage - award' WHEN 2 THEN 'Struck out of the list' END AS conclusion,
  CASE WHEN g % 6 <> 0 THEN d END AS judgement_date, CASE WHEN g % 12 <> 0 THEN d END AS reference_date, d AS decided,
  {appno_sql('h')} AS appno,
  concat('STATE', CAST(g % 47 AS STRING), ';STATE', CAST(g % 41 AS STRING)) AS respondent,
  concat(CAST(g % 14 + 1 AS STRING), ';P', CAST(g % 7 + 1 AS STRING), '-', CAST(k % 5 + 1 AS STRING), ';', CAST(g % 14 + 1 AS STRING), '-1') AS article,
  CASE WHEN g % 4 = 0 THEN concat(CAST(g % 14 + 1 AS STRING), ';P1-1') END AS violation,
  CASE WHEN g % 4 = 1 THEN CAST(g % 9 + 1 AS STRING) END AS nonviolation
FROM (
  SELECT concat('001-', lpad(CAST(o_orderkey AS STRING), 12, '0')) AS item_id, o_orderkey AS k,
    CAST(floor(o_orderkey / 2) AS BIGINT) AS g, CAST(floor(o_orderkey / 6) AS BIGINT) AS h,
    {group_date_sql('CAST(floor(o_orderkey / 2) AS BIGINT)')} AS d
  FROM {{orders}}) x
""",
    # one citation string per line item; two entries when the line is even
    "fx_scl": f"""
SELECT l_orderkey AS source_case_id, l_linenumber AS line_no, CAST(l_suppkey AS BIGINT) AS tie,
  CAST(l_shipdate AS DATE) AS source_date,
  concat('Name', CAST(l_suppkey AS STRING), ' v. State', CASE WHEN l_linenumber % 3 = 0 THEN ' [GC]' ELSE '' END,
    CASE l_suppkey % 9 WHEN 0 THEN ' (dec.)' WHEN 1 THEN CASE WHEN l_linenumber % 2 = 0 THEN ' (just satisfaction)' ELSE ' (SATISFACTION ÉQUITABLE)' END ELSE '' END,
    ', no. 00', {appno_sql('l_partkey')}, ', § 70, ',
    CASE l_suppkey % 5
      WHEN 0 THEN concat(substring(CAST({group_date_sql('(l_partkey * 3 + l_suppkey % 3)')} AS STRING), 9, 2), '.',
                         substring(CAST({group_date_sql('(l_partkey * 3 + l_suppkey % 3)')} AS STRING), 6, 2), '.',
                         substring(CAST({group_date_sql('(l_partkey * 3 + l_suppkey % 3)')} AS STRING), 1, 4))
      WHEN 1 THEN concat(CAST(day({group_date_sql('(l_partkey * 3 + l_suppkey % 3)')}) AS STRING), ' ',
                         substring({_MONTHS3}, CAST(month({group_date_sql('(l_partkey * 3 + l_suppkey % 3)')}) * 3 - 2 AS INT), 3), ' ',
                         CAST(year({group_date_sql('(l_partkey * 3 + l_suppkey % 3)')}) AS STRING))
      WHEN 2 THEN concat('ECHR ', CAST(year({group_date_sql('(l_partkey * 3 + l_suppkey % 3)')}) AS STRING), '-VI')
      WHEN 3 THEN '31.02.1999'
      ELSE 'in fine' END,
    CASE WHEN l_linenumber % 2 = 0 THEN concat('; Other v. State, no. ', {appno_sql('(l_partkey + 1)')}) ELSE '' END) AS scl
FROM {{lineitem}}
""",
    # whole documents with citations written into the opening and the end
    "fx_cited_texts": f"""
SELECT doc_id AS case_id, lang AS language,
  concat('Zaak C‑', lpad(CAST(doc_id % 900 + 1 AS STRING), 4, '0'), '/', lpad(CAST(doc_id % 7 + 95 AS STRING), 2, '0'), ' en T-',
    CAST(doc_id % 500 + 3 AS STRING), '/96. ', text, ' EHRM ', {ecli_sql('doc_id')}, ' (application no. ', {appno_sql('CAST(floor(doc_id / 2) AS BIGINT)')},
    ') Richtlijn ', CAST(1970 + doc_id % 50 AS STRING), '/', CAST(doc_id % 97 + 1 AS STRING), '/EG, art. ', CAST(doc_id % 9 + 1 AS STRING),
    '; Kamerstukken II 2001/02, 28', lpad(CAST(doc_id % 1000 AS STRING), 3, '0'), ', nr. ', CAST(doc_id % 4 + 1 AS STRING), '.') AS text,
  CASE WHEN doc_id % 3 = 0 THEN concat('Zie C-', CAST(doc_id % 800 + 1 AS STRING), '/97') END AS summary,
  CASE doc_id % 3 WHEN 0 THEN 'RECHTSPRAAK' WHEN 1 THEN 'HUDOC' ELSE 'CELLAR_ITEM' END AS text_source
FROM {{documents}}
""",
    # law references in raw form
    "fx_law_refs": f"""
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-',
    CAST(l_suppkey AS STRING), '-', CAST(CAST(l_shipdate AS DATE) AS STRING)) AS ref_id,
  l_orderkey AS case_id,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE 'bwb' END AS raw_scheme,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('BWBR', lpad(CAST(l_partkey AS STRING), 9, '0')) END AS raw_resource,
  CASE WHEN l_linenumber IN (1, 2, 3) THEN CAST(l_linenumber AS STRING) WHEN l_linenumber = 4 THEN '' END AS raw_subdivision,
  CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS raw_label_id,
  CASE WHEN l_suppkey % 3 = 0 THEN concat('Wet ', CAST(l_partkey AS STRING)) WHEN l_suppkey % 3 = 1 THEN '' END AS raw_reference,
  CASE WHEN l_returnflag <> 'A' THEN CAST(l_shipdate AS DATE) END AS version_date,
  'cited' AS role, concat('rs_', CASE l_linestatus WHEN 'F' THEN 'lido_ref' ELSE 'lido_linkt' END) AS source_dataset,
  CASE WHEN l_returnflag = 'R' THEN l_partkey END AS provision_id,
  CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS legislation_id
FROM {{lineitem}}
""",
    # snapshot-versioned law catalogue: acts and their elements
    "fx_law_elements": """
SELECT p_partkey AS element_id,
  CASE WHEN p_partkey % 4 = 0 THEN 'wet' WHEN p_partkey % 4 = 1 THEN 'bijlage' ELSE 'artikel' END AS element_type,
  concat('BWBR', lpad(CAST(CAST(floor(p_partkey / 8) AS BIGINT) * 4 AS STRING), 9, '0')) AS bwb_id,
  CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE CAST(floor(p_partkey / 2) AS BIGINT) END AS lido_id,
  CAST(floor(p_partkey / 2) AS BIGINT) AS bwb_label_id,
  CAST(p_partkey % 3 + 1 AS STRING) AS number,
  CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END AS title,
  CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(DATE '2000-01-01' + CAST(p_size AS INT) AS DATE) END AS snapshot_date
FROM {part}
""",
    # person links and persons
    "fx_people": """
SELECT c_custkey AS person_id,
  CASE c_custkey % 6 WHEN 0 THEN concat('http://pub.example/resource/agent/JUDGE_', CAST(c_custkey AS STRING), '%20X')
    WHEN 1 THEN concat('Nam', CAST(c_custkey AS STRING), 'Nam', CAST(c_custkey AS STRING))
    WHEN 2 THEN 'Rossi'
    ELSE concat('Judge ', CAST(c_custkey % 700 AS STRING)) END AS full_name,
  CASE WHEN c_custkey % 5 = 0 THEN concat('Alias ', CAST(c_custkey AS STRING), ';;Judge ', CAST(c_custkey % 700 AS STRING)) END AS alias_cell,
  c_nationkey AS nation_id, c_mktsegment AS segment
FROM {customer}
""",
    "fx_person_links": """
SELECT o_orderkey AS case_id, o_custkey AS person_id,
  CASE o_orderstatus WHEN 'F' THEN 'judge' WHEN 'O' THEN 'rapporteur' ELSE 'advocate' END AS role,
  CASE o_orderkey % 3 WHEN 0 THEN 'CJEU' WHEN 1 THEN 'EGC' ELSE '' END AS court_code,
  CAST(o_orderdate AS DATE) AS date_decision,
  concat('ECLI:EU:', CASE o_orderkey % 2 WHEN 0 THEN 'C' ELSE 'T' END, ':', CAST(year(o_orderdate) AS STRING), ':', CAST(o_orderkey AS STRING)) AS ecli
FROM {orders}
""",
    # Dutch court decisions with docket numbers
    "fx_rs_docs": f"""
SELECT o_orderkey AS doc_id, concat(' ecli:nl:hr:', CAST(1995 + o_orderkey % 7 AS STRING), ':', CAST(o_orderkey AS STRING)) AS ecli_raw,
  concat('ECLI:NL:HR:', CAST(1995 + o_orderkey % 7 AS STRING), ':', CAST(o_orderkey AS STRING)) AS ecli,
  CAST(o_orderdate AS DATE) AS date_decision,
  CASE o_custkey % 5 WHEN 0 THEN 'Hoge Raad' WHEN 1 THEN 'Rechtbank Amsterdam' WHEN 2 THEN 'Gerechtshof Den Haag'
     WHEN 3 THEN 'Raad van State' ELSE 'Parket bij de Hoge Raad' END AS instance,
  concat('AWB ', CAST(o_orderkey % 100000 AS STRING), ' / ', CAST(o_custkey AS STRING)) AS zaaknummer,
  CASE o_orderstatus WHEN 'F' THEN 'Uitspraak' WHEN 'O' THEN 'Conclusie' ELSE 'Overig' END AS document_type,
  concat('Civiel recht;', CASE WHEN o_custkey % 2 = 0 THEN 'Belastingrecht' ELSE '' END) AS domains_cell,
  CASE WHEN o_orderpriority = '1-URGENT' THEN concat('LJN AB', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'))
       WHEN o_orderpriority = '2-HIGH' THEN {ecli_sql('o_orderkey')} END AS replaces_identifier,
  CASE WHEN o_orderpriority <> '5-LOW' THEN concat('Samenvatting ', CAST(o_orderkey AS STRING)) END AS summary,
  CASE o_orderstatus WHEN 'F' THEN 'Het beroep wordt verworpen.' WHEN 'O' THEN 'Vernietigt het arrest.' ELSE 'Verklaart het beroep gegrond.' END AS dictum
FROM {{orders}}
""",
    # referral mark-up of EU cases: one paragraph per national decision
    "fx_referrals": f"""
SELECT o_orderkey AS case_id,
  concat('<p>** AFFAIRE C-', CAST(o_orderkey % 900 AS STRING), '/95 **</p><p>*A', CAST(o_orderkey % 9 + 1 AS STRING), '* ',
    CASE o_custkey % 5 WHEN 0 THEN 'Hoge Raad' WHEN 1 THEN 'Rechtbank Amsterdam' WHEN 2 THEN 'Gerechtshof Den Haag'
      WHEN 3 THEN 'Raad van State' ELSE 'Hof van Cassatie Brussel' END, ', arrest van ',
    substring(CAST({_ODATE} AS STRING), 9, 2), '/', substring(CAST({_ODATE} AS STRING), 6, 2), '/', substring(CAST({_ODATE} AS STRING), 1, 4),
    CASE WHEN o_orderstatus = 'F' THEN concat(' (AWB ', CAST(o_orderkey % 100000 AS STRING), ' / ', CAST(o_custkey AS STRING), '; 12)') ELSE '' END,
    '</p>') AS national_judgement
FROM {{orders}}
""",
    # publications: journal notes on Dutch decisions
    "fx_publications": """
SELECT l_orderkey AS case_id, l_linenumber AS line_no,
  concat(CASE l_suppkey % 3 WHEN 0 THEN 'NJ' WHEN 1 THEN 'JB' ELSE 'www.rechtspraak.nl' END, ' ', CAST(1990 + l_suppkey % 30 AS STRING), '/', CAST(l_partkey AS STRING)) AS raw,
  CASE WHEN l_linenumber = 7 THEN 'self_published' ELSE 'journal' END AS kind,
  CASE l_suppkey % 4 WHEN 0 THEN 'N.J.' WHEN 1 THEN 'JB ' WHEN 2 THEN 'LJN' END AS journal_abbr,
  CAST(1990 + l_suppkey % 30 AS INT) AS year,
  CASE WHEN l_linenumber = 6 THEN 'p. 12 e.v.' ELSE concat('/', CAST(l_partkey AS STRING)) END AS locator,
  CASE l_linenumber WHEN 1 THEN 'prof. mr. J.  Jansen;' WHEN 2 THEN 'mr. P. Pieters' END AS annotator
FROM {lineitem}
""",
    # window events
    "fx_windows": """
SELECT event_id, CAST(ts AS DATE) AS seen_on, user_id, event_type,
  concat('w', CAST(user_id AS STRING)) AS window_id,
  CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending'
    WHEN 'view' THEN 'in_progress' ELSE 'exhausted' END AS status,
  CAST(event_id % 6 AS INT) AS attempts
FROM {events}
""",
}

_NAME = re.compile(r"\bfx_\w+")


def _needed(sql: str) -> list[str]:
    """Views used by a statement, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def oracle(sql: str) -> str:
    """Statement for the checking engine, with the views it uses as CTEs in front."""
    ctes = [f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES}).strip()})" for n in _needed(sql)]
    body, lead = sql.strip(), "WITH "
    if body.upper().startswith("WITH RECURSIVE"):
        lead, body = "WITH RECURSIVE ", body[len("WITH RECURSIVE"):].strip()
        ctes.append(body)
        return lead + ",\n".join(ctes)
    if body.upper().startswith("WITH "):
        ctes.append(body[5:].strip())
        return lead + ",\n".join(ctes)
    return (lead + ",\n".join(ctes) + "\n" if ctes else "") + body


class Inputs:
    """Lazy access to base tables (``t.orders``) and views (``t.cases`` -> ``fx_cases``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        view = f"fx_{name}"
        if view not in VIEWS:
            raise AttributeError(name)
        paths = {t: f"parquet.`{self.sf_dir}/{t}.parquet`" for t in TABLES}
        return self.spark.sql(VIEWS[view].format(**paths))
