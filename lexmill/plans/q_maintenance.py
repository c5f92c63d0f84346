"""Incremental maintenance queries."""

import uuid

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import maintenance as M
from ..operators.lineage import ensure_checkpoint_dir
from ..streaming import state as S
from .q_joins import RULES_SQL, era_rules
from .registry import query


@query("insert_absent", "M01", """
WITH n AS (SELECT source_case_id, target_case_id, relation_type, min(edge_id) AS edge_id FROM fx_edges WHERE target_case_id IS NOT NULL AND source_dataset = 'ds_F' GROUP BY 1, 2, 3)
SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM fx_edges o WHERE o.source_dataset = 'ds_O' AND o.source_case_id = n.source_case_id AND o.target_case_id = n.target_case_id AND o.relation_type = n.relation_type)""")
def _(t):
    new, old = t.edges.where("source_dataset = 'ds_F'"), t.edges.where("source_dataset = 'ds_O'")
    keys = ["source_case_id", "target_case_id", "relation_type"]
    return M.insert_absent(old, new, keys, [F.col("edge_id").asc()], "target_case_id IS NOT NULL").select(*keys, "edge_id")


_OLD_NEW = """o AS (SELECT text_id, ecli, language, text_source FROM fx_texts WHERE text_source <> 'CELLAR_ITEM'), n AS (SELECT text_id, ecli, upper(language) AS language, text_source FROM fx_stored_texts WHERE text_source <> 'RECHTSPRAAK')"""
_TEXT_COLS = ["text_id", "ecli", "language", "text_source"]


def _old_new(t):
    old = t.texts.where("text_source <> 'CELLAR_ITEM'").select(*_TEXT_COLS)
    new = t.stored_texts.where("text_source <> 'RECHTSPRAAK'").select(*_TEXT_COLS).withColumn("language", F.upper("language"))
    return old, new


@query("append_new_texts", "M02", f"""
WITH {_OLD_NEW} SELECT *, NULL AS note FROM o UNION ALL SELECT n.*, 'new' FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.ecli = n.ecli AND upper(o.language) = n.language)""")
def _(t):
    old, new = _old_new(t)
    return M.append_rows(old, new.withColumn("note", F.lit("new")))


@query("replace_texts", "M03", f"""
WITH {_OLD_NEW} SELECT 'table' AS part, o.* FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.ecli = o.ecli AND n.language = upper(o.language))
UNION ALL SELECT 'table', text_id, ecli, language, text_source FROM (SELECT *, row_number() OVER (PARTITION BY ecli, language ORDER BY text_id DESC) rn FROM n) x WHERE rn = 1
UNION ALL SELECT 'dropped', o.* FROM o WHERE EXISTS (SELECT 1 FROM n WHERE n.ecli = o.ecli AND n.language = upper(o.language))""")
def _(t):
    old, new = _old_new(t)
    table, dropped = M.replace_rows(old, new.withColumn("position", F.col("text_id")), "position")
    return table.withColumn("part", F.lit("table")).unionByName(dropped.withColumn("part", F.lit("dropped")))


@query("sync_texts_plan", "M04", """
WITH s AS (SELECT case_id, language, text_source, min(text_id) AS id, arg_min(md5(text), text_id) AS md5 FROM fx_stored_texts GROUP BY 1, 2, 3), i AS (SELECT text_id AS position, case_id, language, text_source, md5(text) AS md5 FROM fx_texts WHERE text_id IN (SELECT min(text_id) FROM fx_texts GROUP BY case_id, language)),
 j AS (SELECT i.*, a.id AS same_id, a.md5 AS same_md5, (SELECT min(b.id) FROM s b WHERE b.case_id = i.case_id AND b.language = i.language AND b.text_source NOT IN ('RECHTSPRAAK', i.text_source)) AS stale_id FROM i LEFT JOIN s a ON a.case_id = i.case_id AND a.language = i.language AND a.text_source = i.text_source)
SELECT case_id, language, position, CASE WHEN same_id IS NOT NULL THEN CASE WHEN same_md5 = md5 THEN 'unchanged' ELSE 'update' END WHEN stale_id IS NOT NULL THEN 'upgrade' ELSE 'insert' END AS action, coalesce(same_id, stale_id) AS target_id FROM j""")
def _(t):
    first = t.texts.groupBy("case_id", "language").agg(F.min("text_id").alias("text_id")).select("text_id")
    incoming = t.texts.join(first, "text_id", "left_semi").withColumn("position", F.col("text_id"))
    return M.sync_texts(t.stored_texts, incoming)


@query("fill_empty_columns", "M05", """
WITH o AS (SELECT doc_id AS case_id, CASE WHEN document_type = 'Conclusie' THEN '' ELSE summary END AS summary, instance FROM fx_rs_docs WHERE instance <> 'Hoge Raad'), n AS (SELECT case_id, identity_source AS summary, origin_country AS instance FROM fx_cases WHERE sector <> '6')
SELECT coalesce(o.case_id, n.case_id) AS case_id, CASE WHEN coalesce(o.summary, '') = '' THEN coalesce(n.summary, o.summary) ELSE o.summary END AS summary, coalesce(o.instance, n.instance) AS instance FROM o FULL JOIN n ON n.case_id = o.case_id""")
def _(t):
    old = t.rs_docs.where("instance <> 'Hoge Raad'").select(F.col("doc_id").alias("case_id"), F.when(F.col("document_type") == "Conclusie", "").otherwise(F.col("summary")).alias("summary"), "instance")
    new = t.cases.where("sector <> '6'").select("case_id", F.col("identity_source").alias("summary"), F.col("origin_country").alias("instance"))
    return M.fill_empty(old, new, ["case_id"], ["summary", "instance"])


@query("plan_new_cases", "M06", """
SELECT ecli, CASE WHEN sector = '6' THEN 'already' WHEN x.case_id IS NOT NULL THEN 'attach' ELSE 'new' END AS plan, x.case_id FROM fx_cases c LEFT JOIN (SELECT ecli, case_id FROM fx_stored_cases WHERE doctype = 'order' OR doctype = 'judgment') x USING (ecli)""")
def _(t):
    return M.plan_new(t.cases, t.cases.where("sector = '6'"), t.stored_cases.where("doctype IS NOT NULL"))


@query("maintain_sources", "M07", """
WITH s AS (SELECT DISTINCT source_case_id AS case_id, CASE relation_type WHEN 'cites' THEN 'CJEU' WHEN 'joins' THEN 'ECHR' ELSE 'RS' END AS c FROM fx_edges), n AS (SELECT case_id, list(c ORDER BY c) AS now FROM s GROUP BY 1),
 b AS (SELECT case_id, CASE sector WHEN '6' THEN ['RS', 'CJEU'] WHEN '8' THEN ['CJEU'] ELSE ['ECHR', 'RS'] END AS old, coalesce(now, []) AS now FROM fx_cases LEFT JOIN n USING (case_id))
SELECT case_id, array_to_string(list_concat(list_filter(old, lambda x: list_contains(now, x)), list_filter(now, lambda x: NOT list_contains(old, x))), ';') AS sources FROM b""")
def _(t):
    corpus = X.first_rule([(F.col("relation_type") == "cites", F.lit("CJEU")), (F.col("relation_type") == "joins", F.lit("ECHR"))], F.lit("RS"))
    satellites = t.edges.select(F.col("source_case_id").alias("case_id"), corpus.alias("corpus"))
    arr = lambda *v: F.array(*[F.lit(x) for x in v])
    sources = X.first_rule([(F.col("sector") == "6", arr("RS", "CJEU")), (F.col("sector") == "8", arr("CJEU"))], arr("ECHR", "RS"))
    out = M.maintain_sources(t.cases.select("case_id", sources.alias("sources")), satellites)
    return out.select("case_id", F.array_join("sources", ";").alias("sources"))


@query("apply_count_deltas", "M08", """
WITH c AS (SELECT case_id, sum(o) AS o, sum(i) AS i FROM (SELECT source_case_id AS case_id, 1 AS o, 0 AS i FROM fx_edges WHERE source_dataset = 'ds_O' UNION ALL SELECT target_case_id, 0, 1 FROM fx_edges WHERE source_dataset = 'ds_O' AND target_case_id IS NOT NULL) u GROUP BY 1),
 d AS (SELECT case_id, sum(o) AS o, sum(i) AS i FROM (SELECT source_case_id AS case_id, CASE relation_type WHEN 'joins' THEN -1 WHEN 'cites' THEN 1 ELSE 0 END AS o, 0 AS i FROM fx_edges UNION ALL SELECT target_case_id, 0, CASE relation_type WHEN 'cites' THEN 1 ELSE -1 END FROM fx_edges WHERE target_case_id IS NOT NULL UNION ALL SELECT weight, 0, 1 FROM fx_edges WHERE relation_type = 'appeal_of') u GROUP BY 1)
SELECT case_id, CAST(greatest(coalesce(c.o, 0) + coalesce(d.o, 0), 0) AS BIGINT) AS cites_count, CAST(greatest(coalesce(c.i, 0) + coalesce(d.i, 0), 0) AS BIGINT) AS cited_by_count FROM c FULL JOIN d USING (case_id)""")
def _(t):
    e = t.edges
    src, tgt, none = F.col("source_case_id"), F.col("target_case_id"), F.lit(None).cast("long")
    row = lambda df, a, b, c, d: df.select(a.alias("old_source"), b.alias("old_target"), c.alias("new_source"), d.alias("new_target"))
    changes = A.union_all([row(e.where("relation_type = 'joins'"), src, tgt, none, none), row(e.where("relation_type = 'cites'"), none, none, src, tgt),
                           row(e.where("relation_type = 'appeal_of'"), src, tgt, src, F.col("weight").cast("long"))])
    return M.apply_count_deltas(A.citation_counts(e.where("source_dataset = 'ds_O'")), changes)


@query("delete_cases", "M09", """
WITH d AS (SELECT case_id, CASE WHEN case_id % 5 > 0 THEN ecli END AS ecli, celex_id FROM fx_cases WHERE sector = '8')
SELECT edge_id, CASE WHEN d.case_id IS NULL THEN target_case_id END AS target_case_id, coalesce(target_ecli_raw, d.ecli) AS target_ecli_raw, coalesce(target_celex_raw, d.celex_id) AS target_celex_raw FROM fx_edges e LEFT JOIN d ON d.case_id = target_case_id WHERE source_case_id NOT IN (SELECT case_id FROM d)""")
def _(t):
    # some cases have no ECLI; their links fall back to the CELEX number
    cases = t.cases.withColumn("ecli", F.when(F.col("case_id") % 5 > 0, F.col("ecli")))
    after, _ = M.delete_cases(t.edges, cases, t.cases.where("sector = '8'").select("case_id"))
    return after.select("edge_id", "target_case_id", "target_ecli_raw", "target_celex_raw")


@query("delete_collisions", "M09", """
WITH c AS (SELECT case_id, ecli FROM fx_cases), d AS (SELECT case_id, ecli FROM fx_cases WHERE sector = '8'), f AS (SELECT DISTINCT source_case_id, relation_type, source_dataset, d.ecli FROM fx_edges JOIN d ON d.case_id = target_case_id WHERE source_case_id NOT IN (SELECT case_id FROM d)),
 o AS (SELECT source_case_id, relation_type, source_dataset, target_ecli_raw FROM fx_edges WHERE target_case_id IS NULL AND target_celex_raw IS NULL UNION ALL SELECT source_case_id, relation_type, source_dataset, c.ecli FROM fx_edges JOIN c ON c.case_id = target_case_id WHERE weight > 40)
SELECT source_case_id, relation_type, source_dataset, ecli AS target_ecli_raw FROM f WHERE EXISTS (SELECT 1 FROM o WHERE o.source_case_id = f.source_case_id AND o.relation_type = f.relation_type AND o.source_dataset = f.source_dataset AND o.target_ecli_raw = f.ecli)""")
def _(t):
    cases = t.cases.withColumn("celex_id", F.lit(None).cast("string"))
    named = t.cases.select(F.col("case_id").alias("target_case_id"), F.col("ecli").alias("named"))
    twins = t.edges.where("weight > 40").join(named, "target_case_id").withColumn("target_ecli_raw", F.col("named")).withColumn(
        "target_case_id", F.lit(None).cast("long")).drop("named")
    _, collisions = M.delete_cases(t.edges.unionByName(twins), cases, t.cases.where("sector = '8'").select("case_id"))
    return collisions.drop("target_celex_raw")


def _swap(t):
    staged = t.edges.where("target_case_id IS NOT NULL AND relation_type = 'cites'").withColumn("edge_id", F.concat(F.lit("v2-"), "edge_id"))
    sources = t.edges.where("relation_type = 'cites'").select("source_case_id").distinct()
    return M.swap_dataset(t.edges, staged, sources, "ds_F", "ds_F2")


@query("swap_dataset", "M10", """
WITH s AS (SELECT DISTINCT source_case_id FROM fx_edges WHERE relation_type = 'cites'), a AS (SELECT edge_id FROM fx_edges WHERE source_dataset = 'ds_F' AND source_case_id IN (SELECT source_case_id FROM s))
SELECT 'live' AS part, edge_id, source_dataset FROM fx_edges WHERE edge_id NOT IN (SELECT edge_id FROM a) UNION ALL SELECT 'archive', edge_id, 'ds_F' FROM a
UNION ALL SELECT 'live', concat('v2-', min(edge_id)), 'ds_F2' FROM fx_edges WHERE target_case_id IS NOT NULL AND relation_type = 'cites' GROUP BY source_case_id, target_case_id""")
def _(t):
    live, archive = _swap(t)
    part = lambda df, name: df.select(F.lit(name).alias("part"), "edge_id", "source_dataset")
    return part(live, "live").unionByName(part(archive, "archive"))


@query("rollback_swap", "M10", "SELECT edge_id, source_dataset, target_case_id FROM fx_edges")
def _(t):
    live, archive = _swap(t)
    return M.rollback_swap(live, archive, "ds_F2").select("edge_id", "source_dataset", "target_case_id")


_WORDS = """x AS (SELECT text_id, case_id, text_source, CASE language WHEN 'fr' THEN CASE WHEN text_id % 2 = 0 THEN 'french' ELSE 'fr' END WHEN 'en' THEN CASE WHEN text_id % 3 = 0 THEN 'english' ELSE 'en' END ELSE language END AS language, CASE WHEN language = 'fr' THEN NULL ELSE summary END AS s0, summary FROM fx_stored_texts)"""


@query("rekey_languages", "M11", f"""
WITH {_WORDS}, y AS (SELECT text_id, case_id, text_source, language, CASE WHEN language IN ('french', 'english') THEN summary ELSE s0 END AS summary, CASE language WHEN 'french' THEN 'fr' WHEN 'english' THEN 'en' END AS iso FROM x),
 c AS (SELECT case_id, text_source, iso AS language, arg_min(summary, text_id) AS carried FROM y WHERE iso IS NOT NULL AND summary IS NOT NULL GROUP BY 1, 2, 3), r AS (SELECT * FROM y WHERE iso IS NULL),
 m AS (SELECT * FROM (SELECT text_id, case_id, text_source, iso AS language, summary, row_number() OVER (PARTITION BY case_id, text_source, iso ORDER BY text_id) rn FROM y WHERE iso IS NOT NULL) z WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM r WHERE r.case_id = z.case_id AND r.text_source = z.text_source AND r.language = z.language))
SELECT text_id, u.case_id, u.language, coalesce(summary, carried) AS summary FROM (SELECT text_id, case_id, text_source, language, summary FROM r UNION ALL SELECT text_id, case_id, text_source, language, summary FROM m) u LEFT JOIN c ON c.case_id = u.case_id AND c.text_source = u.text_source AND c.language = u.language""")
def _(t):
    word = X.first_rule([
        ((F.col("language") == "fr") & (F.col("text_id") % 2 == 0), F.lit("french")),
        ((F.col("language") == "en") & (F.col("text_id") % 3 == 0), F.lit("english"))], F.col("language"))
    texts = t.stored_texts.select("text_id", "case_id", "text_source", word.alias("language"), "summary")
    texts = texts.withColumn("summary", F.when(F.col("language") != "fr", F.col("summary")))
    return M.rekey_language(texts).select("text_id", "case_id", "language", "summary")


_MERGED = """p AS (SELECT person_id, full_name, CASE WHEN full_name LIKE 'Judge %' THEN CASE WHEN CAST(substring(full_name, 7) AS INT) % 2 = 1 THEN concat('Judge ', CAST(CAST(substring(full_name, 7) AS INT) // 2 AS VARCHAR)) END END AS new_name, segment FROM fx_people),
 l AS (SELECT DISTINCT new_name FROM p WHERE new_name IS NOT NULL), held AS (SELECT full_name AS new_name, min(person_id) AS id FROM p WHERE new_name IS NULL GROUP BY 1), free AS (SELECT new_name, min(person_id) AS id FROM p WHERE new_name IS NOT NULL GROUP BY 1),
 n AS (SELECT p.*, coalesce(p.new_name, full_name) AS final_name, CASE WHEN p.new_name IS NULL THEN person_id ELSE coalesce(held.id, free.id) END AS keep_id FROM p LEFT JOIN held ON held.new_name = p.new_name LEFT JOIN free ON free.new_name = p.new_name),
 h AS (SELECT DISTINCT final_name, keep_id FROM n)"""


def _merge(t):
    number = F.substring("full_name", 7, 20).cast("int")
    judges = t.people.where("full_name LIKE 'Judge %'").select("full_name").distinct()
    merges = judges.where(number % 2 == 1).select(F.col("full_name").alias("old_name"), F.concat(F.lit("Judge "), F.floor(number / 2).cast("string")).alias("new_name"))
    people = t.people.select("person_id", "full_name", F.array("segment").alias("aliases"))
    return M.merge_people(people, t.person_links.select("case_id", "person_id", "role"), merges)


@query("merge_people", "M12", f"""WITH {_MERGED}, a AS (SELECT keep_id, final_name, segment AS a FROM n UNION SELECT keep_id, final_name, full_name FROM n WHERE new_name IS NOT NULL),
 g AS (SELECT keep_id, string_agg(DISTINCT a, '|' ORDER BY a) AS aliases FROM a WHERE a <> final_name GROUP BY 1)
SELECT keep_id AS person_id, final_name AS full_name, coalesce(aliases, '') AS aliases FROM h LEFT JOIN g USING (keep_id)""")
def _(t):
    people, _ = _merge(t)
    return people.select("person_id", "full_name", F.array_join("aliases", "|").alias("aliases"))


@query("merge_people_links", "M12", f"""WITH {_MERGED} SELECT DISTINCT case_id, keep_id AS person_id, role FROM fx_person_links JOIN n USING (person_id)""")
def _(t):
    return _merge(t)[1]


@query("split_homonyms", "M13", f"""
WITH l AS (SELECT case_id, person_id, role, full_name, court_code, ecli, CAST(year(date_decision) AS INT) AS y FROM fx_person_links JOIN fx_people USING (person_id)),
 h AS (SELECT case_id, person_id, role, min(target_name) AS target_name FROM l JOIN {RULES_SQL} ON full_name = source_name AND (court_code = rule_court OR (court_code = '' AND starts_with(ecli, ecli_prefix))) AND y BETWEEN min_year AND max_year GROUP BY 1, 2, 3 HAVING count(*) = 1)
SELECT case_id, person_id, role, coalesce(target_name, full_name) AS full_name, target_name IS NOT NULL AS moved FROM l LEFT JOIN h USING (case_id, person_id, role)""")
def _(t):
    links = t.person_links.join(t.people.select("person_id", "full_name"), "person_id")
    return M.split_homonyms(links, era_rules(t))


@query("fix_names", "M14", """
WITH r AS (SELECT case_id AS row_id, full_name AS name, ecli, CASE case_id % 4 WHEN 0 THEN 'OPINION OF MR RÍNO ROSSI delivered' WHEN 1 THEN 'Opinion of Lucia Rossi and Rino Rossi' WHEN 2 THEN 'Opinion of Lucia Rossi' ELSE NULL END AS header, CAST(year(date_decision) AS INT) AS y, case_id FROM fx_person_links JOIN fx_people USING (person_id)),
 x AS (SELECT *, CASE WHEN name LIKE 'Nam%' THEN left(name, CAST(length(name) / 2 AS INT)) END AS half, n.n_nationkey AS acc FROM r LEFT JOIN nation n ON name = concat('Judge ', CAST(n_nationkey AS VARCHAR))),
 z AS (SELECT x.*, m.n_nationkey AS half_acc FROM x LEFT JOIN nation m ON half = concat('Nam', CAST(m.n_nationkey AS VARCHAR)))
SELECT row_id, name, CASE WHEN acc IS NOT NULL THEN concat('Jüdge ', CAST(acc AS VARCHAR)) WHEN half IS NOT NULL THEN CASE WHEN half_acc IS NULL THEN half ELSE concat('Näm', CAST(half_acc AS VARCHAR)) END WHEN ecli LIKE 'ECLI:EU:C:1997:%' THEN 'Verified Rossi' WHEN case_id % 4 = 0 THEN 'Rino Rossi' WHEN case_id % 4 = 2 THEN 'Lucia Rossi' END AS target,
  CASE WHEN acc IS NOT NULL THEN 'diacritic' WHEN half IS NOT NULL THEN 'self_concatenation' WHEN ecli LIKE 'ECLI:EU:C:1997:%' OR case_id % 4 IN (0, 2) THEN 'two_person_fusion' ELSE 'unresolved_fusion' END AS category FROM z WHERE acc IS NOT NULL OR half IS NOT NULL OR name = 'Rossi'""")
def _(t):
    header = X.first_rule([(F.col("case_id") % 4 == 0, F.lit("OPINION OF MR RÍNO ROSSI delivered")), (F.col("case_id") % 4 == 1, F.lit("Opinion of Lucia Rossi and Rino Rossi")),
                           (F.col("case_id") % 4 == 2, F.lit("Opinion of Lucia Rossi"))])
    rows = t.person_links.join(t.people.select("person_id", "full_name"), "person_id").select(
        F.col("case_id").alias("row_id"), F.col("full_name").alias("name"), "ecli", header.alias("header"))
    key = F.col("n_nationkey").cast("string")
    pair = lambda a, b: t.nation.select(F.concat(F.lit(a), key).alias("wrong"), F.concat(F.lit(b), key).alias("right"))
    accents = pair("Judge ", "Jüdge ").unionByName(pair("Nam", "Näm"))
    fused = rows.where("name = 'Rossi'")
    verified = fused.where("ecli LIKE 'ECLI:EU:C:1997:%'").select(F.lit("Rossi").alias("fused"), "ecli", F.lit("Verified Rossi").alias("target")).distinct()
    candidates = fused.select(F.col("name").alias("fused"), F.explode(F.array(F.lit("Rino Rossi"), F.lit("Lucia Rossi"))).alias("candidate")).distinct()
    return M.fix_names(rows, accents, verified, candidates)


_URI = """u AS (SELECT person_id, CASE person_id % 5 WHEN 0 THEN concat('Judge ', CAST(person_id % 900 AS VARCHAR)) WHEN 1 THEN 'New  Person' WHEN 2 THEN concat('Rossi; Other ', CAST(person_id AS VARCHAR)) WHEN 3 THEN concat('Solo ', CAST(person_id AS VARCHAR)) END AS name FROM fx_people WHERE full_name LIKE 'http%'),
 held AS (SELECT lower(full_name) AS k, min(person_id) AS id FROM fx_people WHERE full_name NOT LIKE 'http%' GROUP BY 1), s AS (SELECT person_id, regexp_replace(name, ' +', ' ', 'g') AS name, lower(regexp_replace(name, ' +', ' ', 'g')) AS k FROM u WHERE name IS NOT NULL AND NOT contains(name, ';')),
 f AS (SELECT s.k, min(person_id) AS id FROM s WHERE k NOT IN (SELECT k FROM held) GROUP BY 1), d AS (SELECT person_id, coalesce(h.id, f.id) AS into_id, name FROM s LEFT JOIN held h ON h.k = s.k LEFT JOIN f ON f.k = s.k)"""


def _uri_people(t):
    number = F.col("person_id").cast("string")
    name = X.first_rule([
        (F.col("person_id") % 5 == 0, F.concat(F.lit("Judge "), (F.col("person_id") % 900).cast("string"))), (F.col("person_id") % 5 == 1, F.lit("New  Person")),
        (F.col("person_id") % 5 == 2, F.concat(F.lit("Rossi; Other "), number)), (F.col("person_id") % 5 == 3, F.concat(F.lit("Solo "), number))])
    names = t.people.where("full_name LIKE 'http%'").select(F.col("full_name").alias("uri"), name.alias("name")).where("name IS NOT NULL")
    return M.resolve_uri_people(t.people.select("person_id", "full_name"), t.person_links.select("case_id", "person_id", "role"), names)


@query("resolve_uri_people", "M15", f"""WITH {_URI}
SELECT person_id, CASE WHEN into_id = person_id THEN 'rename' ELSE 'merge' END AS action, into_id, name FROM d UNION ALL SELECT person_id, CASE WHEN name IS NULL THEN 'unresolved' ELSE 'split' END, NULL, coalesce(replace(name, '; ', ';'), '') FROM u WHERE name IS NULL OR contains(name, ';')""")
def _(t):
    return _uri_people(t)[0]


@query("resolve_uri_links", "M15", f"""WITH {_URI}, m AS (SELECT person_id, CAST(into_id AS VARCHAR) AS nk FROM d WHERE into_id <> person_id UNION ALL SELECT person_id, (SELECT CAST(id AS VARCHAR) FROM held WHERE k = 'rossi') FROM u WHERE contains(name, ';') UNION ALL SELECT person_id, concat('new:other ', CAST(person_id AS VARCHAR)) FROM u WHERE contains(name, ';'))
SELECT DISTINCT case_id, coalesce(nk, CAST(l.person_id AS VARCHAR)) AS person_key, role FROM fx_person_links l LEFT JOIN m ON m.person_id = l.person_id""")
def _(t):
    return _uri_people(t)[1]


@query("calendar_windows", "M16", """
WITH s AS (SELECT source_window AS w, min(date_decision) AS a, max(date_decision) + 40 AS b FROM fx_cases GROUP BY 1), m AS (SELECT w, a, b, CAST(unnest(generate_series(CAST(date_trunc('month', a) AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS c FROM s),
 q AS (SELECT w, a, b, CAST(unnest(generate_series(CAST(date_trunc('quarter', a) AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 3 MONTH)) AS DATE) AS c FROM s), y AS (SELECT w, a, b, CAST(unnest(generate_series(CAST(date_trunc('year', a) AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 YEAR)) AS DATE) AS c FROM s)
SELECT strftime(c, '%Y-%m') AS window_id, CAST(greatest(c, a) AS VARCHAR) AS sd, CAST(least(CAST(c + INTERVAL 1 MONTH AS DATE) - 1, b) AS VARCHAR) AS ed FROM m UNION ALL SELECT concat(strftime(c, '%Y'), '-Q', CAST(quarter(c) AS VARCHAR)), CAST(greatest(c, a) AS VARCHAR), CAST(least(CAST(c + INTERVAL 3 MONTH AS DATE) - 1, b) AS VARCHAR) FROM q
UNION ALL SELECT strftime(c, '%Y'), CAST(greatest(c, a) AS VARCHAR), CAST(least(CAST(c + INTERVAL 1 YEAR AS DATE) - 1, b) AS VARCHAR) FROM y""")
def _(t):
    spans = t.cases.groupBy("source_window").agg(F.min("date_decision").alias("start"), F.date_add(F.max("date_decision"), 40).alias("end"))
    out = A.union_all(M.windows(spans, kind) for kind in ("month", "quarter", "year"))
    return out.select("window_id", F.col("sd").cast("string").alias("sd"), F.col("ed").cast("string").alias("ed"))


@query("windows_to_process", "M17", """
WITH s AS (SELECT window_id, arg_max(status, event_id) AS status, arg_max(attempts, event_id) AS attempts FROM fx_windows GROUP BY 1), w AS (SELECT DISTINCT window_id FROM fx_windows UNION SELECT DISTINCT concat('w', CAST(user_id + 100 AS VARCHAR)) FROM fx_windows)
SELECT window_id, status, CAST(attempts AS BIGINT) AS attempts FROM w LEFT JOIN s USING (window_id) WHERE status IS NULL OR (status NOT IN ('completed', 'exhausted') AND NOT (attempts >= 3 AND status <> 'pending'))""")
def _(t):
    state = M.window_state(t.windows)
    wanted = t.windows.select("window_id").union(t.windows.select(F.concat(F.lit("w"), (F.col("user_id") + 100).cast("string"))))
    return M.windows_to_process(wanted, state, 3).withColumn("attempts", F.col("attempts").cast("long"))


@query("window_status_summary", "M18", """
WITH s AS (SELECT window_id, arg_max(status, event_id) AS status FROM fx_windows GROUP BY 1) SELECT v.status, count(s.window_id) AS n FROM (VALUES ('pending'), ('in_progress'), ('completed'), ('failed'), ('exhausted')) v(status) LEFT JOIN s ON s.status = v.status GROUP BY 1""")
def _(t):
    return M.status_summary(M.window_state(t.windows))


@query("fill_act_ids", "M19", """
WITH a AS (SELECT bwb_id, min(element_id) AS act_id FROM fx_law_elements GROUP BY 1), r AS (SELECT *, coalesce(raw_subdivision, '') AS sub FROM fx_law_refs),
 x AS (SELECT r.*, a.act_id, EXISTS (SELECT 1 FROM r t WHERE (t.legislation_id IS NOT NULL OR t.provision_id IS NOT NULL) AND t.case_id = r.case_id AND t.raw_scheme = r.raw_scheme AND t.raw_resource = r.raw_resource AND t.sub = r.sub AND t.source_dataset = r.source_dataset) AS twin FROM r LEFT JOIN a ON a.bwb_id = raw_resource)
SELECT ref_id, coalesce(legislation_id, CASE WHEN NOT twin THEN act_id END) AS legislation_id, legislation_id IS NULL AND NOT twin AND act_id IS NOT NULL AS filled FROM x""")
def _(t):
    acts = t.law_elements.select(F.col("bwb_id").alias("identifier"), F.col("element_id").alias("act_id"))
    return M.fill_act_ids(t.law_refs, acts)


def _stream(t, parts, job):
    """Each part is a batch of files that arrives at the stream ``job``; all rows it wrote."""
    ensure_checkpoint_dir(t.spark)
    folder = f"{t.spark.sparkContext.getCheckpointDir().rstrip('/')}/stream-{uuid.uuid4().hex}"
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(part.schema).parquet(f"{folder}/in")
        S.run_to_end(job(stream), f"{folder}/table", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/table")


@query("stream_first_texts", "M02", """
WITH b AS (SELECT text_id, ecli, upper(language) AS language, text_source, CASE text_source WHEN 'CELLAR_ITEM' THEN 1 ELSE 2 END AS batch FROM fx_texts WHERE ecli IS NOT NULL)
SELECT text_id, ecli, language, text_source FROM (SELECT *, row_number() OVER (PARTITION BY ecli, language ORDER BY batch, text_id) AS rn FROM b) x WHERE rn = 1""")
def _(t):
    rows = t.texts.select("text_id", "ecli", F.upper("language").alias("language"), "text_source")
    first = F.col("text_source") == "CELLAR_ITEM"
    return _stream(t, [rows.where(first), rows.where(~first)], lambda s: S.first_rows(s, ["ecli", "language"], "text_id")).drop("version")


@query("stream_citation_counts", "M08", """
WITH d AS (SELECT source_case_id AS case_id, 1 AS o, 0 AS i FROM fx_edges WHERE relation_type = 'cites' UNION ALL SELECT target_case_id, 0, 1 FROM fx_edges WHERE relation_type = 'cites'
  UNION ALL SELECT source_case_id, -1, 0 FROM fx_edges WHERE relation_type <> 'cites' UNION ALL SELECT target_case_id, 0, -1 FROM fx_edges WHERE relation_type <> 'cites' UNION ALL SELECT CAST(weight AS BIGINT), 0, 1 FROM fx_edges WHERE relation_type = 'appeal_of')
SELECT case_id, CAST(greatest(sum(o), 0) AS BIGINT) AS cites_count, CAST(greatest(sum(i), 0) AS BIGINT) AS cited_by_count FROM d WHERE case_id IS NOT NULL GROUP BY 1""")
def _(t):
    none = F.lit(None).cast("long")
    row = lambda df, *c: df.select(*[x.cast("long").alias(n) for x, n in zip(c, ("old_source", "old_target", "new_source", "new_target"))])
    e, src, tgt = t.edges, F.col("source_case_id"), F.col("target_case_id")
    cites = row(e.where("relation_type = 'cites'"), none, none, src, tgt)
    later = row(e.where("relation_type <> 'cites'"), src, tgt, none, F.when(F.col("relation_type") == "appeal_of", F.col("weight")))
    return S.newest(_stream(t, [cites, later], S.running_counts), "case_id")


@query("stream_window_states", "M18", "SELECT window_id, arg_max(status, event_id) AS status, max(event_id) AS event_id FROM fx_windows WHERE window_id IS NOT NULL GROUP BY 1")
def _(t):
    events = t.windows.select("window_id", "status", F.col("event_id").cast("long").alias("event_id"))
    late = F.col("event_id") > events.agg(F.avg("event_id")).first()[0]
    return S.newest(_stream(t, [events.where(late), events.where(~late)], S.newest_states), "window_id")
