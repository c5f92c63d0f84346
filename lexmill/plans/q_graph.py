"""Graph, index and vector queries."""

from pyspark.sql import functions as F

from ..operators import communities as M
from ..operators import graph as G
from ..operators import names as N
from ..operators import postings as P
from ..operators import vectors as V
from .q_columns import toks_sql
from .registry import query

_E = "e AS (SELECT DISTINCT source_case_id AS src, target_case_id AS dst FROM fx_edges WHERE target_case_id IS NOT NULL), n AS (SELECT src AS node FROM e UNION SELECT dst FROM e)"


@query("corpus_edges", "X01", f"""
SELECT celex_id AS source, tok AS target FROM (SELECT celex_id, unnest({toks_sql('cites')}) AS tok FROM fx_cases) x WHERE tok IN (SELECT celex_id FROM fx_cases)""")
def _(t):
    return G.build_edges(t.cases)


def _stop_sql(names, rounds, tolerance):
    """CTEs: ``stop``, the first round after which every table moved by less than the tolerance a node; ``<name>s``, the table of that round."""
    moved = lambda c, i: f"(SELECT sum(abs(coalesce(p.v, 0) - coalesce(q.v, 0))) FROM {c}{i} p FULL JOIN {c}{i - 1} q ON p.node = q.node)"
    changes = " UNION ALL ".join(f"SELECT {i} AS i, greatest({', '.join(moved(c, i) for c in names)}) AS change" for i in range(1, rounds + 1))
    sql = f", moves AS MATERIALIZED ({changes}), stop AS MATERIALIZED (SELECT min(i) AS i FROM moves WHERE change < (SELECT count(*) FROM n) * {tolerance})"
    for c in names:
        sql += f", {c}s AS (" + " UNION ALL ".join(f"SELECT node, v FROM {c}{i} WHERE (SELECT i FROM stop) = {i}" for i in range(1, rounds + 1)) + ")"
    return sql


def _pagerank_sql(rounds, tolerance):
    sql = f"WITH {_E}, d AS (SELECT src, 1.0 / count(*) AS share FROM e GROUP BY 1), k AS MATERIALIZED (SELECT count(*) AS n FROM n), r0 AS MATERIALIZED (SELECT node, CAST(1.0 AS DOUBLE) / k.n AS v FROM n, k)"
    for i in range(rounds):
        sql += (f", r{i + 1} AS MATERIALIZED (SELECT n.node, 0.15 / k.n + 0.85 * (coalesce(f.flow, 0) + l.lost / k.n) AS v FROM n CROSS JOIN k CROSS JOIN (SELECT coalesce(sum(v), 0) AS lost FROM r{i} WHERE node NOT IN (SELECT src FROM e)) l "
                f"LEFT JOIN (SELECT dst AS node, sum(v * CAST(share AS DOUBLE)) AS flow FROM e JOIN d USING (src) JOIN r{i} ON r{i}.node = e.src GROUP BY 1) f ON f.node = n.node)")
    return sql + _stop_sql(["r"], rounds, tolerance)


@query("pagerank", "X02", _pagerank_sql(25, 1e-6) + " SELECT node, round(v, 9) AS rank FROM rs")
def _(t):
    return G.pagerank(t.edges).withColumn("rank", F.round("rank", 9))


@query("pagerank_top", "X02", _pagerank_sql(25, 1e-6) + " SELECT node, round(v, 9) AS rank FROM rs ORDER BY v DESC, node LIMIT 10")
def _(t):
    return G.top_ranked(G.pagerank(t.edges)).withColumn("rank", F.round("rank", 9))


def _metrics_sql(rounds, tolerance):
    sql = f"WITH {_E}, h0 AS (SELECT node, CAST(1.0 AS DOUBLE) AS v FROM n), a0 AS (SELECT node, CAST(0.0 AS DOUBLE) AS v FROM n), g0 AS (SELECT node, CAST(1.0 AS DOUBLE) AS v FROM n)"
    for i in range(1, rounds + 1):
        sql += (f", ta{i} AS MATERIALIZED (SELECT dst AS node, sum(v) AS v FROM e JOIN h{i - 1} h ON h.node = src GROUP BY 1), a{i} AS MATERIALIZED (SELECT node, v / sqrt((SELECT sum(v * v) FROM ta{i})) AS v FROM ta{i})"
                f", th{i} AS MATERIALIZED (SELECT src AS node, sum(v) AS v FROM e JOIN a{i} a ON a.node = dst GROUP BY 1), h{i} AS MATERIALIZED (SELECT node, v / sqrt((SELECT sum(v * v) FROM th{i})) AS v FROM th{i})"
                f", tg{i} AS MATERIALIZED (SELECT g.node, g.v + coalesce(p.v, 0) AS v FROM g{i - 1} g LEFT JOIN (SELECT dst AS node, sum(v) AS v FROM e JOIN g{i - 1} x ON x.node = src GROUP BY 1) p ON p.node = g.node), g{i} AS MATERIALIZED (SELECT node, v / sqrt((SELECT sum(v * v) FROM tg{i})) AS v FROM tg{i})")
    return sql + _stop_sql(["h", "a", "g"], rounds, tolerance) + (
        " SELECT n.node, coalesce(i.c, 0) AS in_degree, coalesce(o.c, 0) AS out_degree, round(coalesce(h.v, 0), 7) AS hub, round(coalesce(a.v, 0), 7) AS authority, round(coalesce(g.v, 0), 7) AS eigen FROM n "
        "LEFT JOIN (SELECT dst, count(*) AS c FROM e GROUP BY 1) i ON i.dst = node LEFT JOIN (SELECT src, count(*) AS c FROM e GROUP BY 1) o ON o.src = node LEFT JOIN hs h ON h.node = n.node LEFT JOIN \"as\" a ON a.node = n.node LEFT JOIN gs g ON g.node = n.node")


@query("network_metrics", "X03", _metrics_sql(24, 1e-4).replace(", as AS (", ', "as" AS ('))
def _(t):
    out = G.network_metrics(t.edges, tolerance=1e-4)
    return out.withColumns({c: F.round(c, 7) for c in ("hub", "authority", "eigen")})


@query("network_size", "X03", f"WITH {_E} SELECT (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM n) AS nodes")
def _(t):
    return G.network_size(t.edges)


_INDEX = r"idx AS (SELECT token, text_id, language, count(*) AS frequency FROM (SELECT text_id, language, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS token FROM fx_texts) w GROUP BY 1, 2, 3)"


@query("inverted_index", "X04", f"WITH {_INDEX} SELECT token, text_id, language, frequency FROM idx")
def _(t):
    return P.frequencies(P.write_index(t.texts, ["text_id", "language"]))


@query("index_search", "X04", f"WITH {_INDEX} SELECT text_id, language, count(*) AS terms, CAST(sum(frequency) AS BIGINT) AS score FROM idx WHERE token IN ('der', 'und') GROUP BY 1, 2 HAVING count(*) = 2")
def _(t):
    index = P.write_index(t.texts, ["text_id", "language"])
    return P.search(index, P.ask(t.spark, q=("all", ["der", "und"]))).drop("query_id")


@query("phrase_search", "X04", r"""
WITH w AS (SELECT text_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM fx_texts),
 q AS (SELECT query_id, string_split(phrase, ' ') AS p FROM (VALUES ('de_la', 'de la'), ('of_the', 'of the'), ('four', 'the of and the'), ('twice', 'der der')) v(query_id, phrase)),
 h AS (SELECT query_id, text_id, w, p FROM w, q WHERE contains(concat(' ', array_to_string(w, ' '), ' '), concat(' ', array_to_string(p, ' '), ' ')))
SELECT query_id, text_id, CAST(len(list_distinct(p)) AS BIGINT) AS terms, CAST(len(list_filter(w, lambda x: list_contains(p, x))) AS BIGINT) AS score FROM h""")
def _(t):
    phrases = {"de_la": "de la", "of_the": "of the", "four": "the of and the", "twice": "der der"}
    return P.search(P.write_index(t.texts, ["text_id"]), P.ask(t.spark, **{n: ("phrase", p.split()) for n, p in phrases.items()}))


_TRI = r"list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substring(concat('  ', w, ' '), i, 3)))))"


@query("trigram_search", "X05", f"""
WITH p AS (SELECT p_partkey, p_name, {_TRI.format(c='p_name')} AS t FROM part), q AS (SELECT query, {_TRI.format(c='query')} AS g FROM (VALUES ('smal ring'), ('widgets-red')) v(query))
SELECT p_partkey, query, round(len(list_intersect(t, g)) / len(list_distinct(list_concat(t, g))), 6) AS similarity FROM p, q WHERE len(list_intersect(t, g)) / len(list_distinct(list_concat(t, g))) >= 0.3""")
def _(t):
    asked = t.spark.createDataFrame([("smal ring",), ("widgets-red",)], "query string")
    out = N.trigram_search(t.part.select("p_partkey", "p_name"), "p_name", asked)
    return out.select("p_partkey", "query", F.round("similarity", 6).alias("similarity"))


@query("trigram_search_table", "X05", f"""
WITH v AS (SELECT DISTINCT c_name AS value, {_TRI.format(c='c_name')} AS t FROM customer), q AS (SELECT DISTINCT concat('Customer ', s_name) AS query, {_TRI.format(c="concat('Customer ', s_name)")} AS g FROM supplier)
SELECT query, value, round(len(list_intersect(t, g)) / len(list_distinct(list_concat(t, g))), 6) AS similarity FROM v, q WHERE len(list_intersect(t, g)) / len(list_distinct(list_concat(t, g))) >= 0.55""")
def _(t):
    asked = t.supplier.select(F.concat(F.lit("Customer "), "s_name").alias("query"))
    out = N.search_names(N.write_names(t.customer, "c_name"), asked, 0.55)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("trigram_name_pairs", "X05", f"""
WITH a AS (SELECT c_custkey, c_name AS v, {_TRI.format(c='c_name')} AS t FROM customer), b AS (SELECT s_suppkey, replace(s_name, 'Supplier', 'Customer') AS v, {_TRI.format(c="replace(s_name, 'Supplier', 'Customer')")} AS g FROM supplier)
SELECT c_custkey, s_suppkey, round(len(list_intersect(t, g)) / len(list_distinct(list_concat(t, g))), 6) AS similarity FROM a, b WHERE len(list_intersect(t, g)) / len(list_distinct(list_concat(t, g))) >= 0.95""")
def _(t):
    left = t.customer.select("c_custkey", F.col("c_name").alias("v"))
    right = t.supplier.select("s_suppkey", F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("v"))
    out = G.trigram_pairs(left, right, "c_custkey", "s_suppkey", "v", 0.95)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("nearest_segments", "X06", """
WITH c AS (SELECT label, list(x ORDER BY i) AS vec FROM (SELECT label, i, avg(CAST(v AS DOUBLE)) AS x FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) u GROUP BY 1, 2) y GROUP BY 1),
 s AS (SELECT CAST(c.label AS BIGINT) AS query_id, vec_id AS segment_id, list_cosine_similarity(vec, CAST(embedding AS DOUBLE[])) AS sim FROM embeddings e, c)
SELECT query_id, segment_id, round(sim, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, segment_id) rn FROM s) r WHERE rn <= 5""")
def _(t):
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("x"))
    centroids = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vector"))
    queries = centroids.select(F.col("label").cast("long").alias("query_id"), "vector")
    index = V.write_vectors(t.embeddings, "vec_id", "embedding")
    return V.search_vectors(index, queries, 5).select("query_id", F.col("id").alias("segment_id"), F.round("similarity", 6).alias("similarity"))


@query("nearest_segments_scan", "X06", """
WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS segment_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim FROM embeddings a, embeddings b)
SELECT query_id, segment_id, round(sim, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, segment_id) rn FROM s) r WHERE rn <= 3""")
def _(t):
    segments = t.embeddings.select(F.col("vec_id").alias("segment_id"), "embedding")
    queries = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return G.nearest(segments, queries, 3).withColumn("similarity", F.round("similarity", 6))


def _components_sql(rounds):
    sql = f"WITH {_E}, b AS (SELECT src AS u, dst AS v FROM e UNION SELECT dst, src FROM e UNION SELECT node, node FROM n), l0 AS (SELECT node, node AS c FROM n)"
    for i in range(rounds):
        sql += f", l{i + 1} AS MATERIALIZED (SELECT u AS node, min(c) AS c FROM b JOIN l{i} ON l{i}.node = b.v GROUP BY 1)"
    return sql + f" SELECT node, c AS component FROM l{rounds}"


@query("clusters", "X07", _components_sql(14))
def _(t):
    return G.clusters(t.edges)


@query("cluster_sizes", "X07", _components_sql(14).replace("SELECT node, c AS component FROM l14", "SELECT c AS component, count(*) AS size FROM l14 GROUP BY 1"))
def _(t):
    return G.cluster_sizes(G.clusters(t.edges))


def _communities_sql(rounds, levels, seed):
    """Membership (m: node, community) after whole levels of so many rounds; a level that does not raise modularity ends it."""
    score = "SELECT (SELECT sum(w) FROM {0}) * coalesce((SELECT sum(w) FROM {0} WHERE a = b), 0) - (SELECT sum(CAST(s AS HUGEINT) * s) FROM (SELECT sum(w) AS s FROM {0} GROUP BY a) y) AS q"
    sql = (f"WITH {_E}, l0 AS MATERIALIZED (SELECT a, b, count(*) AS w FROM (SELECT src AS a, dst AS b FROM e UNION ALL SELECT dst, src FROM e) x GROUP BY 1, 2), "
           f"tot AS MATERIALIZED (SELECT CAST(sum(w) AS HUGEINT) AS t FROM l0), m0 AS MATERIALIZED (SELECT node, node AS c FROM n), q0 AS MATERIALIZED ({score.format('l0')})")
    for i in range(levels):
        sql += f", s{i}_0 AS MATERIALIZED (SELECT a, CAST(sum(w) AS HUGEINT) AS k, a AS c FROM l{i} GROUP BY a)"
        for r in range(rounds):
            s, turn = f"s{i}_{r}", f"(substring(md5(concat('{seed}|{i}|{r // 2}|', CAST(s.a AS VARCHAR))), 1, 1) < '8') = {r % 2 == 0}"
            sql += (f", z{i}_{r} AS MATERIALIZED (SELECT c, sum(k) AS s FROM {s} GROUP BY c)"
                    f", p{i}_{r} AS MATERIALIZED (SELECT l.a, x.c AS d, sum(w) AS w FROM l{i} l JOIN {s} x ON x.a = l.b WHERE l.a <> l.b GROUP BY 1, 2)"
                    f", o{i}_{r} AS MATERIALIZED (SELECT * FROM (SELECT p.a, p.d, t * w - k * z.s AS worth, row_number() OVER (PARTITION BY p.a ORDER BY t * w - k * z.s DESC, p.d) AS rn"
                    f" FROM p{i}_{r} p JOIN {s} s ON s.a = p.a AND s.c <> p.d JOIN z{i}_{r} z ON z.c = p.d CROSS JOIN tot) y WHERE rn = 1)"
                    f", s{i}_{r + 1} AS MATERIALIZED (SELECT s.a, s.k, CASE WHEN o.worth > coalesce(t * g.w, 0) - s.k * (z.s - s.k) AND {turn} THEN o.d ELSE s.c END AS c"
                    f" FROM {s} s JOIN z{i}_{r} z ON z.c = s.c CROSS JOIN tot LEFT JOIN o{i}_{r} o ON o.a = s.a LEFT JOIN p{i}_{r} g ON g.a = s.a AND g.d = s.c)")
        end = f"s{i}_{rounds}"
        sql += (f", l{i + 1} AS MATERIALIZED (SELECT x.c AS a, y.c AS b, sum(w) AS w FROM l{i} l JOIN {end} x ON x.a = l.a JOIN {end} y ON y.a = l.b GROUP BY 1, 2)"
                f", q{i + 1} AS MATERIALIZED ({score.format(f'l{i + 1}')}), m{i + 1} AS MATERIALIZED (SELECT node, x.c FROM m{i} JOIN {end} x ON x.a = m{i}.c)")
    rises = lambda i: " AND ".join(f"(SELECT q FROM q{j}) > (SELECT q FROM q{j - 1})" for j in range(1, i + 1))
    last = " UNION ALL ".join(
        f"SELECT node, c FROM m{i} WHERE {rises(i) or 'true'}" + (f" AND NOT coalesce((SELECT q FROM q{i + 1}) > (SELECT q FROM q{i}), false)" if i < levels else "")
        for i in range(levels + 1))
    return sql + f", ch AS MATERIALIZED ({last}), m AS MATERIALIZED (SELECT node, min(node) OVER (PARTITION BY c) AS community FROM ch)"


@query("communities", "X07", _communities_sql(6, 2, 7) + " SELECT node, community FROM m")
def _(t):
    return M.communities(t.edges, rounds=6, levels=2, seed=7)


@query("community_scores", "X07", _communities_sql(6, 2, 7) + """, lm AS (SELECT x.community, y.community AS other, w FROM l0 JOIN m x ON x.node = a JOIN m y ON y.node = b)
SELECT community, (SELECT count(*) FROM m WHERE m.community = lm.community) AS size, CAST(coalesce(sum(w) FILTER (community = other), 0) AS BIGINT) AS inner_weight, CAST(sum(w) AS BIGINT) AS degree,
 round(coalesce(sum(w) FILTER (community = other), 0) / (SELECT CAST(sum(w) AS DOUBLE) FROM l0) - (sum(w) / (SELECT CAST(sum(w) AS DOUBLE) FROM l0)) ** 2, 9) AS modularity FROM lm GROUP BY 1""")
def _(t):
    out = M.community_scores(t.edges, M.communities(t.edges, rounds=6, levels=2, seed=7))
    return out.withColumnRenamed("inner", "inner_weight").withColumn("modularity", F.round("modularity", 9))


@query("expand_neighbours", "X08", """
WITH l AS (SELECT * FROM fx_edges WHERE target_case_id IS NOT NULL AND source_dataset = 'ds_O' AND relation_type IN ('cites', 'joins')), r AS (SELECT DISTINCT case_id AS root FROM fx_texts)
SELECT DISTINCT root, target_case_id AS neighbour, relation_type, source_dataset, 'out' AS direction FROM l JOIN r ON root = source_case_id UNION SELECT DISTINCT root, source_case_id, relation_type, source_dataset, 'in' FROM l JOIN r ON root = target_case_id""")
def _(t):
    datasets = t.edges.select("source_dataset").distinct().withColumn("active", F.col("source_dataset") == "ds_O")
    return G.expand(t.edges, t.texts, datasets, "both", ["cites", "joins"])


@query("procedural_timeline", "X09", """
WITH RECURSIVE s AS (SELECT DISTINCT source_case_id AS a, target_case_id AS b FROM fx_edges WHERE target_case_id IS NOT NULL AND relation_type = 'appeal_of' AND source_case_id <> target_case_id),
 w AS (SELECT DISTINCT case_id AS root, case_id, 0 AS step FROM fx_texts UNION SELECT w.root, s.b, w.step + 1 FROM w JOIN s ON s.a = w.case_id WHERE w.step < 200)
SELECT root, w.case_id, CAST(min(step) AS BIGINT) AS step, CAST(c.date_decision AS VARCHAR) AS day FROM w LEFT JOIN fx_cases c ON c.case_id = w.case_id GROUP BY 1, 2, 4""")
def _(t):
    out = G.timeline(t.edges, t.cases, t.texts, ["appeal_of"])
    return out.select("root", "case_id", F.col("step").cast("long").alias("step"), F.col("date_decision").cast("string").alias("day"))


@query("citation_trend", "X10", "SELECT year(date_decision) AS year, count(*) AS citations, count(target_case_id) AS resolved FROM fx_edges JOIN fx_cases ON case_id = source_case_id GROUP BY 1")
def _(t):
    return G.citation_trend(t.edges, t.cases).withColumn("year", F.col("year").cast("long"))
