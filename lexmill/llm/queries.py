"""The queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import automaton, decontaminate, hard_negatives, jaccard, lexical, lines, lm, mixing, near_dups, neighbours, quality, suffixes, tokens
from .common import fold, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, ceiling=2.0, keep=["doc_id"])
    return mixed.select("doc.doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokens.write_tokens(read(spark, sf_dir, "documents"), tokens.default_tokenizer(), end_id=0)
    return tokens.read_tokens(manifest)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: fixed value: white space of a line key
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL["op6_line_dedup"] = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS MATERIALIZED (
  SELECT rn, i, l[i] AS line, translate(trim(l[i], {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rn, l, unnest(range(1, len(l) + 1)) AS i FROM docs)),
gone AS MATERIALIZED (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rn) >= 10),
marked AS (SELECT rn, i, line, key IN (SELECT key FROM gone) AS drop_it FROM lines),
kept AS (SELECT rn, count(*) AS n_lines, count(*) FILTER (drop_it) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT drop_it), '') AS text FROM marked GROUP BY rn)
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM docs JOIN kept USING (rn)
"""


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    """Fitted on the labels of the documents outside the held-out fold."""
    labels = read(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    return quality.fit(docs, labels, "quality")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, sf_dir, docs), keep=["doc_id"])
    held_out = F.coalesce(fold(F.col("doc.doc_id").cast("string"), 3) == 1, F.lit(False))
    return scored.select("doc.doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_held_out(read(spark, sf_dir, "documents"), fold("doc_id", 5) == 1, order=3)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc.doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


@query
def op1_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10, factor=2.0)


SQL["op1_vantage_neighbours"] = """
WITH v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


@query
def op2_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = automaton.dedup_words(read(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL["op2_repeated_words"] = r"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT rn, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT rn, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
again AS MATERIALIZED (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS MATERIALIZED (SELECT rn, i FROM windows WHERE h IN (SELECT h FROM again)),
gone AS MATERIALIZED (SELECT DISTINCT rn, i + k AS i FROM hits, range(0, 35) r(k)),
words AS MATERIALIZED (SELECT rn, i, w[i] AS word FROM (SELECT rn, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
kept AS (SELECT words.rn, count(gone.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL), '') AS text
         FROM words LEFT JOIN gone ON words.rn = gone.rn AND words.i = gone.i GROUP BY words.rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (rn)
"""


@query
def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.dedup_bytes(read(spark, sf_dir, "documents"), window=400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=5, window=(80, 100), scale=256.0)


SQL["op11_hard_negatives"] = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
pos AS (SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM pairs WHERE same) p WHERE r <= 5),
neg AS (
  SELECT pos.a, pos.b AS p, n.b AS n, pos.score AS ps, n.score AS ns, row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY n.score DESC, n.b) AS r
  FROM pos JOIN pairs n ON n.a = pos.a AND NOT n.same AND 80 * pos.score <= 100 * n.score AND n.score <= pos.score)
SELECT a AS anchor_id, p AS positive_id, CAST(r AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM neg WHERE r <= 5
"""


@query
def op12_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(read(spark, sf_dir, "documents"), percent=80, n=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


SQL["op12_near_duplicates"] = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT rn, md5(array_to_string(w[i:i + 3], ' ')) AS s FROM (SELECT rn, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT rn, count(*) AS n, md5(string_agg(s, '' ORDER BY s)) AS digest FROM sets GROUP BY rn),
heads AS MATERIALIZED (SELECT min(rn) AS rn, digest, any_value(n) AS n FROM sizes GROUP BY digest),
own AS MATERIALIZED (SELECT s.rn, s.s FROM sets s JOIN heads USING (rn)),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.rn AS a, y.rn AS b, count(*) AS i FROM own x JOIN own y ON x.s = y.s AND x.rn <> y.rn GROUP BY 1, 2) p
  JOIN heads ha ON ha.rn = a JOIN heads hb ON hb.rn = b WHERE 100 * i >= 80 * (ha.n + hb.n - i)),
reach AS (SELECT rn AS a, rn AS b FROM heads UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
ids AS (SELECT h.rn AS head, min(d.doc_id) AS least FROM heads h JOIN sizes z USING (digest) JOIN docs d ON d.rn = z.rn GROUP BY 1),
named AS MATERIALIZED (SELECT reach.a AS head, min(least) AS component_id FROM reach JOIN ids ON ids.head = reach.b GROUP BY 1)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, CASE WHEN z.n IS NULL THEN d.doc_id ELSE c.component_id END AS component_id,
  d.doc_id IS NOT DISTINCT FROM (CASE WHEN z.n IS NULL THEN d.doc_id ELSE c.component_id END) AS kept
FROM docs d LEFT JOIN sizes z USING (rn) LEFT JOIN heads h USING (digest) LEFT JOIN named c ON c.head = h.rn
"""


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


SQL["op13_ranked_search"] = r"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
items AS (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
asked AS MATERIALIZED (SELECT item_id, text, t, count(*) AS c FROM (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM items) x GROUP BY 1, 2, 3),
facts AS MATERIALIZED (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM docs WHERE len(w) > 0),
tf AS MATERIALIZED (SELECT rn, t, count(*) AS tf FROM (SELECT rn, unnest(w) AS t FROM docs) x GROUP BY 1, 2),
w AS MATERIALIZED (SELECT t, CAST(floor(1000 * ln(CAST(2 * (SELECT n FROM facts) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY 1),
m AS MATERIALIZED (SELECT rn, doc_id, 100 - 75 + (75 * len(w) * n) // l AS m FROM docs, facts WHERE len(w) > 0),
scored AS (
  SELECT item_id, text, tf.rn, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (t) JOIN w USING (t) JOIN m ON m.rn = tf.rn GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
