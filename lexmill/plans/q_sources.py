"""Source and sink queries: tables written by Spark to a fresh folder and read back."""

import uuid

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.lineage import ensure_checkpoint_dir
from ..operators.quality import expected_targets
from ..sources import readers as R
from ..sources import window_source as S
from ..sources import writers as Wr
from .registry import query


def fresh_folder(spark, name: str) -> str:
    """New folder inside the shared checkpoint folder (a private one in local sessions)."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"



_WINDOW_SQL = """
SELECT case_id, ecli, CASE WHEN sector = '6' THEN celex END AS celex, CASE WHEN sector <> '6' THEN subject_matter END AS subject FROM fx_cases"""


def _window_files(t) -> str:
    folder = fresh_folder(t.spark, "csv")
    cases = t.cases.select(F.col("case_id").cast("string").alias("case_id"), "ecli", "celex", F.col("subject_matter").alias("subject"), "sector")
    for name, part in (("a", cases.where("sector = '6'").drop("subject")), ("b", cases.where("sector <> '6'").drop("celex"))):
        part.drop("sector").write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")
    return f"{folder}/*"


@query("read_window_csv", "S01", _WINDOW_SQL)
def _(t):
    rows = R.read_window_csv(t.spark, _window_files(t))
    return rows.select(F.col("case_id").cast("long").alias("case_id"), "ecli", "celex", "subject")


@query("read_window_splits", "S01", _WINDOW_SQL)
def _(t):
    rows = S.read_window_splits(t.spark, _window_files(t), span=1 << 18)
    return rows.select(F.col("case_id").cast("long").alias("case_id"), "ecli", "celex", "subject")


def _json_lists(texts):
    """One list of objects per window and slice, as the extractor writes it; a window has a slice for each MB of its own bodies."""
    sizes = texts.groupBy(F.col("source_window").alias("w")).agg(F.sum(F.octet_length("text")).alias("size"))
    rows = texts.select("source_window", F.struct("ecli", "text_id", "text_source", "text", "n_chars").alias("r")).join(
        F.broadcast(sizes), F.col("source_window").eqNullSafe(F.col("w")))
    slices = F.greatest(F.floor(F.coalesce("size", F.lit(0)) / (1 << 20)), F.lit(1))
    return rows.groupBy("source_window", F.pmod(F.xxhash64("r.text_id"), slices).alias("slice")).agg(F.to_json(F.collect_list("r")).alias("value"))


@query("read_window_json", "S02", """
SELECT ecli, text_id, text_source, md5(text) AS body, n_chars FROM (SELECT ecli, CAST(text_id AS VARCHAR) AS text_id, text_source, text, CAST(n_chars AS VARCHAR) AS n_chars FROM fx_texts) x""")
def _(t):
    folder = fresh_folder(t.spark, "json")
    lists = _json_lists(t.texts)
    lists.select("value", F.concat_ws("-", "source_window", "slice").alias("w")).repartition("w").write.partitionBy("w").option("maxRecordsPerFile", 1).text(folder)
    found, _ = R.read_window_json(t.spark, f"{folder}/*")
    return found.select("ecli", "text_id", "text_source", F.md5(F.col("text").cast("binary")).alias("body"), "n_chars")


@query("write_corpus", "S03", "SELECT ecli, celex, subject_matter FROM fx_cases")
def _(t):
    path = fresh_folder(t.spark, "corpus")
    Wr.write_corpus(t.cases.select("ecli", "celex", "subject_matter"), path, Wr.CASES_PER_GROUP)
    return t.spark.read.parquet(path)


@query("write_checked", "S04", "SELECT text_id, ecli, text FROM fx_texts")
def _(t):
    path = fresh_folder(t.spark, "checked")
    texts = t.texts.select("text_id", "ecli", "text")
    Wr.write_checked(texts, path, expected=texts.count())
    return t.spark.read.parquet(path)


@query("json_scalars_to_text", "S05", """
SELECT event_id, concat('{"a": ', CAST(user_id AS VARCHAR), ', "k": ', regexp_extract(props, '(\\d+)', 1), '}') AS obj, concat('["', event_type, '", ', CAST(user_id AS VARCHAR), ']') AS arr, event_type AS str, CAST(user_id AS VARCHAR) AS num, CAST(NULL AS VARCHAR) AS nothing FROM events""")
def _(t):
    k = F.regexp_extract("props", r"(\d+)", 1)
    user = F.col("user_id").cast("string")
    quoted = F.concat(F.lit('"'), "event_type", F.lit('"'))
    v = lambda c: X.to_text_scalar(F.parse_json(c))
    return t.events.select(
        "event_id", v(F.concat(F.lit('{"k":'), k, F.lit(',"a":'), user, F.lit("}"))).alias("obj"),
        v(F.concat(F.lit("["), quoted, F.lit(","), user, F.lit("]"))).alias("arr"), v(quoted).alias("str"), v(user).alias("num"), v(F.lit("null")).alias("nothing"))


@query("read_targets", "S06", "SELECT text_id, ecli, length(text) AS length FROM fx_texts WHERE language = 'en' AND ecli IN (SELECT ecli FROM fx_cases WHERE sector = '6')")
def _(t):
    path = fresh_folder(t.spark, "texts")
    Wr.write_corpus(t.texts.select("text_id", "ecli", "language", "text"), path)
    rows = R.read_targets(t.spark, path, t.cases.where("sector = '6'"))
    return rows.select("text_id", "ecli", F.length("text").cast("long").alias("length"))


@query("read_targets_tsv", "S07", """
SELECT DISTINCT ecli, concat('6', CAST(1995 + case_id % 7 AS VARCHAR), 'CJ', lpad(CAST(case_id % 10000 AS VARCHAR), 4, '0')) AS celex FROM fx_texts""")
def _(t):
    path = fresh_folder(t.spark, "targets")
    expected_targets(t.texts).select(F.lower("ecli").alias("ecli"), "celex").write.option("header", True).option("sep", "\t").csv(path)
    return R.read_targets_tsv(t.spark, path)


@query("link_records", "S09", """
SELECT CAST(source_case_id AS VARCHAR) AS source, target_ecli_raw AS target, relation_type, source_dataset, CAST(weight AS BIGINT) AS char_start, edge_id AS raw_text FROM fx_edges""")
def _(t):
    path = fresh_folder(t.spark, "links")
    none = F.lit(None).cast("string")
    key = lambda ecli, item: F.struct(ecli.alias("ecli"), none.alias("celex"), item.alias("item_id"))
    records = t.edges.select(
        key(none, F.col("source_case_id").cast("string")).alias("source"), F.when(F.col("target_ecli_raw").isNotNull(), key(F.col("target_ecli_raw"), none)).alias("target"),
        "relation_type", "source_dataset", F.array(F.struct(F.col("weight").cast("long").alias("char_start"), F.col("edge_id").alias("raw_text"))).alias("mentions"))
    Wr.write_links(records, path)
    links = R.read_links(t.spark, path)
    return links.select(F.col("source.item_id").alias("source"), F.col("target.ecli").alias("target"), "relation_type", "source_dataset", F.explode("mentions").alias("m")).select(
        "source", "target", "relation_type", "source_dataset", "m.char_start", "m.raw_text")


@query("archive_rows", "S10", "SELECT edge_id, source_case_id, target_case_id FROM fx_edges WHERE source_dataset = 'ds_F'")
def _(t):
    path = fresh_folder(t.spark, "archive")
    Wr.archive_rows(t.edges.where("source_dataset = 'ds_F'"), path)
    return t.spark.read.schema("edge_id string, source_case_id long, target_case_id long").json(path)


@query("rows_from_arrays", "S11", """
SELECT vec_id, 'zip' AS how, CAST(generate_subscripts(embedding, 1) AS BIGINT) AS pos, round(unnest(embedding), 5) AS v FROM embeddings UNION ALL SELECT event_id, 'json', 1, CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) FROM events""")
def _(t):
    vectors = t.embeddings.select("vec_id", F.sequence(F.lit(1).cast("long"), F.size("embedding").cast("long")).alias("pos"), F.col("embedding").alias("v"))
    zipped = R.rows_from_arrays(vectors, ["pos", "v"], ["vec_id"])
    listed = t.events.select(F.col("event_id").alias("vec_id"), F.concat(F.lit("["), "props", F.lit("]")).alias("j"))
    parsed = R.rows_from_json(listed, "j", "k double", ["vec_id"])
    return zipped.select("vec_id", F.lit("zip").alias("how"), "pos", F.round(F.col("v").cast("double"), 5).alias("v")).unionByName(
        parsed.select("vec_id", F.lit("json").alias("how"), F.lit(1).cast("long").alias("pos"), F.col("k").alias("v")))
