"""Readers: window extracts with drifting columns, target lists, link records, remote tables."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids
from ..functions import text as X
from ..operators.joins import small_side
from ..operators.lineage import cut

WINDOW = "source_window"
STEM = r"^(.*?)(?:\.[^.]+)?$"


def window_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header line) per window file: one row a file, read where each file begins."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"))
    return lines.where("start = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))


def read_window_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every window file as text columns, tagged with the file stem and the position in it.

    Files are read per distinct header (one reader would apply the first header to all), and
    the groups are united by name; empty files disappear. Only the file list and headers reach
    the driver.
    """
    groups = window_headers(spark, path).where("header IS NOT NULL AND header <> ''").groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    frames = []
    for row in sorted(groups, key=lambda r: r.header):
        reader = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"')
        frame = reader.csv(sorted(row.files))
        columns = frame.columns
        frames.append(frame.select(
            *[F.col(f"`{c}`").cast("string").alias(c) for c in columns],
            F.regexp_extract("_metadata.file_name", STEM, 1).alias(WINDOW), F.monotonically_increasing_id().alias("position")))
    if not frames:
        return spark.createDataFrame([], f"{WINDOW} string, position long")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _list_items(data: str) -> Iterator[tuple[int, object]]:
    """(position, value) of every item of a JSON list; only one item is decoded at a time."""
    space = re.compile(r"[ \t\r\n]*")
    decoder = json.JSONDecoder(parse_constant=_refuse)
    skip = lambda i: space.match(data, i).end()
    at, position = skip(data.index("[") + 1), 0
    if data[at:at + 1] == "]":
        at += 1
    else:
        while True:
            value, at = decoder.raw_decode(data, at)
            yield position, value
            position, at = position + 1, skip(at)
            if data[at:at + 1] == "]":
                at += 1
                break
            if data[at:at + 1] != ",":
                raise ValueError("no comma between items")
            at = skip(at + 1)
    if skip(at) != len(data):
        raise ValueError("text after the list")


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


def _decode_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of each file: strings as they are, lists and objects as JSON text with sorted keys, numbers and truth values apart; or one row with a reason."""
    names = ["window", "reason", "position", "texts", "others"]
    kinds = [pa.string(), pa.string(), pa.int64(), *[pa.map_(pa.string(), pa.string())] * 2]
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        rows.clear()
        return out

    for batch in batches:
        for i in range(batch.num_rows):
            window, reason, size = batch.column("window")[i].as_py(), None, 0
            try:
                data = batch.column("content")[i].as_py().decode("utf-8-sig")
                if not data.lstrip(" \t\r\n").startswith("["):
                    json.loads(data)
                    reason = "not a list"
                else:
                    for _ in _list_items(data):  # a broken file gives no rows at all
                        pass
            except ValueError:
                reason = "malformed"
            if reason:
                rows.append((window, reason, None, None, None))
                continue
            for position, item in _list_items(data):
                if isinstance(item, dict):
                    text = lambda v: json.dumps(v, ensure_ascii=False, sort_keys=True) if isinstance(v, (list, dict)) else v
                    plain = {k: text(v) for k, v in item.items()}
                    texts = [(k, v) for k, v in plain.items() if isinstance(v, str) or v is None]
                    others = [(k, json.dumps(v)) for k, v in plain.items() if not isinstance(v, str) and v is not None]
                    rows.append((window, None, position, texts, others))
                    size += sum(len(v or "") for _, v in texts)
                if size > _BATCH_CHARS or len(rows) > 5000:
                    yield flush()
                    size = 0
    if rows:
        yield flush()


#: characters of texts handed on at once
_BATCH_CHARS = 4 << 20


def read_window_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): each file is one list of objects; values become text, keys the columns.

    A file that is no list is rejected with a reason; list items that are no objects are
    skipped but keep their position. Objects are decoded one by one, so neither a file nor its
    list has a size limit but the two gigabytes of a binary cell, beyond which Spark raises.
    """
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("_metadata.file_name", STEM, 1).alias("window"), "content")
    items = cut(files.mapInArrow(_decode_windows, "window string, reason string, position long, texts map<string,string>, others map<string,string>"))
    rejects = items.where("reason IS NOT NULL").select(F.col("window").alias(WINDOW), "reason")
    rows = items.where("reason IS NULL")
    keys = sorted(r.key for r in rows.select(F.explode(F.array_union(F.map_keys("texts"), F.map_keys("others"))).alias("key")).distinct().collect())
    value = lambda k: F.coalesce(F.try_element_at("texts", F.lit(k)), X.to_text_scalar(F.try_parse_json(F.try_element_at("others", F.lit(k)))))
    return rows.select(*[value(k).alias(k) for k in ordered_columns(keys)], F.col("position").cast("int").alias("position"), F.col("window").alias(WINDOW)), rejects


def ordered_columns(columns: Sequence[str]) -> list[str]:
    """Familiar text columns first, the others by name."""
    first = ["celex", "ecli", "text", "text_source", "text_language", "text_format", "missing_reasons"]
    return [c for c in first if c in columns] + sorted(set(columns) - set(first))


def read_targets(spark: SparkSession, path: str, keys: DataFrame, languages: Sequence[str] = ("EN", "ENG", "ENGLISH")) -> DataFrame:
    """Corpus rows of the wanted ECLIs and languages.

    The stored spellings of the languages and of the ECLIs are looked up first, on those columns
    alone; both then reach the scan of the bodies as they are stored.
    """
    rows = spark.read.parquet(path)
    spellings = [r.language for r in rows.select("language").distinct().where(F.upper("language").isin(list(languages))).collect()]
    wanted = keys.select(ids.norm_ecli("ecli").alias("__key")).distinct()
    mine = F.col("language").isin(spellings)
    stored = rows.where(mine).select("ecli").distinct().withColumn("__key", ids.norm_ecli("ecli")).join(wanted, "__key", "left_semi").select("ecli")
    return rows.where(mine).join(small_side(stored), "ecli", "left_semi").select(*rows.columns)


def read_targets_tsv(spark: SparkSession, path: str, required: Sequence[str] = ("ecli", "celex")) -> DataFrame:
    """Tab-separated target list; required columns are checked before any row is used."""
    df = spark.read.option("header", True).option("sep", "\t").csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"target list lacks columns {missing}")
    return df.withColumns({"ecli": ids.norm_ecli("ecli"), "celex": F.upper(X.strip("celex"))})


def read_legacy(spark: SparkSession, url: str, table: str, predicate: str = "true", *, column: str | None = None,
                bounds: tuple[int, int, int] | None = None, fetch_size: int = 10_000, **options: str) -> DataFrame:
    """Remote relational table with a row predicate; a bounded key column splits the read.

    Needs a JDBC driver on the classpath and a reachable database; it is not exercised offline.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(fetch_size), **options)
    if column and bounds:
        low, high, parts = bounds
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load().where(predicate)


_KEY = T.StructType([T.StructField(n, T.StringType()) for n in ("ecli", "celex", "item_id")])
_MENTION = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("text_field", "language", "text_source")]
    + [T.StructField(n, T.LongType()) for n in ("char_start", "char_end")]
    + [T.StructField(n, T.StringType()) for n in ("raw_text", "context", "section", "segment_hash")])
LINK_SCHEMA = T.StructType(
    [T.StructField("source", _KEY), T.StructField("target", _KEY)]
    + [T.StructField(n, T.StringType()) for n in ("target_ref_raw", "target_ref_scheme", "relation_type", "source_dataset", "extractor_version", "match_method")]
    + [T.StructField("confidence", T.DoubleType()), T.StructField("mentions", T.ArrayType(_MENTION))])


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Link records from JSON lines with a fixed nested schema."""
    return spark.read.schema(LINK_SCHEMA).json(path)


def rows_from_arrays(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays to rows, one row per position."""
    return df.select(*keys, F.inline(F.arrays_zip(*columns)))


def rows_from_json(df: DataFrame, column: str, schema: str, keys: Sequence[str] = ()) -> DataFrame:
    """A JSON list of objects to rows."""
    return df.select(*keys, F.inline(F.from_json(column, f"array<struct<{schema}>>")))


