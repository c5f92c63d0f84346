"""Window CSV files as a Python data source whose splits are byte ranges.

A reader that takes quoted line breaks can't split a file blindly: whether a line break ends a record
depends on the quotes before it. ``index_windows`` therefore reads every range of every file once, in
parallel: it counts quotes and notes the first line break for both cases, that the range begins
inside or outside quotes. Sums of the counts per file then tell which case holds. The index has one
row per range and lies in the shared folder; the data source plans its splits from it, so a large
file is read by as many tasks as it has ranges, and headers are read where files begin.

Files are UTF-8 with or without byte order mark and quote as RFC 4180 says: a field that holds a quote,
comma or line break is quoted, quotes in it are doubled. Empty fields are null, quoted empty ones are
empty texts; records that are too short are filled with nulls, surplus fields and blank lines are left
out; files without a header give no rows. Of columns that repeat in a header, also in other case, the
first counts. Compressed files can't be split and raise ``ValueError``: ``readers.read_window_csv`` reads them.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.lineage import cut
from .readers import STEM, WINDOW

#: bytes of a range
SPAN = 16 << 20
#: ranges that one task of the index reads
PER_TASK = 4
#: characters of rows handed on at once
BATCH = 4 << 20

RANGE = "file string, start long, length long, quotes long, outside long, inside long, header array<string>"


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _bytes(uri: str, start: int, end: int) -> bytes:
    system, path = _system(uri)
    with system.open_input_file(path) as f:
        return f.read_at(end - start, start)


def _records(data: bytes) -> Iterator[list[str | None]]:
    csv.field_size_limit(sys.maxsize)
    return csv.reader(io.TextIOWrapper(io.BytesIO(data), "utf-8", newline=""), quoting=csv.QUOTE_NOTNULL)


def _breaks(data: bytes) -> tuple[int, int | None, int | None]:
    """Quotes, and where the first record begins if the bytes begin outside or inside quotes."""
    raw = np.frombuffer(data, np.uint8)
    quotes, lines = np.flatnonzero(raw == ord('"')), np.flatnonzero(raw == ord("\n"))
    inside = np.searchsorted(quotes, lines) % 2
    outside, within = (lines[inside == case][:1] + 1 for case in (0, 1))
    return len(quotes), *(int(f[0]) if len(f) else None for f in (outside, within))


def _header(uri: str, length: int) -> list[str | None] | None:
    """The first record of a file; reads on while it is open."""
    size = 64 << 10
    while True:
        data = _bytes(uri, 0, min(size, length))
        end = _breaks(data)[1]
        if end is not None or size >= length:
            return next(_records(data[:end].removeprefix(b"\xef\xbb\xbf")), None)
        size *= 4


def _scan(span: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), *[pa.int64()] * 5, pa.list_(pa.string())]
        names = ["file", "start", "length", "quotes", "outside", "inside", "header"]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                data = _bytes(r["file"], r["start"], min(r["start"] + span, r["length"]))
                quotes, *first = _breaks(data)
                header = None
                if r["start"] == 0:
                    header = _header(r["file"], r["length"])
                rows.append((r["file"], r["start"], r["length"], quotes, *[None if f is None else r["start"] + f for f in first], header))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)

    return scan


def index_windows(spark: SparkSession, path: str, span: int = SPAN) -> DataFrame:
    """(file, header, begin, end): the records of each split begin in [begin, end); written to the shared folder."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length").where("length > 0")
    packed = files.where(F.lower("file").rlike(r"\.(gz|bz2|zst|xz|lz4|snappy|deflate|zip)$")).first()
    if packed:
        raise ValueError(f"compressed files can't be split: {packed.file}")
    ranges = files.select("file", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(span).cast("long"))).alias("start"))
    n = files.agg(F.sum(F.ceil(F.col("length") / span))).first()[0] or 0
    scanned = cut(ranges.repartition(max(1, -(-int(n) // PER_TASK))).mapInArrow(_scan(span), RANGE))
    before = F.coalesce(F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begin = F.when(F.col("start") == 0, F.lit(0)).otherwise(F.when(before % 2 == 0, F.col("outside")).otherwise(F.col("inside")))
    begun = scanned.withColumn("begin", begin).where("begin < length")
    header = scanned.where("start = 0 AND size(header) > 0").select("file", F.transform("header", lambda h: F.coalesce(h, F.lit(""))).alias("header"))
    end = F.coalesce(F.lead("begin").over(Window.partitionBy("file").orderBy("begin")), F.col("length"))
    return cut(begun.withColumn("end", end).select("file", "begin", "end").join(header, "file").select("file", "header", "begin", "end"))


@dataclass
class Split(InputPartition):
    file: str
    header: list[str]
    begin: int
    end: int


class WindowCsv(DataSource):
    """``spark.read.format("window_csv").option("index", folder)``: all columns of all headers as text, by name."""

    @classmethod
    def name(cls) -> str:
        return "window_csv"

    def _splits(self) -> list[Split]:
        system, path = _system(self.options["index"])
        table = pq.read_table(path, filesystem=system)
        return [Split(**r) for r in sorted(table.to_pylist(), key=lambda r: (r["file"], r["begin"]))]

    def schema(self) -> StructType:
        seen: dict[str, str] = {}
        for header in dict.fromkeys(tuple(s.header) for s in self._splits()):
            for name in header:
                seen.setdefault(name.lower(), name)
        text = [StructField(name, StringType()) for key, name in seen.items() if key not in (WINDOW, "position", "")]
        return StructType([*text, StructField(WINDOW, StringType()), StructField("position", LongType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return WindowCsvReader(schema, self._splits())


class WindowCsvReader(DataSourceReader):
    def __init__(self, schema: StructType, splits: list[Split]) -> None:
        self.names, self.splits = schema.names, splits

    def partitions(self) -> list[Split]:
        return self.splits

    def read(self, split: Split | None) -> Iterator[pa.RecordBatch]:
        """Rows of one split; ``position`` grows within a file and never repeats, as no record is shorter than a byte."""
        if split is None:  # Spark asks once where there are no splits
            return
        kinds = [pa.int64() if n == "position" else pa.string() for n in self.names]
        at: dict[str, int] = {}
        for i, name in enumerate(split.header):
            at.setdefault(name.lower(), i)
        places = [at.get(n.lower()) for n in self.names[:-2]]
        window = re.match(STEM, split.file.rsplit("/", 1)[-1]).group(1)
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], self.names)

        records = _records(_bytes(split.file, split.begin, split.end).removeprefix(b"\xef\xbb\xbf" if split.begin == 0 else b""))
        if split.begin == 0:
            next(records, None)
        for i, record in enumerate(r for r in records if r):
            rows.append((*[record[p] if p is not None and p < len(record) else None for p in places], window, split.begin + i))
            size += sum(len(v) for v in record if v)
            if size > BATCH or len(rows) >= 10000:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()


def read_window_splits(spark: SparkSession, path: str, span: int = SPAN) -> DataFrame:
    """Every window file through the data source, tagged with file stem and position; files without records give no rows."""
    spark.dataSource.register(WindowCsv)
    index = index_windows(spark, path, span)
    return spark.read.format(WindowCsv.name()).option("index", index._cut_path).load()
