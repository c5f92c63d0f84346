"""Writers: viewer-friendly parquet with an atomic publish, checked writes, archives."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CASES_PER_GROUP = 2_000
TEXTS_PER_GROUP = 500


class RowCountError(RuntimeError):
    """The rows written are not the rows planned; nothing was published."""


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm.org.apache.hadoop.fs.Path


def _publish(spark: SparkSession, staging: str, path: str) -> None:
    """Swap the staged folder in: the old one steps aside first and comes back if the rename fails."""
    fs, to_path = _filesystem(spark, path)
    live, staged, aside = to_path(path), to_path(staging), to_path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
    had_old = fs.exists(live)
    if had_old and not fs.rename(live, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(staged, live):
        if had_old:
            fs.rename(aside, live)
        raise OSError(f"cannot publish {path}")
    if had_old:
        fs.delete(aside, True)


def write_checked(df: DataFrame, path: str, expected: int | None = None, rows_per_group: int = TEXTS_PER_GROUP, rows_per_file: int = 500_000) -> int:
    """Write small zstd row groups to a staging folder, compare the row count, then publish.

    The count is observed during the write, so the data is read once.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    (counted.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
     .option("parquet.block.row.count.limit", rows_per_group).parquet(staging))
    written = int(seen.get["rows"])
    if expected is not None and written != expected:
        fs, to_path = _filesystem(spark, staging)
        fs.delete(to_path(staging), True)
        raise RowCountError(f"expected {expected} rows, wrote {written}")
    _publish(spark, staging, path)
    return written


def write_corpus(df: DataFrame, path: str, rows_per_group: int = TEXTS_PER_GROUP) -> int:
    """Corpus table as viewer-friendly parquet, published in one step."""
    return write_checked(df, path, None, rows_per_group)


def write_links(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def archive_rows(df: DataFrame, path: str) -> None:
    """Rows about to change, as gzipped JSON lines; an existing archive is never overwritten."""
    df.write.mode("errorifexists").option("compression", "gzip").json(path)
