"""Incremental jobs as Structured Streaming queries (file source, AvailableNow).

The stream checkpoint takes the place of a window manifest: a file is processed once, a crashed
batch is repeated. Every batch writes one folder under the table path and looks at earlier folders
only, so a repeated batch gives the same result. Appended tables are all folders together, each
with the rows of one batch; tables of running totals are the newest folder, and older ones go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.maintenance import apply_count_deltas, new_rows
from ..sources.writers import write_checked


def versioned(table: str, batch_id: int) -> str:
    return f"{table.rstrip('/')}/v={batch_id:012d}"


def _folders(spark: SparkSession, table: str, before: int | None = None) -> list[str]:
    """Complete batch folders of a table in order, optionally older than a batch."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(table)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []
    return [f"{table.rstrip('/')}/{n}" for n in names if n.startswith("v=") and "." not in n and (before is None or int(n[2:]) < before)]


def latest(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """The newest folder of a table of running totals, optionally older than a batch."""
    folders = _folders(spark, table, before)
    return spark.read.parquet(folders[-1]) if folders else None


def appended(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """All rows of an appended table, optionally older than a batch."""
    folders = _folders(spark, table, before)
    return spark.read.option("mergeSchema", True).parquet(*folders) if folders else None


def _drop(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_window_files(spark: SparkSession, source: str, schema: str, table: str, checkpoint: str) -> StreamingQuery:
    """New window files (JSON lines of texts) are appended by (ECLI, language)."""

    def step(batch: DataFrame, batch_id: int) -> None:
        old = appended(batch.sparkSession, table, before=batch_id)
        write_checked(batch if old is None else new_rows(old, batch), versioned(table, batch_id))

    return _run(spark.readStream.schema(schema).json(source), step, checkpoint)


CHANGES = "old_source long, old_target long, new_source long, new_target long"
COUNTS = "case_id long, cites_count long, cited_by_count long"


def maintain_counts(spark: SparkSession, source: str, table: str, checkpoint: str) -> StreamingQuery:
    """Edge changes (JSON lines) are applied to the citation counts as signed deltas."""

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        old = latest(session, table, before=batch_id)
        counts = old if old is not None else session.createDataFrame([], COUNTS)
        write_checked(apply_count_deltas(counts, batch), versioned(table, batch_id))
        # a repeated batch needs the folder before it; nothing needs older ones
        _drop(session, _folders(session, table, before=batch_id)[:-1])

    return _run(spark.readStream.schema(CHANGES).json(source), step, checkpoint)
