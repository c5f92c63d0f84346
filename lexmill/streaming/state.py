"""Streams with keyed state: seen keys, running counts, newest window state.

State lives in the state store of the stream, by key: a batch reads and writes the state of its own
keys only, however long the history is. Results are appended rows; a table of running values has a
new row for each key that a batch changes, with a version that rises, and ``newest`` keeps the last.

Running counts are sums of the engine's streaming aggregate, combined before the shuffle, and first rows are found by its
deduplication; the newest states call a small processor for each key, whose rows of a batch pass one task in bounded pieces,
never held together. Rows without a key are left out. A repeated batch starts from the state before it and its files are written once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Newest(StatefulProcessor):
    """The value of the highest order number by key."""

    def __init__(self, key: str, value: str, order: str):
        self.key, self.value, self.order = key, value, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", "value string, at long, version long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        value, at, version = self.state.get() if self.state.exists() else (None, None, 0)
        changed = False
        for frame in rows:
            last = frame.loc[frame[self.order].idxmax()]
            if at is None or int(last[self.order]) > at:
                value, at, changed = last[self.value], int(last[self.order]), True
        if changed:
            self.state.update((value, at, version + 1))
            yield pd.DataFrame({self.key: [key[0]], self.value: [value], self.order: [at], "version": [version + 1]})

    def close(self) -> None:
        pass


def _kind(df: DataFrame, column: str) -> str:
    return f"`{column}` {df.schema[column].dataType.simpleString()}"


def _stateful(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    present = stream.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return present.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "none")


def first_rows(stream: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows whose key no earlier batch had: one a key, the lowest by ``order`` in its batch.

    The engine's own deduplication holds the keys and lets those through that are new; ``run_to_end`` picks the lowest of
    their rows, which come along in the same batch. No key costs a call.
    """
    keys = list(keys)
    rows = stream.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    fresh = rows.select(*keys).dropDuplicates(keys).select(*keys, F.lit(None).cast(stream.schema).alias("row"))
    out = fresh.unionByName(rows.select(*keys, row.alias("row")))

    def lowest(batch: DataFrame) -> DataFrame:
        # rows without an order number come last; a row is null only where the key is announced as new
        first = F.min_by("row", F.when(F.col("row").isNotNull(), F.struct(F.col(f"row.`{order}`").isNull(), F.col(f"row.`{order}`"))))
        found = batch.groupBy(*keys).agg(F.max(F.col("row").isNull()).alias("__new"), first.alias("__row"))
        columns = [c for c in stream.columns if c not in keys or c == order]
        return found.where("__new").select(*[F.col(f"__row.`{c}`").alias(c) for c in [*columns, *[k for k in keys if k not in columns]]])

    out._each, out._mode = lowest, "append"
    return out


def running_counts(changes: DataFrame) -> DataFrame:
    """Rows (case_id, cites_count, cited_by_count, version) from edge changes (old_source, old_target, new_source, new_target).

    Sums never shown below zero. The engine's own streaming aggregate holds them, so no key costs a call; ``run_to_end``
    writes the keys that a batch touches, numbered by batch.
    """
    part = lambda c, out, back: F.struct(F.col(c).alias("case_id"), F.lit(out).cast("long").alias("cites"), F.lit(back).cast("long").alias("cited_by"))
    deltas = changes.select(F.inline(F.array(part("new_source", 1, 0), part("new_target", 0, 1), part("old_source", -1, 0), part("old_target", 0, -1))))
    shown = lambda c: F.greatest(F.sum(c), F.lit(0).cast("long")).alias(f"{c}_count")
    out = deltas.where("case_id IS NOT NULL").groupBy("case_id").agg(shown("cites"), shown("cited_by"))
    out._each, out._mode = lambda batch: batch, "update"
    return out


def newest_states(events: DataFrame, key: str = "window_id", value: str = "status", order: str = "event_id") -> DataFrame:
    """Rows (key, value, order, version): the newest value of every key that changed."""
    kinds = f"{_kind(events, key)}, `{value}` string, `{order}` long, version long"
    return _stateful(events.select(key, F.col(value).cast("string").alias(value), F.col(order).cast("long").alias(order)).where(F.col(order).isNotNull()), [key], Newest(key, value, order), kinds)


def newest(table: DataFrame, key: str) -> DataFrame:
    """The last row of every key of a table of running values."""
    rest = [c for c in table.columns if c not in (key, "version")]
    return table.groupBy(key).agg(F.max_by(F.struct(*rest), "version").alias("row")).select(key, "row.*")


def run_to_end(result: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Process all files that are there, append the rows to ``table``, and stop.

    What the engine's own state gives, the sums of the keys that a batch touches or the keys that it has first, goes to
    the folder of the batch, whose number is the version, and a repeated batch writes its folder anew.
    """
    spark: SparkSession = result.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    each = getattr(result, "_each", None)
    if each:
        step = lambda batch, number: each(batch).write.mode("overwrite").parquet(f"{table.rstrip('/')}/version={number}")
        writer = result.writeStream.foreachBatch(step).outputMode(result._mode)
    else:
        writer = result.writeStream.format("parquet").option("path", table).outputMode("append")
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
