"""Exact cosine search over vectors laid out by cell, with cells skipped by a bound.

Vectors are scaled to unit length and dealt to the cell of the nearest centre; centres come from a
bounded sample of the vectors. The cells are folders, and the index knows each one's farthest vector
from its centre. By the triangle inequality no vector of a cell is nearer to a query than the query's
distance from the centre less that radius. A search reads the cells that are nearest to its queries
until they hold ``k`` vectors, which gives every query a limit, and then exactly those cells whose bound
is within the limit of some query. The answer is exact; only how much is read depends on the data.

A cell is read in parts of bounded size, so one that holds a third of all rows is dealt to many tasks.

Vectors that are null, empty, zero, of another length than the sample's, or hold null or non-finite
components are left out. Ties go to the lower id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import top_per_key
from .lineage import cut, ensure_checkpoint_dir

#: vectors, and components, that centres come from at most; most cells, rounds of centring, vectors of a part
SAMPLE, NUMBERS, CELLS, ROUNDS, PART = 20_000, 4 << 20, 256, 8, 8_192
#: far above the rounding of a distance of unit vectors
BLUR = 1e-7


@dataclass
class VectorIndex:
    """``rows``: id, vector, cell, part; ``cells``: cell, n, parts, radius; ``centres``: one row for each cell."""

    rows: DataFrame
    cells: DataFrame
    centres: np.ndarray
    #: cells that searches read, step by step
    read: list[list[int]] = field(default_factory=list)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _usable(vector):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _unit(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) with vectors of length one; scaled by the largest component first, so no square overflows."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(F.col("id").isNotNull() & _usable(F.col("vector")))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column("vector")
                size = np.diff(column.offsets.to_numpy())
                first = np.cumsum(size) - size
                v = column.flatten().to_numpy(zero_copy_only=False)
                v = v / np.repeat(np.maximum.reduceat(np.abs(v), first), size)
                v /= np.repeat(np.sqrt(np.add.reduceat(v * v, first)), size)
                vectors = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(v))
                yield pa.RecordBatch.from_arrays([batch.column("id"), vectors], ["id", "vector"])

    return rows.mapInArrow(scale, f"id {rows.schema['id'].dataType.simpleString()}, vector array<double>")


def centre(points: np.ndarray, cells: int, seed: int = 6) -> np.ndarray:
    """Centres of the points: some of them far apart, then moved to the mean of those nearest to them."""
    rng = np.random.default_rng(seed)
    centres = points[[int(rng.integers(len(points)))]]
    away = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < cells and away.max() > BLUR:
        new = points[int(rng.choice(len(points), p=away / away.sum()))]
        centres = np.vstack([centres, new])
        away = np.minimum(away, ((points - new) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        nearest = np.argmax(points @ centres.T - (centres ** 2).sum(axis=1) / 2, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        count = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


def write_vectors(df: DataFrame, id_col: str, vector_col: str, path: str | None = None, cells: int | None = None, sample: int = SAMPLE) -> VectorIndex:
    """Lay the vectors out under ``path``, by default a new folder in the shared one."""
    spark = df.sparkSession
    if path is None:
        ensure_checkpoint_dir(spark)
        path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/vectors-{uuid.uuid4().hex}"
    rows = _unit(df, id_col, vector_col)
    total = rows.count()
    one = rows.select(F.size("vector").alias("size")).first()
    size = one.size if one else 0
    # which rows the bounded sample holds changes what is read, never the answer
    most = min(sample, NUMBERS // max(1, size))
    share = min(1.0, most / max(1, total))
    drawn = rows.where((F.size("vector") == size) & (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1_000_000)) < share * 1_000_000)).limit(2 * most)
    points = _matrix(drawn.select("vector").toArrow().column("vector").combine_chunks(), size) if one else np.zeros((0, size))
    if one and not len(points):
        points = np.array([rows.where(F.size("vector") == size).first().vector])
    centres = centre(points, cells or int(min(CELLS, max(1, len(points) ** 0.5)))) if len(points) else np.zeros((0, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("vector"), size)
            cell = np.argmax(v @ centres.T - (centres ** 2).sum(axis=1) / 2, axis=1)
            away = np.sqrt(((v - centres[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(cell.astype(np.int32)), pa.array(away)], ["id", "vector", "cell", "away"])

    kind = rows.schema["id"].dataType.simpleString()
    placed = cut(rows.where(F.size("vector") == size).mapInArrow(place, f"id {kind}, vector array<double>, cell int, away double"))
    facts = placed.groupBy("cell").agg(F.count("*").alias("n"), F.ceil(F.count("*") / PART).cast("int").alias("parts"), F.max("away").alias("radius"))
    facts.write.parquet(f"{path}/cells")
    facts = spark.read.parquet(f"{path}/cells")
    parted = placed.join(facts.select("cell", "parts"), "cell").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    parted.select("id", "vector", "cell", "part").repartition("cell", "part").write.partitionBy("cell").parquet(f"{path}/rows")
    return VectorIndex(spark.read.schema(f"id {kind}, vector array<double>, part int, cell int").parquet(f"{path}/rows"), facts, centres)


def search_vectors(index: VectorIndex, queries: DataFrame, k: int, id_col: str = "query_id", vector_col: str = "vector") -> DataFrame:
    """Rows (query_id, id, similarity): the ``k`` vectors of the greatest cosine for every query."""
    centres, size = index.centres, index.centres.shape[1]
    kinds = [queries.schema[id_col].dataType.simpleString(), index.rows.schema["id"].dataType.simpleString()]
    asked = cut(_unit(queries, id_col, vector_col).where(F.size("vector") == size))
    known = index.cells.collect()  # at most CELLS rows
    order = np.array([r.cell for r in known], np.int64)
    n, radius = np.array([r.n for r in known], np.int64), np.array([r.radius for r in known])

    def distances(v: np.ndarray) -> np.ndarray:
        c = centres[order]
        return np.sqrt(np.maximum((v ** 2).sum(axis=1)[:, None] + (c ** 2).sum(axis=1) - 2 * v @ c.T, 0))

    def chosen(limits: bool):
        """Rows (query_id, vector, cell): the nearest cells that hold ``k`` vectors; or the others within the limit."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                away = distances(_matrix(batch.column("vector"), size))
                near = np.argsort(away, axis=1, kind="stable")
                before = np.cumsum(n[near], axis=1) - n[near]
                first = np.zeros(away.shape, bool)
                np.put_along_axis(first, near, before < k, axis=1)
                if limits:  # cos >= s means a distance of at most sqrt(2 - 2 s)
                    limit = np.sqrt(np.maximum(2 - 2 * batch.column("limit").to_numpy(zero_copy_only=False), 0))
                    first = ~first & (away - radius - BLUR <= limit[:, None])
                row, cell = np.nonzero(first)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("vector").take(take), pa.array(order[cell].astype(np.int32))], ["query_id", "vector", "cell"])

        return run

    def compare(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        vectors, ids = np.array(theirs["vector"].tolist()).reshape(-1, size), theirs["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors, ids, names = vectors[order], ids[order], mine["query_id"].to_numpy()
        for a in range(0, len(mine), 256):
            block = mine.iloc[a:a + 256]
            if not len(ids):
                break
            scores = np.array(block["vector"].tolist()).reshape(-1, size) @ vectors.T
            limit = np.partition(scores, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
            row, column = np.nonzero(scores >= limit[:, None])  # all ties at the limit stay in the race
            score, turn = scores[row, column], np.lexsort((column, -scores[row, column], row))  # ids ascend by column
            row, column, score = row[turn], column[turn], score[turn]
            top = np.arange(len(row)) - np.searchsorted(row, row) < k
            out.append((names[a + row[top]], ids[column[top]], score[top]))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [[], [], []]
        return pd.DataFrame({name: pd.Series(c, dtype=object) for name, c in zip(("query_id", "id", "similarity"), columns)})

    def read(pairs: DataFrame) -> DataFrame:
        """The best of the cells that the pairs name, which alone are read."""
        pairs = cut(pairs)
        cells = [r.cell for r in pairs.select("cell").distinct().collect()]
        index.read.append(cells)
        rows = index.rows.where(F.col("cell").isin(cells)) if cells else index.rows.where("false")
        left = pairs.join(F.broadcast(index.cells.select("cell", "parts")), "cell")
        left = left.select("query_id", "vector", F.col("cell").alias("c"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"))
        near = left.groupBy("c", "p").cogroup(rows.groupBy("cell", "part")).applyInPandas(compare, f"query_id {kinds[0]}, id {kinds[1]}, similarity double")
        return cut(top_per_key(near, ["query_id"], [F.col("similarity").desc(), F.col("id").asc()], k))

    schema = f"query_id {kinds[0]}, vector array<double>, cell int"
    first = read(asked.mapInArrow(chosen(False), schema))
    limits = first.groupBy(F.col("query_id").alias("id")).agg(F.min("similarity").alias("limit"), F.count("*").alias("found"))
    limited = asked.join(limits, "id", "left").select("id", "vector", F.when(F.col("found") >= k, F.col("limit")).otherwise(F.lit(-1.0)).alias("limit"))
    second = read(limited.mapInArrow(chosen(True), schema))
    return top_per_key(first.unionByName(second), ["query_id"], [F.col("similarity").desc(), F.col("id").asc()], k)

