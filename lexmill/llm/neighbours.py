"""Approximate nearest neighbours: one vantage-point tree per shard.

Vectors are dealt to shards of bounded size by their id. A shard's task builds the tree: a vantage
point, the rest split at the median distance from it, and so on; each half remembers the range of
its distances. A query skips a half if ``factor * bound > best so far``, where the bound comes from
the triangle inequality. ``factor`` 1 skips only what cannot hold a nearer vector, so the search is
exact; larger factors skip more. Queries are read in blocks of bounded size, one after the other.

Equal vectors of a shard are one point of the tree that keeps its ``k + 1`` lowest ids, which is all
that can matter. Distances are Euclidean, in double precision, of the vectors as given.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without an id; of rows that share an id the lowest vector counts; vectors of other dimensions
are not compared; ties go to the lower id; with fewer than k candidates all are returned; without
queries or candidates the result is empty; extra columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import store

SHARD_ROWS, BLOCK_QUERIES, LEAF = 8192, 1024, 96
FACTOR = 1.0


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.empty((len(queries), len(points)))
    step = max(1, (1 << 21) // max(1, points.size))
    for a in range(0, len(queries), step):
        out[a:a + step] = np.sqrt(((queries[a:a + step, None, :] - points[None]) ** 2).sum(axis=2))
    return out


@dataclass
class Node:
    """A leaf with its points, or a vantage point with halves and the ranges of their distances from it."""

    points: np.ndarray
    halves: list[tuple[Node, float, float]] = field(default_factory=list)


def build(points: np.ndarray, own: np.ndarray) -> Node:
    if len(own) <= LEAF:
        return Node(own)
    centre = points[own].mean(axis=0)
    vantage = own[int(np.argmax(((points[own] - centre) ** 2).sum(axis=1)))]
    rest = own[own != vantage]
    far = distances(points[vantage][None], points[rest])[0]
    order = np.lexsort((rest, far))
    node = Node(np.array([vantage]))
    for half in np.array_split(order, 2):
        node.halves.append((build(points, rest[half]), float(far[half].min()), float(far[half].max())))
    return node


class Search:
    """The best ``k`` points of some queries, ties to the lower point number."""

    def __init__(self, points: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.points, self.queries, self.factor = points, queries, factor
        self.best = np.full((len(queries), k), np.inf)
        self.which = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.compared = 0

    def see(self, active: np.ndarray, own: np.ndarray) -> np.ndarray:
        d = distances(self.queries[active], self.points[own])
        self.compared += d.size
        k = self.best.shape[1]
        alld = np.concatenate([self.best[active], d], axis=1)
        who = np.concatenate([self.which[active], np.broadcast_to(own, d.shape)], axis=1)
        order = np.lexsort((who, alld), axis=-1)[:, :k]
        self.best[active], self.which[active] = np.take_along_axis(alld, order, 1), np.take_along_axis(who, order, 1)
        return d

    def visit(self, node: Node, active: np.ndarray) -> None:
        if not len(active):
            return
        d = self.see(active, node.points)
        if not node.halves:
            return
        away = d[:, 0]
        bounds = [np.maximum(np.maximum(away - high, low - away), 0) for _, low, high in node.halves]
        first = bounds[0] <= bounds[1]
        for turn in (True, False):  # every query takes its nearer half first
            for side, (half, _, _) in enumerate(node.halves):
                mine = (first == (side == 0)) == turn
                mine &= self.factor * bounds[side] <= self.best[active, -1]
                self.visit(half, active[mine])


def _usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(ok, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrices(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) by dimension, one row for each id."""
    frame = frame.assign(v=[tuple(v) for v in frame["v"]]).sort_values(["id", "v"]).drop_duplicates("id")
    for _, rows in frame.groupby(frame["v"].map(len)):
        yield rows["id"].to_numpy(np.int64), np.array(rows["v"].tolist(), np.float64)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest vectors found, but for the query's own id."""
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        return rows.where(F.col("id").isNotNull() & _usable(F.col("v")))

    points, asked = clean(vectors), cut(clean(queries))
    shards = max(1, -(-points.count() // SHARD_ROWS))
    blocks = -(-asked.count() // BLOCK_QUERIES)
    folder = store.new_folder(spark, "queries")

    def save(key, frame: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        np.savez(out, **{f"{part}{i}": x for i, pair in enumerate(_matrices(frame)) for part, x in zip("iv", pair)})
        store.put(f"{folder}/{key[0]}", out.getvalue())
        return pd.DataFrame({"block": [key[0]]})

    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(max(1, blocks))).alias("block")
    made = sorted(r.block for r in asked.groupBy(block).applyInPandas(save, "block long").collect())

    def search(key, frame: pd.DataFrame) -> pd.DataFrame:
        trees = {}
        for ids, matrix in _matrices(frame):
            rows, inverse = np.unique(np.ascontiguousarray(matrix + 0.0).view(f"V{matrix.shape[1] * 8}"), return_inverse=True)
            order = np.argsort(inverse.ravel(), kind="stable")  # ids ascend within a point
            edge = np.searchsorted(inverse.ravel()[order], np.arange(len(rows) + 1))
            lowest = np.argsort(ids[order[edge[:-1]]], kind="stable")  # points by their lowest id
            owners = [ids[order[edge[p]:edge[p + 1]]][:k + 1] for p in lowest]
            own = matrix[order[edge[:-1]]][lowest]
            trees[matrix.shape[1]] = own, owners, build(own, np.arange(len(own)))
        found = []
        for number in made:
            block = np.load(io.BytesIO(store.get(f"{folder}/{number}")))
            for i in range(len(block.files) // 2):
                ids, asked = block[f"i{i}"], block[f"v{i}"]
                if asked.shape[1] not in trees:
                    continue
                own, owners, tree = trees[asked.shape[1]]
                s = Search(own, asked, min(k + 1, len(own)), factor)
                s.visit(tree, np.arange(len(asked)))
                for q, ds, ps in zip(ids, s.best, s.which):
                    pairs = sorted((d, v) for d, p in zip(ds.tolist(), ps.tolist()) if d < np.inf for v in owners[p].tolist() if v != q)[:k]
                    found += [(q, v, d) for d, v in pairs]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    dealt = points.groupBy(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"))
    near = dealt.applyInPandas(search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
