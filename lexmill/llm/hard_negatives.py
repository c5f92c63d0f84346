"""Hard-negative mining: cover trees over norm-augmented vectors.

A vector's components become ``floor(scale * x)``, so scores are integer inner products and exact.
Every vector of a tree gets one more component that brings it to the tree's largest norm. Then the
inner product falls with the distance, and a node of the cover tree, a vector with the radius that
covers all below it, bounds the scores below it from both sides. Each level of the tree halves the
radius: its nodes are more than that apart and cover everything. The descent expands the node of the
best bound first and scores the vectors of its children exactly; queries leave a node whose scores
all lie outside their window or below the best they already have.

First every anchor finds its positives in trees of its own label, then every distinct positive score
opens a window ``[low %, high %]`` in which the trees of all other labels are searched. Rows are dealt
to shards of bounded bytes by label, large labels by id too; a shard holds one tree for each label.
Anchors lie in the shared folder in blocks of bounded bytes that tasks read one after the other.

Cases: rows without id, label or vector, or with null or non-finite components, take no part; nor
do vectors whose integer squared length exceeds 2^62, as their scores need not fit 64 bits. Zero and
empty vectors take part. Vectors of other dimensions are not compared. Rows that share id and label
count once, with the lowest vector; an id under two labels is two candidates, and as an anchor has
its lowest label; an anchor is never paired with its own id. A negative positive score has an empty
window. Fewer rows than asked for are returned if there are fewer. Without anchors or rows the
result is empty. Extra columns are not read.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import store

#: bytes of vectors in a shard, and in a block of anchors
SHARD_BYTES, BLOCK_BYTES = 4 << 20, 512 << 10
#: points below which a node is not divided, candidates for centres looked at together, scores held at once
LEAF, NET, SCORES = 16, 256, 1 << 21
NONE = np.iinfo(np.int64).min


@dataclass
class Node:
    """Centres of the children, the node's own first; how far each reaches; what is below those that have more."""

    centres: np.ndarray
    reach: np.ndarray
    below: list[Node | None] = field(default_factory=list)


class CoverTree:
    """Cover tree of distinct integer vectors."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        square = (self.points ** 2).sum(axis=1)
        self.largest = float(np.sqrt(square.max()))
        self.lift = np.sqrt(np.maximum(self.largest ** 2 - square, 0))
        self.blur = 1e-6 * max(self.largest, 1.0)  # far above the rounding of a distance
        rest = np.arange(1, len(points))
        away = self.distances(rest, np.zeros(1, int))[:, 0]
        self.reach = float(away.max(initial=0)) + self.blur
        self.root = self.grow(0, rest, float(away.max(initial=0)))

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        product = self.points[a] @ self.points[b].T + self.lift[a][:, None] * self.lift[b]
        return np.sqrt(np.maximum(2 * self.largest ** 2 - 2 * product, 0))

    def net(self, centre: int, own: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centres more than ``radius`` apart that cover all of ``own``, each point's nearest one and its distance."""
        centres, nearest = [centre], np.zeros(len(own), int)
        away = self.distances(own, np.array([centre]))[:, 0]
        while True:
            open_ = np.flatnonzero(away > radius)[:NET]
            if not len(open_):
                return np.array(centres), nearest, away
            apart, free, chosen = self.distances(own[open_], own[open_]) > radius, np.ones(len(open_), bool), []
            for i in range(len(open_)):
                if free[i]:
                    chosen.append(i)
                    free &= apart[i]
            new = own[open_[chosen]]
            step = max(1, SCORES // len(new))
            for s in range(0, len(own), step):
                part = slice(s, s + step)
                to_new = self.distances(own[part], new)
                to_new[new[None] == own[part][:, None]] = 0
                best = to_new.argmin(axis=1)
                value = to_new[np.arange(len(best)), best]
                closer = value < away[part]
                nearest[part][closer], away[part][closer] = best[closer] + len(centres), value[closer]
            centres += new.tolist()

    def grow(self, centre: int, own: np.ndarray, radius: float) -> Node:
        centres = np.array([centre])
        while len(own) > LEAF and len(centres) == 1 and radius > self.blur:  # levels that hold one node are skipped
            radius /= 2
            centres, nearest, away = self.net(centre, own, radius)
        if len(centres) == 1:
            return Node(np.concatenate([[centre], own]), np.zeros(len(own) + 1), [None] * (len(own) + 1))
        node = Node(centres, np.zeros(len(centres)))
        order = np.argsort(nearest, kind="stable")
        edge = np.searchsorted(nearest[order], np.arange(len(centres) + 1))
        for i, c in enumerate(centres.tolist()):
            mine = order[edge[i]:edge[i + 1]]
            mine = mine[own[mine] != c]
            far = float(away[mine].max(initial=0))
            node.reach[i] = far + self.blur if len(mine) else 0
            node.below.append(self.grow(c, own[mine], far) if len(mine) else None)
        return node


class Descent:
    """Best ``k`` points of every query with scores inside its window; ties to the lower point."""

    def __init__(self, tree: CoverTree, queries: np.ndarray, k: int, low: np.ndarray, high: np.ndarray):
        self.tree, self.queries, self.k = tree, queries, k
        self.low, self.high = low.copy(), high
        self.norm = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        self.exact_floats = self.norm.max(initial=0) * tree.largest < 2 ** 53
        self.score = np.full((len(queries), k), NONE)
        self.point = np.full((len(queries), k), -1)
        self.compared = 0
        self.slack = 1 + 1e-9 * self.norm * tree.largest
        self.run()

    def scores(self, asked: np.ndarray, points: np.ndarray) -> np.ndarray:
        self.compared += len(asked) * len(points)
        if self.exact_floats:  # no sum of products exceeds 2^53
            return (self.queries[asked].astype(np.float64) @ self.tree.points[points].T).astype(np.int64)
        return self.queries[asked] @ self.tree.points[points].astype(np.int64).T

    def offer(self, asked: np.ndarray, found: np.ndarray, points: np.ndarray) -> None:
        good = (found >= self.low[asked][:, None]) & (found <= self.high[asked][:, None])
        if found.shape[1] > 4 * self.k:
            kept = np.where(good, found, NONE)
            good &= found >= np.partition(kept, -self.k, axis=1)[:, -self.k, None]
        row, column = np.nonzero(good)
        if not len(row):
            return
        hit = np.unique(row)
        who = np.concatenate([np.repeat(hit, self.k), row])
        score = np.concatenate([self.score[asked[hit]].ravel(), found[row, column]])
        point = np.concatenate([self.point[asked[hit]].ravel(), points[column]])
        order = np.lexsort((point, -score, who))  # -NONE is NONE, but empty places are dropped below
        order = order[point[order] >= 0]
        who, score, point = who[order], score[order], point[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        top = place < self.k
        rows, place = asked[who[top]], place[top]
        self.score[rows, place], self.point[rows, place] = score[top], point[top]
        full = asked[hit][self.point[asked[hit], -1] >= 0]
        self.low[full] = np.maximum(self.low[full], self.score[full, -1])

    def bounds(self, asked: np.ndarray, found: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score below centres with the given scores."""
        norm, slack, largest = self.norm[asked][:, None], self.slack[asked][:, None], self.tree.largest
        away = np.sqrt(np.maximum(norm ** 2 + largest ** 2 - 2.0 * found, 0))
        near = np.maximum(away - reach, 0)
        high = np.minimum(found + norm * reach, (norm ** 2 + largest ** 2 - near ** 2) / 2 + self.tree.blur * norm)
        return found - norm * reach - slack, high + slack

    def run(self) -> None:
        everyone = np.flatnonzero(self.low <= self.high)
        root = np.zeros(1, int)
        self.offer(everyone, self.scores(everyone, root), root)
        queue, turn = [(0.0, 0, self.tree.root, everyone, np.full(len(everyone), np.inf))], 1
        while queue:
            _, _, node, asked, best = heapq.heappop(queue)
            asked = asked[best >= self.low[asked]]
            deeper = np.flatnonzero([n is not None for n in node.below])
            kept: list[list] = [[] for _ in deeper]
            step = max(1, SCORES // len(node.centres))
            for s in range(0, len(asked), step):
                part = asked[s:s + step]
                found = self.scores(part, node.centres)
                self.offer(part, found[:, 1:], node.centres[1:])
                if len(deeper):
                    lowest, highest = self.bounds(part, found[:, deeper], node.reach[deeper])
                    stay = (highest >= self.low[part][:, None]) & (lowest <= self.high[part][:, None])
                    for j in np.flatnonzero(stay.any(axis=0)):
                        kept[j].append((part[stay[:, j]], highest[stay[:, j], j]))
            for j, parts in zip(deeper, kept):
                if parts:
                    who, bound = (np.concatenate(x) for x in zip(*parts))
                    heapq.heappush(queue, (-float(bound.max()), turn, node.below[j], who, bound))
                    turn += 1


def _trees(frame: pd.DataFrame, k: int) -> Iterator[tuple[str, CoverTree, list[np.ndarray]]]:
    """(label, tree, ids of each point in order) of a shard, by label and dimension; points by their lowest id."""
    for (label, _), rows in frame.groupby(["label", frame["v"].map(len)]):
        values = np.array(rows["v"].tolist(), np.int64).reshape(len(rows), -1)
        ids = rows["id"].to_numpy(np.int64)
        order = np.lexsort((*values.T[::-1], ids))
        values, ids = values[order], ids[order]
        once = np.concatenate([[True], ids[1:] != ids[:-1]])
        values, ids = values[once], ids[once]
        if values.shape[1]:
            distinct, inverse = np.unique(values, axis=0, return_inverse=True)
        else:
            distinct, inverse = values[:1], np.zeros(len(values), int)
        inverse = inverse.ravel()
        order = np.argsort(inverse, kind="stable")
        edge = np.searchsorted(inverse[order], np.arange(len(distinct) + 1))
        by_id = np.argsort(ids[order[edge[:-1]]], kind="stable")
        owners = [ids[order[edge[p]:edge[p + 1]]][:k + 1] for p in by_id]
        yield label, CoverTree(distinct[by_id]), owners


def _load(uri: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, positive scores, vectors) of a block, by dimension."""
    frame = pd.read_pickle(io.BytesIO(store.get(uri)))
    for _, rows in frame.groupby(frame["v"].map(len)):
        yield rows["id"].to_numpy(np.int64), rows["label"].to_numpy(str), rows["goal"].to_numpy(np.int64), np.array(rows["v"].tolist(), np.int64).reshape(len(rows), -1)


def share_up(value: np.ndarray, percent: int) -> np.ndarray:
    """The least integer that is at least ``percent`` of the value, without leaving 64 bits."""
    return value // 100 * percent - (-(value % 100) * percent) // 100


def share_down(value: np.ndarray, percent: int) -> np.ndarray:
    return value // 100 * percent + value % 100 * percent // 100


def _search(folder: str, blocks: list[tuple[int, int]], k: int, same: bool, window: tuple[int, int]):
    """Search the trees of a shard for anchors of the same label, or of others inside their windows."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        trees, out = list(_trees(frame, k)), []
        for group, part in blocks:
            if same and group != key[0]:
                continue
            for ids, labels, goals, vectors in _load(f"{folder}/{group}-{part}"):
                score, other = np.full((len(ids), k), NONE), np.zeros((len(ids), k), np.int64)
                for label, tree, owners in trees:
                    mine = np.flatnonzero((labels == label) == same)
                    if tree.points.shape[1] != vectors.shape[1] or not len(mine):
                        continue
                    if same:
                        low, high = np.full(len(mine), NONE), np.full(len(mine), np.iinfo(np.int64).max)
                    else:
                        low, high = share_up(goals[mine], window[0]), share_down(goals[mine], window[1])
                    low = np.maximum(low, score[mine, -1])  # what earlier trees of the shard gave
                    found = Descent(tree, vectors[mine], min(k + 1, len(owners)), low, high)
                    for q, scores, points in zip(mine.tolist(), found.score, found.point):
                        rows = [(-s, v) for s, p in zip(scores.tolist(), points.tolist()) if p >= 0 for v in owners[p].tolist() if v != ids[q]]
                        rows += [(-s, v) for s, v in zip(score[q].tolist(), other[q].tolist()) if s != NONE]
                        rows = sorted(rows)[:k]
                        score[q, :len(rows)], other[q, :len(rows)] = [-s for s, _ in rows], [v for _, v in rows]
                row, place = np.nonzero(score != NONE)
                out.append(pd.DataFrame({"anchor_id": ids[row], "goal": goals[row], "other": other[row, place], "score": score[row, place]}))
        return pd.concat(out) if out else pd.DataFrame({"anchor_id": [], "goal": [], "other": [], "score": []}).astype("int64")

    return run


def _blocks(rows: DataFrame, name: str) -> tuple[str, list[tuple[int, int]]]:
    """Write anchors (grp, id, label, goal, v) to the shared folder in blocks of bounded bytes, by group."""
    folder = store.new_folder(rows.sparkSession, name)
    sizes = rows.groupBy("grp").agg(F.ceil(F.sum(F.size("v") + 4) * 8 / BLOCK_BYTES).alias("parts"))
    dealt = rows.join(sizes, "grp").withColumn("part", F.pmod(F.xxhash64("id", F.lit(5)), "parts"))

    def save(key, frame: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        frame[["id", "label", "goal", "v"]].to_pickle(out)
        store.put(f"{folder}/{key[0]}-{key[1]}", out.getvalue())
        return pd.DataFrame({"grp": [key[0]], "part": [key[1]]})

    made = dealt.groupBy("grp", "part").applyInPandas(save, "grp long, part long").collect()
    return folder, sorted((r.grp, r.part) for r in made)


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100), scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the columns of ``vectors``. For each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels whose score is
    within ``window`` percent of the positive's.
    """
    spark = vectors.sparkSession
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("given"),
        F.when(finite, whole).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(length <= 2.0 ** 62).drop("given")

    # a label of more than a shard is a group of its own, dealt to shards by id; smaller ones share groups
    total = rows.agg(F.sum(F.size("v") + 4)).first()[0] or 0
    buckets = max(1, -(-int(total) * 8 // SHARD_BYTES))
    sizes = rows.groupBy("label").agg((F.sum(F.size("v") + 4) * 8).alias("bytes"))
    sizes = sizes.select("label", F.ceil(F.col("bytes") / SHARD_BYTES).alias("salts"))
    group = F.when(F.col("salts") > 1, F.xxhash64("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(buckets)))
    rows = cut(rows.join(sizes, "label").select("id", "label", "v", "anchor", group.alias("grp"), F.pmod(F.xxhash64("id"), "salts").alias("salt")))

    asked = rows.where("anchor").groupBy("id").agg(F.min(F.struct("label", "v", "grp")).alias("row")).select(
        "id", "row.label", "row.v", "row.grp", F.lit(0).cast("long").alias("goal"))
    asked = cut(asked)
    shards = rows.select("grp", "salt", "id", "label", "v").groupBy("grp", "salt")
    schema = "anchor_id long, goal long, other long, score long"
    folder, blocks = _blocks(asked, "anchors")
    near = cut(_top(shards.applyInPandas(_search(folder, blocks, positives, True, window), schema), ["anchor_id"], positives))

    goals = near.where("score >= 0").select(F.col("anchor_id").alias("id"), F.col("score").alias("goal")).distinct()
    folder, blocks = _blocks(asked.drop("goal").join(goals, "id"), "windows")
    far = _top(shards.applyInPandas(_search(folder, blocks, negatives, False, window), schema), ["anchor_id", "goal"], negatives)
    pairs = near.select("anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("goal"))
    return pairs.join(far.withColumnsRenamed({"other": "negative_id", "score": "negative_score"}), ["anchor_id", "goal"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("goal").alias("positive_score"), "negative_score")
