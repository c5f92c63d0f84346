"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

Documents of equal shingle sets are one set. Every set has one label per tree, the first values of
its MinHash signature there. The sets below one prefix in the trie of a tree are candidates of each
other; starting from whole labels, the prefix is shortened until a pair at the threshold meets in
some tree with the target probability. Sets that meet, directly or through others, form a candidate
component. All pairs inside a component are verified exactly, as a product of 0/1 matrices; large
components are dealt out in pairs of blocks of bounded size, and no pair leaves its task: only the
number of links of each set and a tree that joins the linked ones.

Shingles are five words ``[^\\x20\\x09-\\x0D]+``, unchanged; a text of one to four words is one shingle.

Cases: null texts, empty ones and those without words have no links and are alone in their classes,
like every set without links; equal rows are one set; documents without an id are members too, and
the class id is null only if no member has an id; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import clusters
from ..operators.lineage import cut
from .common import blob, gram_hashes, inside, mix64, pieces, raw, row_key, words

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, TARGET = 32, 10, 0.9999
#: sets, and shingles, of one block
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1 << 20
#: shingles multiplied at a time
COLUMNS = 4096


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, target: float = TARGET) -> int:
    """Shorten the prefix until a pair at the threshold meets in some tree with the target probability."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def shingles(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    data, offsets = raw(texts)
    w = words(data, offsets)
    if not len(w.code):
        return [np.zeros(0, np.uint64)] * len(texts)
    hashes = w.hashes()[w.code]
    grams, whole = gram_hashes(hashes, n), inside(w.first, n, len(hashes))
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        else:
            out.append(gram_hashes(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    assert whole.size == grams.size
    return out


def tree_labels(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """One hash for each set and tree: of the first ``depth`` signature values. Sets must not be empty."""
    rng = np.random.default_rng(20)
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    labels = np.empty((len(sets), trees), np.uint64)
    for t in range(trees):
        label = np.full(len(sets), t + 1, np.uint64)
        for _ in range(depth):
            flip, times = rng.integers(0, 1 << 32, 2, dtype=np.uint64).astype(np.uint32)
            least = np.minimum.reduceat((x ^ flip) * (times | np.uint32(1)), first)
            label = mix64(label * np.uint64(0x9E3779B97F4A7C15) + least)
        labels[:, t] = label
    return labels


def _signed(batch_limit: int, n: int, trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=batch_limit):
            sets = shingles(batch.column("text"), n)
            full = [i for i, s in enumerate(sets) if len(s)]
            labels = tree_labels([sets[i] for i in full], trees, depth) if full else None
            ids, packed = [None] * len(sets), [None] * len(sets)
            for row, i in enumerate(full):
                ids[i], packed[i] = xxhash.xxh3_128_digest(blob(sets[i])), blob(labels[row])
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("k1"), batch.column("k2"), pa.array(ids, pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array(packed, pa.binary())], ["id", "k1", "k2", "set", "n", "labels"])

    return run


def _split_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = [np.frombuffer(x, np.int64) for x in batch.column("labels").to_pylist()]
        if labels:
            where = np.repeat(np.arange(len(labels)), [len(x) for x in labels])
            yield pa.RecordBatch.from_arrays([batch.column("set").take(pa.array(where)), pa.array(np.concatenate(labels))], ["set", "label"])


def _linked(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which pairs (left, right) have the similarity; within one list, if there is no right one."""
    both = left + (right or [])
    size = np.array([len(s) for s in both])
    who = np.repeat(np.arange(len(both)), size)
    values, column, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[column]
    who, column = who[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    m = len(left)
    inter = np.zeros((m, len(both) - m if right else m), np.float32)
    for a in range(0, int(shared.sum()), COLUMNS):
        x, y = np.searchsorted(column, [a, a + COLUMNS])
        one = np.zeros((len(both), COLUMNS), np.float32)
        one[who[x:y], column[x:y] - a] = 1
        inter += one[:m] @ (one[m:] if right else one).T
    a, b = size[:m, None], (size[m:] if right else size)[None]
    linked = inter >= threshold * (a + b - inter) - 1e-6
    if not right:
        np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray, bipartite: bool) -> np.ndarray:
    """A common root for all that are joined by links; the nodes are rows, then columns if they differ."""
    m, k = linked.shape
    n = m + k if bipartite else m
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start] = start
        front = np.array([start])
        while len(front):
            if bipartite:
                rows, cols = front[front < m], front[front >= m] - m
                near = np.concatenate([np.flatnonzero(linked[:, cols].any(axis=1)), m + np.flatnonzero(linked[rows].any(axis=0))])
            else:
                near = np.flatnonzero(linked[front].any(axis=0))
            front = near[root[near] < 0]
            root[front] = start
    return root


def _verify(threshold: float):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["block", "set"]).sort_values(["block", "set"])  # equal rows give a set more than once
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        m = int((frame["block"] == frame["block"].iloc[0]).sum())
        split = key[1] != key[2]
        if split and m == len(sets):  # the other block has no sets
            return pd.DataFrame({"set": [], "links": [], "root": []})
        linked = _linked(sets[:m], sets[m:] if split else None, threshold)
        links = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)]) if split else linked.sum(axis=1)
        names = frame["set"].to_numpy()
        return pd.DataFrame({"set": names, "links": links.astype(np.int64), "root": names[_roots(linked, split)]})

    return run


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, trees: int = TREES, target: float = TARGET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, k1, k2, class_id, n_links, n_copies, stays) for all documents.

    A class is a connected component of links, named by its lowest document id. ``n_links`` counts
    the different shingle sets linked to the document's own, ``n_copies`` the documents of its set.
    ``stays`` marks the first document of each class, and those equal to it in id and text.
    """
    depth = prefix_depth(threshold, trees, DEPTH, target)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    signed = cut(rows.mapInArrow(_signed(4 << 20, n, trees, depth), f"id {kind}, k1 long, k2 long, set binary, n long, labels binary"))
    sets = cut(signed.where("set IS NOT NULL").groupBy("set").agg(
        F.count("*").alias("copies"), F.min(F.struct("k1", "k2")).alias("from"), F.first("n").alias("n"), F.first("labels").alias("labels")))

    labels = sets.select("set", "labels").mapInArrow(_split_labels, "set binary, label long")
    nodes = labels.groupBy("label").agg(F.min("set").alias("hub"), F.count("*").alias("n")).where("n > 1")
    edges = labels.join(nodes, "label").where("set <> hub").select(F.col("set").alias("source_case_id"), F.col("hub").alias("target_case_id")).distinct()
    components = cut(clusters(edges))

    members = components.join(sets.select(F.col("set").alias("node"), "from", "n"), "node")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = components.join(sets.select(F.col("set").alias("node"), "n"), "node").groupBy("component").agg(blocks.alias("blocks"))
    placed = members.join(sizes, "component").select(
        F.col("from.k1").alias("k1"), F.col("from.k2").alias("k2"), F.col("node").alias("set"), "component", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            packed = pa.array([blob(s) for s in shingles(batch.column("text"), n)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("set", "component", "blocks", "block")), packed], ["set", "component", "blocks", "block", "shingles"])

    texts = rows.select("k1", "k2", "text").join(placed, ["k1", "k2"])
    taken = texts.select("text", "set", "component", "blocks", "block").mapInArrow(take, "set binary, component binary, blocks int, block int, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = taken.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    verified = cut(paired.groupBy("component", "low", "high").applyInPandas(_verify(threshold), "set binary, links long, root binary"))
    links = verified.groupBy("set").agg(F.sum("links").alias("links"))
    joined = clusters(verified.where("set <> root").select(F.col("set").alias("source_case_id"), F.col("root").alias("target_case_id")))

    facts = sets.select("set", "copies").join(links, "set", "left").join(joined.select(F.col("node").alias("set"), "component"), "set", "left").select(
        "set", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "set").alias("class"))
    named = signed.select("id", "k1", "k2", "set").where("set IS NOT NULL").join(facts, "set")
    first = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("id"), F.col("k2").alias("k2"))
    # written, so that the join back to the members of a large class is one whose partitions can be split
    best = cut(named.groupBy("class").agg(F.min(first).alias("best")))
    found = named.join(best, "class").select(
        "id", "k1", "k2", F.col("best.id").alias("class_id"), F.col("links").alias("n_links"), F.col("copies").alias("n_copies"),
        (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("k2") == F.col("best.k2"))).alias("stays"))
    alone = signed.where("set IS NULL").select(
        "id", "k1", "k2", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("stays"))
    return found.unionByName(alone).withColumnRenamed("id", id_col)


def first_of_each(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: one of each class, whole rows; documents without words all stay, equal rows once."""
    kept = joined.where("stays").select("k1", "k2").distinct()
    key = row_key(id_col, text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(row, *key).join(kept, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("doc.*")
