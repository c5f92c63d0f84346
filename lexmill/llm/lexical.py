"""Ranked lexical search: a document FP-tree with branch and bound for each item.

A document's vector keeps the terms that some item has, with how often they occur, in order of
falling document frequency. Documents sorted by their vectors form an FP-tree: those below a node
share the path to it. Every node knows the most that a term occurs in one document below it and the
least length factor ``m`` there. A term's part of the score grows with ``tf`` and falls with ``m``, so
these give the most that any document below can score for an item. The walk goes down depth first,
the child of the best bound before the others; an item leaves the walk at a node whose bound is below
its ``k``-th best score. Items that are still in the race go down together; documents of a last node
are scored exactly. Neighbouring children with few documents are walked as one node.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, only A-Z lower-cased;
all arithmetic but the weight's logarithm is exact in 64 bits. Items lie in the shared folder in blocks
of bounded bytes; document vectors are written once, then read for the frequencies and for the trees.
A tree holds a bounded number of entries, a task ``k`` rows for each item.

Cases: null and empty texts have no terms and count nowhere; an item without an id or terms has no
rows; equal item rows are one item, and rows that share only the id are ranked each for itself;
documents that share an id are documents of their own; documents without an id come last among
equals; without items or documents the result is empty; extra columns are not read.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import store
from .common import blob, lower, pieces, raw, words

#: fixed value: bytes that are in no term
BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

#: bytes of item texts in a block; entries of a tree; documents below which a node is not divided
BLOCK_BYTES, TREE_ENTRIES, LEAF = 2 << 20, 2_000_000, 64
LAST = np.iinfo(np.int64).max


@dataclass
class Items:
    """Terms of a block of items, and which items have each term how often."""

    ids: np.ndarray
    keys: np.ndarray
    terms: pa.Array
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(ids: np.ndarray, keys: np.ndarray, texts: pa.Array) -> Items:
        data, offsets = raw(texts)
        w = words(lower(data), offsets, BETWEEN)
        pairs, times = np.unique(w.code * len(texts) + np.repeat(np.arange(len(texts)), np.diff(w.first)), return_counts=True)
        code, item = np.divmod(pairs, len(texts))
        return Items(ids, keys, w.vocabulary, np.searchsorted(code, np.arange(len(w.vocabulary) + 1)), item, times.astype(np.int64))

    def save(self, uri: str) -> None:
        out = io.BytesIO()
        size = pc.binary_length(self.terms).to_numpy(zero_copy_only=False)
        text = np.frombuffer(b"".join(self.terms.to_pylist()), np.uint8)
        np.savez(out, ids=self.ids, keys=self.keys, size=size, text=text, first=self.first, item=self.item, times=self.times)
        store.put(uri, out.getvalue())


@lru_cache(maxsize=8)
def _load(uri: str) -> Items:
    z = np.load(io.BytesIO(store.get(uri)))
    offsets = np.concatenate([[0], np.cumsum(z["size"])]).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(z["size"]), [None, pa.py_buffer(offsets), pa.py_buffer(z["text"])])
    return Items(z["ids"], z["keys"], terms, z["first"], z["item"], z["times"])


def _vectors(folder: str, blocks: list[int]):
    """Rows (id, n, block, codes, tfs): terms of a block's items in a document; the first block has all documents with terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=4 << 20):
            data, offsets = raw(batch.column("text"))
            w = words(lower(data), offsets, BETWEEN)
            n, doc = np.diff(w.first), np.repeat(np.arange(batch.num_rows), np.diff(w.first))
            for turn, block in enumerate(blocks):
                terms = _load(f"{folder}/{block}").terms
                known = pc.fill_null(pc.index_in(w.vocabulary, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                code = known[w.code] if len(w.code) else w.code
                hit = code >= 0
                pairs, tf = np.unique(doc[hit] * len(terms) + code[hit], return_counts=True)
                who, code = np.divmod(pairs, max(1, len(terms)))
                edge = np.searchsorted(who, np.arange(batch.num_rows + 1))
                keep = np.flatnonzero(n > 0 if turn == 0 else np.diff(edge) > 0)
                code, tf = code.astype(np.uint32), tf.astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(keep)), pa.array(n[keep].astype(np.int64)), pa.array(np.full(len(keep), block, np.int64)),
                    pa.array([blob(code[edge[i]:edge[i + 1]]) for i in keep], pa.binary()),
                    pa.array([blob(tf[edge[i]:edge[i + 1]]) for i in keep], pa.binary())], ["id", "n", "block", "codes", "tfs"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        for block in np.unique(blocks):
            rows = batch.column("codes").take(pa.array(np.flatnonzero(blocks == block)))
            code, df = np.unique(raw(rows)[0].view(np.uint32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), block)), pa.array(code.astype(np.int64)), pa.array(df.astype(np.int64))], ["block", "code", "df"])


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _added(where: np.ndarray, what: np.ndarray, size: int) -> np.ndarray:
    """Sum of ``what`` by place, exactly."""
    if what.sum(dtype=np.float64) < 2 ** 53:
        return np.bincount(where, what, size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, where, what)
    return out


@dataclass
class Node:
    """Documents [a, b), the most each term occurs in one of them, their least m, and the children."""

    a: int
    b: int
    terms: np.ndarray
    most: np.ndarray
    least_m: int
    children: list[Node] = field(default_factory=list)


class FPTree:
    """``terms`` of a document are ranks by falling frequency, ascending; documents get sorted by them."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, first: np.ndarray, terms: np.ndarray, tf: np.ndarray):
        path = terms.astype(">u4")
        paths = [path[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        order = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        size = np.diff(first)[order]
        self.first = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(first[:-1][order] - self.first[:-1], size) + np.arange(self.first[-1])
        self.ids, self.m, self.terms, self.tf = ids[order], m[order], terms[at], tf[at]
        self.root = self.grow(0, len(order), 0)

    def shared(self, a: int, b: int, depth: int) -> int:
        """Length of the path that the documents [a, b) share; they do for ``depth`` terms, and are sorted."""
        x, y = self.terms[self.first[a]:self.first[a + 1]], self.terms[self.first[b - 1]:self.first[b]]
        n = min(len(x), len(y))
        apart = np.flatnonzero(x[depth:n] != y[depth:n])
        return depth + int(apart[0]) if len(apart) else n

    def grow(self, a: int, b: int, depth: int) -> Node:
        if b - a < 2 * LEAF:
            return self.leaf(a, b)
        depth = self.shared(a, b, depth)
        ends = np.diff(self.first)[a:b] <= depth
        following = np.where(ends, -1, self.terms[np.minimum(self.first[a:b] + depth, len(self.terms) - 1)])
        edges = [a, *(a + 1 + np.flatnonzero(following[1:] != following[:-1])).tolist(), b]
        if len(edges) == 2:  # all of them are equal
            return self.leaf(a, b)
        groups, start = [], a  # neighbouring small children are one
        for x, y in zip(edges[:-1], edges[1:]):
            if y - x >= LEAF:
                groups += [(start, x, depth)] * (x > start) + [(x, y, depth + 1)]
                start = y
            elif y - start >= LEAF:
                groups.append((start, y, depth))
                start = y
        groups += [(start, b, depth)] * (b > start)
        children = [self.grow(*g) if (g[0], g[1]) != (a, b) else self.leaf(a, b) for g in groups]
        return self.merged(a, b, np.concatenate([c.terms for c in children]), np.concatenate([c.most for c in children]), children)

    def leaf(self, a: int, b: int) -> Node:
        part = slice(self.first[a], self.first[b])
        return self.merged(a, b, self.terms[part], self.tf[part], [])

    def merged(self, a: int, b: int, terms: np.ndarray, most: np.ndarray, children: list[Node]) -> Node:
        order = np.argsort(terms, kind="stable")
        edge = np.flatnonzero(np.diff(terms[order], prepend=-1))
        top = np.maximum.reduceat(most[order], edge) if len(edge) else most
        return Node(a, b, terms[order][edge], top, int(self.m[a:b].min()), children)


class Race:
    """The best ``k`` documents of every item of a block so far."""

    def __init__(self, items: Items, weights: np.ndarray, k: int):
        self.items, self.k = items, k
        self.rank = np.empty(len(weights), np.int64)  # ranks of the terms by falling frequency: rising weight
        order = np.argsort(weights, kind="stable")
        self.rank[order] = np.arange(len(order))
        size = np.diff(items.first)[order]
        self.first = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(items.first[:-1][order] - self.first[:-1], size) + np.arange(self.first[-1])
        self.item, self.value = items.item[at], items.times[at] * np.repeat(weights[order], size)
        self.score = np.zeros((len(items.ids), k), np.int64)
        self.doc = np.full((len(items.ids), k), LAST)
        self.scored = 0

    def sums(self, active: np.ndarray, where: np.ndarray, rows: int, terms: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """(rows, active items): sum over the entries of a row of weight times their part."""
        number = np.full(len(self.items.ids), -1)
        number[active] = np.arange(len(active))
        if len(active) < len(number):
            needed = np.zeros(len(self.first), bool)
            needed[np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))[number[self.item] >= 0]] = True
            kept = needed[terms]
            where, terms, tf, m = where[kept], terms[kept], tf[kept], m[kept]
        part = 1_000_000_000 * tf // (1000 * tf + 8 * m)
        size = self.first[terms + 1] - self.first[terms]
        at = np.repeat(self.first[terms] - np.cumsum(size) + size, size) + np.arange(size.sum())
        who = number[self.item[at]]
        good = who >= 0
        flat = np.repeat(where, size)[good] * len(active) + who[good]
        return _added(flat, (np.repeat(part, size) * self.value[at])[good], rows * len(active)).reshape(rows, len(active))

    def bounds(self, active: np.ndarray, nodes: list[Node]) -> np.ndarray:
        size = [len(n.terms) for n in nodes]
        m = np.repeat(np.array([n.least_m for n in nodes], np.int64), size)
        return self.sums(active, np.repeat(np.arange(len(nodes)), size), len(nodes), np.concatenate([n.terms for n in nodes]), np.concatenate([n.most for n in nodes]), m)

    def offer(self, active: np.ndarray, scores: np.ndarray, docs: np.ndarray) -> None:
        self.scored += scores.size
        place, doc = np.nonzero((scores >= self.score[active, -1][None]).T & (scores > 0).T)
        if not len(place):
            return
        hit = np.unique(place)
        who = np.concatenate([np.repeat(hit, self.k), place])
        score = np.concatenate([self.score[active[hit]].ravel(), scores[doc, place]])
        name = np.concatenate([self.doc[active[hit]].ravel(), docs[doc]])
        order = np.lexsort((name, -score, who))
        who, score, name = who[order], score[order], name[order]
        nth = np.arange(len(who)) - np.searchsorted(who, who)
        top = nth < self.k
        self.score[active[who[top]], nth[top]], self.doc[active[who[top]], nth[top]] = score[top], name[top]

    def walk(self, tree: FPTree) -> None:
        everyone = np.arange(len(self.items.ids))
        stack = [(tree.root, everyone, self.bounds(everyone, [tree.root])[0])]
        while stack:
            node, active, bound = stack.pop()
            stay = (bound >= self.score[active, -1]) & (bound > 0)
            active = active[stay]
            if not len(active):
                continue
            if node.children:
                bounds = self.bounds(active, node.children)
                for i in np.argsort(bounds.max(axis=1), kind="stable"):  # the best is on top of the stack
                    some = (bounds[i] >= self.score[active, -1]) & (bounds[i] > 0)
                    if some.any():
                        stack.append((node.children[i], active[some], bounds[i][some]))
                continue
            for a in range(node.a, node.b, 4 * LEAF):  # a last node of equal documents can be long
                b = min(node.b, a + 4 * LEAF)
                part = slice(tree.first[a], tree.first[b])
                size = np.diff(tree.first[a:b + 1])
                scores = self.sums(active, np.repeat(np.arange(b - a), size), b - a, tree.terms[part], tree.tf[part], np.repeat(tree.m[a:b], size))
                self.offer(active, scores, tree.ids[a:b])


def _walked(folder: str, k: int, total: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        races: dict[int, Race] = {}
        waiting: dict[int, list] = {}
        entries = 0

        def walk() -> None:
            for block, rows in waiting.items():
                if block not in races:
                    races[block] = Race(_load(f"{folder}/{block}"), np.frombuffer(store.get(f"{folder}/{block}-weights"), np.int64), k)
                race = races[block]
                ids, n, code, tf = (np.concatenate(x) for x in zip(*[(r[0], r[1], r[3], r[4]) for r in rows]))
                first = np.concatenate([[0], np.cumsum(np.concatenate([r[2] for r in rows]))])
                m = 100 - 75 + 75 * n * total // length
                rank, doc = race.rank[code], np.repeat(np.arange(len(ids)), np.diff(first))
                order = np.lexsort((rank, doc))
                race.walk(FPTree(ids, m, first, rank[order], tf[order]))
            waiting.clear()

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            ids = pc.fill_null(batch.column("id"), LAST).to_numpy(zero_copy_only=False)
            for block in np.unique(blocks):
                own = np.flatnonzero(blocks == block)
                codes, edge = raw(batch.column("codes").take(pa.array(own)))
                tfs, _ = raw(batch.column("tfs").take(pa.array(own)))
                full = np.diff(edge) > 0
                if not full.any():  # none of the items' terms; if no document has one, the terms have no weights
                    continue
                waiting.setdefault(int(block), []).append((
                    ids[own][full], batch.column("n").to_numpy()[own][full], (np.diff(edge) // 4)[full],
                    codes.view(np.uint32).astype(np.int64), tfs.view(np.uint32).astype(np.int64)))
                entries += len(codes) // 4
            if entries >= TREE_ENTRIES:
                walk()
                entries = 0
        walk()
        for race in races.values():
            row, place = np.nonzero(race.score > 0)
            doc = race.doc[row, place]
            yield pa.RecordBatch.from_arrays([
                pa.array(race.items.ids[row]), pa.array(race.items.keys[row]), pa.array(doc, mask=doc == LAST), pa.array(race.score[row, place])],
                ["item_id", "item_key", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the k best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    folder = store.new_folder(spark, "items")
    block = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, -(-size // BLOCK_BYTES)))).alias("block")

    def save(key, frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values(["id", "text"])
        Items.of(rows["id"].to_numpy(np.int64), rows["key"].to_numpy(np.int64), pa.array(rows["text"], pa.string())).save(f"{folder}/{key[0]}")
        return pd.DataFrame({"block": [key[0]]})

    dealt = asked.select("id", "text", F.xxhash64("text").alias("key"), block).groupBy("block")
    blocks = sorted(r.block for r in dealt.applyInPandas(save, "block long").collect())
    if not blocks:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") > 0)
    vectors = cut(texts.mapInArrow(_vectors(folder, blocks), "id long, n long, block long, codes binary, tfs binary"))
    sums = vectors.where(F.col("block") == blocks[0]).agg(F.count("*").alias("total"), F.sum("n").alias("length")).first()
    total, length = sums.total, sums.length or 1

    def weigh(key, frame: pd.DataFrame) -> pd.DataFrame:
        own = _load(f"{folder}/{key[0]}")
        df = np.zeros(len(own.terms), np.int64)
        df[frame["code"]] = frame["df"]
        store.put(f"{folder}/{key[0]}-weights", blob(np.array([weight(total, n) for n in df.tolist()], np.int64)))
        return pd.DataFrame({"block": [key[0]]})

    counts = vectors.select("block", "codes").mapInArrow(_frequencies, "block long, code long, df long").groupBy("block", "code").agg(F.sum("df").alias("df"))
    counts.groupBy("block").applyInPandas(weigh, "block long").count()

    found = vectors.mapInArrow(_walked(folder, k, total, length), "item_id long, item_key long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item_id", "item_key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
