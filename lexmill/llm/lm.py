"""Language-model scores from a log-frequency Bloom filter.

Training counts all word n-grams up to ``order`` of all training texts. Each n-gram is put into a
Bloom filter once for every level up to its quantised count ``1 + floor(log_base(count))``; a reader
probes the levels one after the other until one is missing, and so gets the count back up to the
quantisation, with errors to one side that fade with every level. Filters come in shards by key,
each bounded in size; workers load the shards one at a time, so what a task holds doesn't grow with
the corpus. Beside them, each shard keeps the exact counts of its words for the base score.

Probability of a word after its history, from the longest history down:
``P_n = (min(c(h w), c(h)) + mu * P_(n-1)) / (c(h) + mu)``, with
``P_1 = (c + 0.5) / (N + 0.5 (V + 1))``.

Cases: a null text is an empty one and consists of the end token; documents without an id belong to
the training texts; equal rows count each; without training texts N and V are 0; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import store
from .common import PIECE_BYTES, blob, lower, mix64, pieces, raw, words

#: text bytes counted into one shard, on average
SHARD_BYTES = 8 << 20
BITS, PROBES, BASE, MU = 8, 4, 1.5, 2.0
#: a hash within a shard; with the shard's own bits the identity of an n-gram
_KEY = np.uint64((1 << 40) - 1)
_END, _BEGIN, _BEFORE = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" end", b" begin", b" before"))


@dataclass
class Tokens:
    """The n-gram keys of every token, order by order, and the tokens' documents."""

    keys: list[np.ndarray]
    first: np.ndarray
    word: np.ndarray  # -1 for the end, else the distinct word
    hashes: np.ndarray


def tokens(texts: pa.Array, order: int) -> Tokens:
    data, offsets = raw(texts)
    w = words(lower(data), offsets)
    hashes = w.hashes()
    n = len(offsets) - 1
    first = w.first + np.arange(n + 1)
    code = np.full(int(first[-1]), -1, np.int64)
    code[np.arange(len(w.code)) + np.repeat(np.arange(n), np.diff(w.first))] = w.code
    one = np.full(len(code), _END, np.uint64)
    one[code >= 0] = hashes[code[code >= 0]]
    keys, last = [one], one
    for k in range(1, order):
        last = _after(last, first, k)
        keys.append(mix64(last * np.uint64(0x9E3779B97F4A7C15) + one))
        last = keys[-1]
    return Tokens(keys, first, code, hashes)


def _after(key: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """The key of the token before, which is the history of this one."""
    out = np.empty_like(key)
    out[1:] = key[:-1]
    out[first[:-1]] = history_start(order)
    return out


def history_start(order: int) -> np.uint64:
    """Key of the history of ``order`` places before a text."""
    return _BEGIN if order == 1 else np.uint64((int(_BEFORE) * (2 * order + 1)) & 0xFFFFFFFFFFFFFFFF)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)


def _five(keys: np.ndarray) -> bytes:
    """The lower 40 bits of each key."""
    return blob(keys.view(np.uint8).reshape(-1, 8)[:, :5])


def _wide(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view(np.uint64)


def _count(order: int, shards: int):
    """Counts of each slice, packed by shard: kind 0 words with whole keys, kind n n-grams, short keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE_BYTES // 2):
            t = tokens(batch.column("text"), order)
            ends = np.uint64(batch.num_rows)
            for kind, keys in enumerate(t.keys):
                if kind == 0:
                    n = np.bincount(t.word[t.word >= 0], minlength=len(t.hashes)).astype(np.uint64)
                    found, n = np.append(t.hashes, _END), np.append(n, ends)
                else:
                    found, n = np.unique(keys, return_counts=True)
                shard = _shard(found, shards)
                by = np.argsort(shard, kind="stable")
                edge = np.searchsorted(shard[by], np.arange(shards + 1))
                rows = []
                for s in np.flatnonzero(np.diff(edge)).tolist():
                    own = by[edge[s]:edge[s + 1]]
                    rows.append((s, kind, blob(found[own]) if kind == 0 else _five(found[own]), blob(n[own].astype(np.uint32))))
                if kind:
                    start = np.array([history_start(kind)], np.uint64)
                    rows.append((int(_shard(start, shards)[0]), -kind, _five(start), blob(np.array([ends], np.uint32))))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["shard", "kind", "keys", "counts"])

    return run


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(key, kind="stable")
    key = key[by]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[new], np.add.reduceat(count[by].astype(np.int64), new)


def levels_of(count: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(count) / np.log(base) + 1e-9).astype(np.int64)


def expected(level: np.ndarray, base: float) -> np.ndarray:
    """Middle of the counts that share a level; 0 for none."""
    low, high = np.ceil(base ** (level - 1) - 1e-9), np.ceil(base ** level.astype(float) - 1e-9) - 1
    return np.where(level > 0, (low + np.maximum(low, high)) / 2, 0.0)


def _steps(items: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of the bits of an item at a level."""
    g = mix64(items + np.uint64(level * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))
    return g >> np.uint64(32), g & np.uint64(0xFFFFFFFF) | np.uint64(1)


def _bit(a: np.ndarray, b: np.ndarray, probe_number: int, size: int) -> np.ndarray:
    """The place of one bit of an item: 32 hash bits scaled to the size of the filter."""
    return ((a + np.uint64(probe_number) * b) & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)


def build_filter(items: np.ndarray, count: np.ndarray, base: float) -> np.ndarray:
    level = levels_of(count, base)
    size = max(64, -(-BITS * int(level.sum()) // 64) * 64)
    bits = np.zeros(size, bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        a, b = _steps(items[level >= q], q)
        for i in range(PROBES):
            bits[_bit(a, b, i, size)] = True
    return np.packbits(bits, bitorder="little")


def probe(bits: np.ndarray, items: np.ndarray) -> np.ndarray:
    """The level of each item: probed level by level until a bit is missing."""
    level, left, q = np.zeros(len(items), np.int64), np.arange(len(items)), 1
    while len(left):
        a, b = _steps(items[left], q)
        for i in range(PROBES):
            at = _bit(a, b, i, len(bits) * 8)
            hit = bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
            left, a, b = left[hit], a[hit], b[hit]
        level[left] = q
        q += 1
    return level


def _item(keys: np.ndarray, kind: int) -> np.ndarray:
    """What the filter holds for an n-gram: its short key and its order."""
    return (keys & _KEY) | np.uint64(kind << 48)


@dataclass
class Model:
    """Where the shards are, and the totals of the training texts."""

    folder: str
    shards: int
    order: int
    tokens: int
    vocabulary: int


def train(docs: DataFrame, order: int = 3, base: float = BASE, text_col: str = "text") -> Model:
    """Count the n-grams of all texts; every shard of the filter is built by one task."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    shards = max(1, -(-int(size) // SHARD_BYTES))
    folder = store.new_folder(spark, "lm")

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        items, counts, totals = [], [], [0, 0]
        for kind, rows in frame.groupby("kind"):
            found = [np.frombuffer(k, np.uint64) if kind == 0 else _wide(k) for k in rows["keys"]]
            k, n = _summed(found, [np.frombuffer(c, np.uint32) for c in rows["counts"]])
            if kind == 0:
                totals = [int(n.sum()), len(k)]
                store.put(f"{folder}/words-{key[0]:06d}", blob(k), blob(n))
            items.append(_item(k, abs(kind) - 1 if kind < 0 else kind))
            counts.append(n)
        store.put(f"{folder}/filter-{key[0]:06d}", blob(build_filter(np.concatenate(items), np.concatenate(counts), base)))
        return pd.DataFrame({"shard": [key[0]], "tokens": [totals[0]], "vocabulary": [totals[1]]})

    counted = texts.mapInArrow(_count(order, shards), "shard int, kind int, keys binary, counts binary")
    made = cut(counted.groupBy("shard").applyInPandas(build, "shard int, tokens long, vocabulary long"))
    total = made.agg(F.sum("tokens").alias("n"), F.sum("vocabulary").alias("v"), F.collect_set("shard").alias("have")).first()
    for shard in set(range(shards)) - set(total.have):
        store.put(f"{folder}/filter-{shard:06d}", bytes(8))
    for shard in set(range(shards)) - {r.shard for r in made.where("vocabulary > 0").select("shard").collect()}:
        store.put(f"{folder}/words-{shard:06d}", b"")
    return Model(folder, shards, order, total.n or 0, total.v or 0)


def score(docs: DataFrame, model: Model, base: float = BASE, mu: float = MU, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, n_known, base_score, score): log10 probabilities of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = model.tokens + 0.5 * (model.vocabulary + 1)
        for batch in pieces(batches, limit=3 * PIECE_BYTES // 8):
            t = tokens(batch.column("text"), model.order)
            n = len(t.word)
            vocabulary, exact = np.append(t.hashes, _END), np.zeros(len(t.hashes) + 1, np.int64)
            starts = [history_start(k) for k in range(1, model.order)]
            asked = [vocabulary, *t.keys[1:], np.array(starts, np.uint64)]  # whose counts are needed
            items = [_item(vocabulary, 0), *(_item(k, i + 1) for i, k in enumerate(t.keys[1:])),
                     np.array([int(_item(np.array([k], np.uint64), i)[0]) for i, k in enumerate(starts)], np.uint64)]
            key, item = np.concatenate(asked), np.concatenate(items)
            del asked, items
            level = np.zeros(len(key), np.int32)
            shard = _shard(key, model.shards)
            by = np.argsort(shard, kind="stable")
            edge = np.searchsorted(shard[by], np.arange(model.shards + 1))
            for s in np.flatnonzero(np.diff(edge)).tolist():
                own = by[edge[s]:edge[s + 1]]
                level[own] = probe(np.frombuffer(store.get(f"{model.folder}/filter-{s:06d}"), np.uint8), item[own])
                own = own[own < len(vocabulary)]
                data = store.get(f"{model.folder}/words-{s:06d}")
                known, count = np.frombuffer(data, np.uint64, len(data) // 16), np.frombuffer(data, np.int64, len(data) // 16, len(data) // 2)
                if len(known):
                    at = np.minimum(np.searchsorted(known, vocabulary[own]), len(known) - 1)
                    exact[own] = np.where(known[at] == vocabulary[own], count[at], 0)
            count = expected(np.arange(level.max() + 1), base)[level]
            plain = np.log10((exact + 0.5) / total)[t.word]
            p = ((count[:len(vocabulary)] + 0.5) / total)[t.word]
            grams = [count[:len(vocabulary)][t.word], *np.split(count[len(vocabulary):len(count) - len(starts)], max(1, model.order - 1))]
            for k in range(1, model.order):
                history = np.empty(n)
                history[1:] = grams[k - 1][:-1]
                history[t.first[:-1]] = count[len(count) - len(starts) + k - 1]
                p = (np.minimum(grams[k], history) + mu * p) / (history + mu)
            lines = t.first[:-1]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(np.diff(t.first)), pa.array(np.add.reduceat((exact > 0)[t.word].astype(np.int64), lines)),
                pa.array(np.add.reduceat(plain, lines)), pa.array(np.add.reduceat(np.log10(np.minimum(p, 1.0)), lines)),
            ], [id_col, "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, n_known long, base_score double, score double")


def score_held_out(docs: DataFrame, held_out: Column, order: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents by a model of those that are not held out; adds held_out and train_tokens."""
    held = F.coalesce(held_out, F.lit(False))
    model = train(docs.where(~held), order, text_col=text_col)
    scored = score(docs, model, id_col=id_col, text_col=text_col)
    return scored.withColumn("held_out", held).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
