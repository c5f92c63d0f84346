"""Line dedup: lines found in many documents go, by probing a sharded minimal perfect hash.

The documents of every distinct line are counted on its 128-bit hash. Lines in enough documents are
indexed: each shard holds a minimal perfect hash (bitmaps with ranks, a level for the keys that
collided in all levels before), an array of 64-bit fingerprints and an array of counts. Documents
look their lines up in the arrays; no line is joined or shuffled with its text. Lines in fewer
documents can't be dropped, so they are left out: the index grows with the repeated lines only. A
shard is bounded in size and a worker holds a bounded number of shards at a time.

Cases: a null or empty text is one empty line; keys below ``min_chars`` stay; every row counts as a
document, also an equal one; a document that loses all lines keeps an empty text; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import store
from .common import _IS_SPACE, blob, lower, mix64, pack, pieces, raw

#: keys of one shard, on average
SHARD_KEYS = 200_000
#: shards a worker holds at a time
HELD_SHARDS = 8


# ---------------------------------------------------------------- minimal perfect hash
def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64(level * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    return (mix64(h1 + salt ^ (h2 << np.uint64(1))) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]:
    """Levels (size, bitmap, ranks) and the slot of every key; keys must be distinct."""
    levels, slot, left, used = [], np.zeros(len(h1), np.int64), np.arange(len(h1)), 0
    while len(left):
        if len(levels) == 64:
            raise ValueError("keys are not distinct")
        size = -(-2 * len(left) // 64) * 64
        at = _place(h1[left], h2[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        bitmap = np.packbits(alone, bitorder="little").view(np.uint64)
        ranks = used + np.concatenate([[0], np.cumsum(np.bitwise_count(bitmap))[:-1]]).astype(np.int64)
        fits = alone[at]
        slot[left[fits]] = _rank(bitmap, ranks, at[fits])
        levels.append((size, bitmap, ranks))
        used += int(fits.sum())
        left = left[~fits]
    return levels, slot


def _rank(bitmap: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return ranks[at >> 6] + np.bitwise_count(bitmap[at >> 6] & below)


def find_slots(levels, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Slot of every key, or -1; a key that was not indexed may get any slot."""
    slot, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
    for number, (size, bitmap, ranks) in enumerate(levels):
        at = _place(h1[left], h2[left], number, size)
        hit = (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        slot[left[hit]] = _rank(bitmap, ranks, at[hit])
        left = left[~hit]
    return slot


def pack_shard(h1: np.ndarray, h2: np.ndarray, count: np.ndarray) -> list[bytes]:
    levels, slot = build_hash(h1, h2)
    prints, counts = np.empty(len(h1), np.uint64), np.empty(len(h1), np.uint32)
    prints[slot], counts[slot] = h2, np.minimum(count, 0xFFFFFFFF)
    head = np.array([len(h1), len(levels), *(size for size, *_ in levels)], np.int64)
    return [blob(head), *(blob(x) for _, *parts in levels for x in parts), blob(prints), blob(counts)]


class Shard:
    """The arrays of one shard."""

    def __init__(self, data: bytes):
        keys, n = np.frombuffer(data, np.int64, 2)
        sizes, at, self.levels = np.frombuffer(data, np.int64, n, 16), 16 + 8 * int(n), []
        for size in sizes.tolist():
            words = size // 64
            self.levels.append((size, np.frombuffer(data, np.uint64, words, at), np.frombuffer(data, np.int64, words, at + 8 * words)))
            at += 16 * words
        self.prints = np.frombuffer(data, np.uint64, keys, at)
        self.counts = np.frombuffer(data, np.uint32, keys, at + 8 * int(keys))

    def count(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        slot = find_slots(self.levels, h1, h2)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == h2[ok]
        out = np.zeros(len(h1), np.int64)
        out[ok] = self.counts[slot[ok]]
        return out


@functools.lru_cache(HELD_SHARDS)
def _load(uri: str) -> Shard:
    return Shard(store.get(uri))


# ---------------------------------------------------------------- lines
def line_keys(data: np.ndarray, offsets: np.ndarray, min_chars: int):
    """Byte range and text of every line, the code of its key (-1: too short), and the keys' hashes."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    # a text starts before the break that another text ends with
    owner = np.repeat(np.arange(len(offsets) - 1), np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=len(offsets) - 1) + 1)
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))])
    stop = np.empty(len(start), np.int64)
    stop[:-1] = start[1:] - 1
    stop[first[1:] - 1] = offsets[1:]
    solid = np.flatnonzero(~_IS_SPACE[data])
    low, high = np.searchsorted(solid, start), np.searchsorted(solid, stop)
    full = np.flatnonzero(high > low)
    a, b = solid[low[full]], solid[high[full] - 1] + 1
    if min_chars > 1 and len(full):
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        enough = chars[b] - chars[a] >= min_chars
        full, a, b = full[enough], a[enough], b[enough]
    code = np.full(len(start), -1, np.int64)
    if not len(full):
        return start, stop, first, owner, code, np.zeros((0, 2), np.uint64)
    coded = pack(lower(data), a, b).dictionary_encode()
    code[full] = coded.indices.to_numpy()
    digest = b"".join(xxhash.xxh3_128_digest(x) for x in coded.dictionary.to_pylist())
    return start, stop, first, owner, code, np.frombuffer(digest, np.uint64).reshape(-1, 2)


def _count_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = raw(batch.column("text"))
            _, _, _, owner, code, hashes = line_keys(data, offsets, min_chars)
            keyed = code >= 0
            pairs = np.unique(owner[keyed] * max(1, len(hashes)) + code[keyed])
            n = np.bincount(pairs % max(1, len(hashes)), minlength=len(hashes))
            signed = hashes.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(signed[:, 0])), pa.array(np.ascontiguousarray(signed[:, 1])), pa.array(n.astype(np.int64))], ["h1", "h2", "n"])

    return run


def build_index(docs: DataFrame, min_docs: int, min_chars: int, text_col: str = "text") -> list[str]:
    """URIs of the shards, by shard number, for the lines in at least ``min_docs`` documents."""
    spark = docs.sparkSession
    folder = store.new_folder(spark, "line-index")
    seen = docs.select(F.col(text_col).alias("text")).mapInArrow(_count_lines(min_chars), "h1 long, h2 long, n long")
    counts = cut(seen.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs))
    shards = max(1, -(-counts.count() // SHARD_KEYS))

    def save(key, frame: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (frame[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        store.put(f"{folder}/shard-{key[0]:06d}", *pack_shard(h1, h2, frame["n"].to_numpy()))
        return pd.DataFrame({"shard": [key[0]]})

    made = {r.shard for r in counts.groupBy(F.pmod("h1", F.lit(shards)).cast("int").alias("shard")).applyInPandas(save, "shard int").collect()}
    return [f"{folder}/shard-{i:06d}" if i in made else "" for i in range(shards)]


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_lines, n_dropped, text): every document without the lines of frequent keys.

    A key is the line stripped of white space at both ends, A-Z lower-cased.
    """
    uris = build_index(docs, min_docs, min_chars, text_col)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = raw(batch.column("text"))
            start, stop, first, owner, code, hashes = line_keys(data, offsets, min_chars)
            h1, h2 = np.ascontiguousarray(hashes[:, 0]), np.ascontiguousarray(hashes[:, 1])
            frequent = np.zeros(len(hashes) + 1, bool)  # the last stands for lines without a key
            shard = np.mod(h1.view(np.int64), len(uris))
            for s in np.unique(shard):
                if uris[s]:
                    own = np.flatnonzero(shard == s)
                    frequent[own] = _load(uris[s]).count(h1[own], h2[own]) >= min_docs
            gone = frequent[code]
            dropped = np.bincount(owner[gone], minlength=batch.num_rows)
            whole, kept = data.tobytes(), []
            for d in range(batch.num_rows):
                if not dropped[d]:
                    kept.append(whole[offsets[d]:offsets[d + 1]])
                else:
                    stay = first[d] + np.flatnonzero(~gone[first[d]:first[d + 1]])
                    kept.append(b"\n".join([whole[a:b] for a, b in zip(start[stay].tolist(), stop[stay].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(first)), pa.array(dropped.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())],
                [id_col, "n_lines", "n_dropped", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        drop, f"`{id_col}` {kind}, n_lines long, n_dropped long, text string")
