"""Shared kernels: whole texts of an Arrow batch as bytes, words, word hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed value: white space between words
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: fixed value: a word
WORD = r"[^\x20\x09-\x0D]+"
#: text bytes worked on at once in a task; longer single texts are taken alone
PIECE_BYTES = 8 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % parts


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns that name a row whatever its id: rows that agree in id and text are alike in every way."""
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("k1"),
        F.xxhash64(F.col(id_col).isNull(), F.col(text_col)).alias("k2"),
    ]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` text bytes (a longer text alone), so memory stays bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in one array and the n+1 places where they start; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


@dataclass
class Words:
    """Words of a slice: byte range of each, first word of each text, and which distinct word each is."""

    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray
    code: np.ndarray
    vocabulary: pa.Array

    def hashes(self) -> np.ndarray:
        """64-bit hash of each distinct word."""
        found = (xxhash.xxh3_64_intdigest(w) for w in self.vocabulary.to_pylist())
        return np.fromiter(found, np.uint64, len(self.vocabulary))


def spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte range of every word, and the n+1 first words of the texts; ``between`` says which bytes part words."""
    word = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = word.copy()
    opens[1:] &= ~word[:-1] | edge[1:-1]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets)


def pack(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Byte ranges, in order and apart, as an Arrow binary array."""
    size = stop - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    mark = np.zeros(len(data) + 1, np.int8)
    mark[start] = 1
    mark[stop] -= 1  # places where ranges end are distinct
    kept = data[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)] if len(start) else data[:0]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))])


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _IS_SPACE) -> Words:
    start, stop, first = spans(data, offsets, between)
    if not len(start):
        return Words(start, stop, first, np.zeros(0, np.int64), pa.array([], pa.large_binary()))
    coded = pack(data, start, stop).dictionary_encode()
    return Words(start, stop, first, coded.indices.to_numpy().astype(np.int64), coded.dictionary)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n items from every place on; places near the end that have fewer are left out."""
    if len(items) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(items) - n + 1, n, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + items[j:len(items) - n + 1 + j]
        out ^= out >> np.uint64(29)
    return mix64(out)


def inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which places have all of their n items in one text."""
    fits = np.zeros(max(0, total - n + 1), bool)
    length = np.diff(first)
    last = np.maximum(first[:-1], first[1:] - n + 1)[length >= n]
    mark = np.zeros(len(fits) + 1, np.int32)
    np.add.at(mark, first[:-1][length >= n], 1)
    np.subtract.at(mark, last, 1)
    return np.cumsum(mark[:-1]).astype(bool) if len(fits) else fits


def blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()
