"""Token ids in files of directly addressable codes.

A file holds the ids of a run of documents. Every id is split into chunks of 8 bits, lowest first;
level 0 has one chunk for each id, level 1 one for each id that needs a second chunk, and so on.
Beside the chunks, a level has a bitmap that says which of its ids go on, and a directory of ranks
(ids that go on before every 512-bit block), so the place of an id's next chunk is one lookup away:
any id is read with a few bytes from each level and no block is ever decoded.

Layout, little endian: ``DACF`` | version, levels: u32 | ids, documents: u64 | per level, entries:
u64 | document ids: i64 | document id present: u8 | document starts: u64 (documents + 1) | levels:
chunks u8, bitmap of ceil(entries / 512) * 64 bytes, ranks u64 (one for each block).

Cases: a null text is an empty one and has the end id alone; documents of one id are ordered by
text; documents without an id come first; equal rows are all kept; an empty table gives no files.
"""

from __future__ import annotations

import functools
import json
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut
from . import store
from .common import _IS_SPACE, pack, pieces, raw

MAGIC, BITS, BLOCK = b"DACF", 8, 512
#: ids in one file, at least, before the next file begins
FILE_IDS = 4 << 20


# ---------------------------------------------------------------- codes
def encode_file(ids: np.ndarray, starts: np.ndarray, doc_ids: np.ndarray, present: np.ndarray) -> list[bytes]:
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >= (1 << BITS)
        bitmap = np.zeros(-(-len(rest) // BLOCK) * BLOCK, bool)
        bitmap[:len(rest)] = more
        counts = bitmap.reshape(-1, BLOCK).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([np.zeros(min(1, len(counts)), np.uint64), np.cumsum(counts)[:-1].astype(np.uint64)])
        levels.append((len(rest), (rest & 255).astype(np.uint8), np.packbits(bitmap, bitorder="little"), ranks))
        rest = rest[more] >> BITS
        if not len(rest):
            break
    head = MAGIC + struct.pack("<IIQQ", 1, len(levels), len(ids), len(doc_ids)) + b"".join(struct.pack("<Q", n) for n, *_ in levels)
    body = [doc_ids.astype("<i8").tobytes(), present.astype(np.uint8).tobytes(), starts.astype("<u8").tobytes()]
    return [head, *body, *(x.tobytes() for _, *parts in levels for x in parts)]


class TokenFile:
    """Random access to a file through ranged reads."""

    def __init__(self, uri: str):
        self.read = store.Ranges(uri)
        head = self.read(0, 28)
        if head[:4] != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        _, levels, self.ids, self.documents = struct.unpack("<IIQQ", head[4:])
        entries = struct.unpack(f"<{levels}Q", self.read(28, 8 * levels))
        at = self.at_docs = 28 + 8 * levels
        self.at_present = at + 8 * self.documents
        self.at_starts = self.at_present + self.documents
        at = self.at_starts + 8 * (self.documents + 1)
        self.levels = []
        for n in entries:
            blocks = -(-n // BLOCK)
            self.levels.append((n, at, at + n, at + n + blocks * BLOCK // 8))
            at += n + blocks * BLOCK // 8 + 8 * blocks

    def directory(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        docs = np.frombuffer(self.read(self.at_docs, 8 * self.documents), "<i8")
        present = np.frombuffer(self.read(self.at_present, self.documents), np.uint8).astype(bool)
        starts = np.frombuffer(self.read(self.at_starts, 8 * (self.documents + 1)), "<u8").astype(np.int64)
        return docs, present, starts

    def _rank(self, level: int, place: int) -> int:
        _, _, bitmap, ranks = self.levels[level]
        block = place // BLOCK
        before = struct.unpack("<Q", self.read(ranks + 8 * block, 8))[0]
        bits = int.from_bytes(self.read(bitmap + block * BLOCK // 8, BLOCK // 8), "little")
        return before + (bits & ((1 << (place - block * BLOCK)) - 1)).bit_count()

    def token(self, place: int) -> int:
        """The id at a place of the file."""
        if not 0 <= place < self.ids:
            raise IndexError(place)
        value = 0
        for level, (_, chunks, bitmap, _) in enumerate(self.levels):
            value |= self.read(chunks + place, 1)[0] << (BITS * level)
            if not self.read(bitmap + place // 8, 1)[0] >> (place % 8) & 1:
                return value
            place = self._rank(level, place)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range; every level is read from the rank of its first id on."""
        out = np.zeros(max(0, stop - start), np.uint32)
        if stop <= start:
            return out
        where, place, size = np.arange(stop - start), start, stop - start
        for level, (_, chunks, bitmap, _) in enumerate(self.levels):
            out[where] |= np.frombuffer(self.read(chunks + place, size), np.uint8).astype(np.uint32) << np.uint32(BITS * level)
            low = place // 8
            bits = np.unpackbits(np.frombuffer(self.read(bitmap + low, -(-(place + size) // 8) - low), np.uint8), bitorder="little")
            more = bits[place - 8 * low:place - 8 * low + size].astype(bool)
            where = where[more]
            if not len(where):
                break
            place, size = self._rank(level, place), len(where)
        return out

    def close(self) -> None:
        self.read.close()


# ---------------------------------------------------------------- tokenizer
#: white space and these marks never belong to one part of the split pattern with a letter before them
MARKS = b".,;:!?)"
#: distinct parts a worker remembers
CACHE = 150_000


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _cuttable(path: str) -> bool:
    """Whether the rules of ``_cuts`` and ``_words_only`` hold: plain byte-level pairs without a normaliser, and no token that a cut could part."""
    tokenizer = _tokenizer(path)
    plan = json.loads(tokenizer.to_str())
    split, model = plan.get("pre_tokenizer") or {}, plan["model"]
    byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    tokens = tokenizer.get_added_tokens_decoder().values()
    parted = any(set(t.content.encode()) & {*b" \t\n\v\f\r", *MARKS} or t.lstrip or t.rstrip or t.single_word for t in tokens)
    return byte_level and plain and plan.get("normalizer") is None and plan.get("truncation") is None and plan.get("padding") is None and not parted


@functools.cache
def _seen(path: str) -> dict[bytes, bytes]:
    return {}


@functools.cache
def _byte_letters() -> dict[int, str]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a text may be cut without a change to its ids.

    A byte-level vocabulary splits texts by a pattern no part of which goes from other characters on
    to white space, or from a letter on to a mark. A byte that may end a white space character
    beyond ASCII doesn't count as another character.
    """
    space = _IS_SPACE[data]
    before = data[:-1]
    opens = np.zeros(len(data), bool)
    opens[1:] = space[1:] & ~space[:-1] & (before > 0x20)
    at = np.flatnonzero(opens[1:] & (before >= 0x80)) + 1
    if len(at):
        doubt = (data[np.maximum(at - 2, 0)] == 0xC2) | np.isin(data[np.maximum(at - 3, 0)], (0xE1, 0xE2, 0xE3))
        opens[at[doubt]] = False
    opens[1:] |= _IS_LETTER[before] & _IS_MARK[data[1:]]
    opens[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(opens)


_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(MARKS)] = True
#: second byte of a two-byte letter U+00C0 to U+00FF
_IS_SECOND = np.zeros(256, bool)
_IS_SECOND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True


def _words_only(parts: pa.Array) -> np.ndarray:
    """Which parts are letters only, after at most one space: one part of the split pattern each."""
    data, offsets = raw(parts)
    letter = _IS_LETTER[data]
    pair = (data[:-1] == 0xC3) & _IS_SECOND[data[1:]]
    letter[:-1] |= pair
    letter[1:] |= pair
    n = np.add.reduceat(letter.astype(np.int64), offsets[:-1])
    return (n > 0) & (n + (data[offsets[:-1]] == 0x20) == np.diff(offsets))


def _encode_parts(parts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the parts one after the other, and how many each has.

    Words go to the tokenizer's model at once; everything else takes its whole way.
    """
    tokenizer, seen = _tokenizer(path), _seen(path)
    keys = parts.to_pylist()
    found = list(map(seen.get, keys))
    new = np.array([v is None for v in found])
    word = _words_only(parts) if _cuttable(path) else np.zeros(len(keys), bool)
    letters, tokenize = _byte_letters(), tokenizer.model.tokenize
    for i in np.flatnonzero(new & word).tolist():
        found[i] = array("I", [t.id for t in tokenize(keys[i].decode("latin-1").translate(letters))]).tobytes()
    rest = np.flatnonzero(new & ~word).tolist()
    for i, e in zip(rest, tokenizer.encode_batch_fast([keys[i].decode() for i in rest], add_special_tokens=False)):
        found[i] = array("I", e.ids).tobytes()
    for i in np.flatnonzero(new)[:max(0, CACHE - len(seen))].tolist():
        if len(keys[i]) < 64:
            seen[keys[i]] = found[i]
    return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4


def token_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, each text followed by the end id, and the n+1 places where they start.

    Equal parts of texts are encoded once for each slice; with a tokenizer whose texts can't be cut,
    a part is a whole text.
    """
    data, offsets = raw(texts)
    at = _cuts(data, offsets) if _cuttable(path) else offsets[:-1][np.diff(offsets) > 0]
    n = len(offsets) - 1
    if not len(at):
        return np.full(n, end_id, np.uint32), np.arange(n + 1)
    coded = pack(data, at, np.append(at[1:], len(data))).dictionary_encode()
    code = coded.indices.to_numpy()
    flat, lengths = _encode_parts(coded.dictionary, path)
    begin = np.cumsum(lengths) - lengths
    size = lengths[code]
    upto = np.concatenate([[0], np.cumsum(size)])
    part_of_text = np.searchsorted(at, offsets)
    starts = upto[part_of_text] + np.arange(n + 1)
    total = int(upto[-1])
    out = np.full(total + n, end_id, np.uint32)
    text_of_part = np.searchsorted(part_of_text, np.arange(len(at)), "right") - 1
    out[np.arange(total) + np.repeat(text_of_part, size)] = flat[np.repeat(begin[code] - upto[:-1], size) + np.arange(total)]
    return out, starts


# ---------------------------------------------------------------- jobs
def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all documents in ascending id order into token files; returns the manifest.

    The manifest, (uri, place, documents, ids, base), is kept in the shared folder; ``base`` counts
    the ids of all files before. The tokenizer's files must be installed on every worker.
    """
    spark = docs.sparkSession
    folder = folder or store.new_folder(spark, "tokens")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids = np.concatenate([x[0] for x in held])
            base = np.cumsum([0, *(len(x[0]) for x in held)])
            starts = np.concatenate([*(x[1][:-1] + b for x, b in zip(held, base)), base[-1:]])
            uri = f"{folder}/part-{part:06d}-{number:04d}.dac"
            store.put(uri, *encode_file(ids, starts, np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])))
            row = pa.RecordBatch.from_pydict({"uri": [uri], "part": [part], "number": [number], "documents": [len(starts) - 1], "ids": [len(ids)]}, schema=_MANIFEST)
            held.clear()
            number += 1
            return row

        for batch in pieces(batches, "text", 4 << 20):
            ids, starts = token_ids(batch.column("text"), tokenizer_path, end_id)
            doc = batch.column("id")
            held.append((ids, starts, pc.fill_null(doc, 0).to_numpy(zero_copy_only=False), pc.is_valid(doc).to_numpy(zero_copy_only=False)))
            if sum(len(x[0]) for x in held) >= FILE_IDS:
                yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")
    files = cut(ordered.mapInArrow(save, _MANIFEST_SQL))
    order = Window.partitionBy(F.lit(0)).orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0))).select("uri", "part", "number", "documents", "ids", "base")


_MANIFEST = pa.schema([("uri", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64())])
_MANIFEST_SQL = "uri string, part int, number int, documents long, ids long"


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32), read from the files; one task for each few files."""

    def load(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri, base in zip(frame.uri, frame.base):
                file = TokenFile(uri)
                docs, present, starts = file.directory()
                step = max(1, len(docs) // max(1, file.ids // (1 << 20)))
                for a in range(0, len(docs), step):
                    b = min(len(docs), a + step)
                    ids = file.slice(int(starts[a]), int(starts[b])).astype("<u4")
                    at = starts[a:b + 1] - starts[a]
                    crc = [zlib.crc32(ids[x:y]) for x, y in zip(at[:-1], at[1:])]
                    yield pd.DataFrame({
                        "doc_id": pd.array(np.where(present[a:b], docs[a:b], 0), "Int64").copy() if present[a:b].all() else pd.array([int(d) if p else None for d, p in zip(docs[a:b], present[a:b])], "Int64"),
                        "start": starts[a:b] + base, "n_tokens": np.diff(starts[a:b + 1]), "ids_crc32": np.array(crc, np.int64)})
                file.close()

    spread = manifest.select("uri", "base").repartition(max(1, manifest.count()), "uri")
    return spread.mapInPandas(load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, ids): whole documents, read back from the files."""

    def load(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri in frame.uri:
                file = TokenFile(uri)
                docs, present, starts = file.directory()
                for d, p, a, b in zip(docs, present, starts[:-1], starts[1:]):
                    yield pd.DataFrame({"doc_id": pd.array([int(d) if p else None], "Int64"), "ids": [file.slice(int(a), int(b)).astype(np.int64)]})
                file.close()

    return manifest.select("uri").repartition(max(1, manifest.count()), "uri").mapInPandas(load, "doc_id long, ids array<long>")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
