"""Positional full-text index: postings as delta-coded blocks with skip entries and word places.

Texts are cut into zones of bounded size. Within a zone a document is a place number, and each token
has one row: the documents that hold it, how often, and at which word places, as three streams of
variable-length differences. Every ``block`` documents a skip entry names the first document and where
the streams go on, so a search that already knows its candidates decodes only the blocks they fall in.

The rows are written sorted by token into folders by token bucket. A search names its tokens, so it
reads the folders of their buckets, and of those the row groups that hold the tokens; the streams are
joined only for zones that can answer. A zone is answered by one task, whatever the token's frequency:
a token with a third of all documents has one row a zone and is never gathered.

Tokens are those of ``filters.tokens``. Null texts have none. Rows may share keys; they are documents of
their own until the keys are returned, which is once each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .filters import tokens
from .lineage import ensure_checkpoint_dir, forget

#: documents between two skip entries, tokens of a zone, folders, tokens named in a filter
BLOCK, ZONE_TOKENS, BUCKETS, NAMED = 128, 2_000_000, 64, 1_000
_POSTINGS = "token string, bucket int, zone long, n_docs int, n_words int, skips binary, docs binary, counts binary, places binary"


# --- variable-length numbers ------------------------------------------------------------

def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n+1 offsets): seven bits a byte, low ones first, the last byte of a number below 128."""
    size = np.ones(len(values), np.int64)
    for bits in range(7, 42, 7):
        size += values >= 1 << bits
    offsets = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(offsets[-1], np.uint8)
    for i in range(int(size.max(initial=0))):
        left = np.flatnonzero(size > i)
        out[offsets[left] + i] = (values[left] >> (7 * i) & 127) | np.where(size[left] > i + 1, 128, 0)
    return out, offsets


def unpacked(data: np.ndarray) -> np.ndarray:
    last = data < 128
    number = np.cumsum(last) - last
    start = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1]) if len(data) else np.zeros(0, np.int64)
    shift = 7 * (np.arange(len(data)) - start[number])
    out = np.zeros(int(last.sum()), np.int64)
    np.add.at(out, number, (data & 127).astype(np.int64) << shift)
    return out


# --- writing -----------------------------------------------------------------------------

def _steps(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Differences to the value before; values at ``first`` as they are."""
    out = values.copy()
    out[1:] -= values[:-1]
    out[first] = values[first]
    return out


def zone_postings(codes: np.ndarray, docs: np.ndarray, places: np.ndarray, size: int = BLOCK) -> dict[str, np.ndarray | pa.Array]:
    """Streams of every token (by code) of a zone; the occurrences come by document and place."""
    order = np.argsort(codes.astype(np.int32), kind="stable")
    codes, docs, places = codes[order], docs[order], places[order]
    opens = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(docs, prepend=-1) != 0))  # postings
    counts, doc, code = np.diff(opens, append=len(codes)), docs[opens], codes[opens]
    token = np.flatnonzero(np.diff(code, prepend=-1) != 0)  # first posting of a token
    nth = np.arange(len(opens)) - np.repeat(token, np.diff(token, append=len(opens)))
    block = np.flatnonzero(nth % size == 0)
    streams = [packed(_steps(doc, block)), packed(counts), packed(_steps(places, opens))]
    at = [s[1] for s in streams]
    at[2] = at[2][np.concatenate([opens, [len(codes)]])]  # of postings, not of words
    edge = np.concatenate([token, [len(opens)]])
    base = np.repeat(token, np.diff(edge))[block]
    skips = np.stack([doc[block], *(a[block] - a[base] for a in at)], axis=1).astype(np.uint32)
    skip_edge = np.searchsorted(block, edge)
    docs_, counts_, places_ = (_slices(data, a[edge]) for (data, _), a in zip(streams, at))
    return {
        "code": code[token], "n_docs": np.diff(edge), "n_words": np.add.reduceat(counts, token) if len(token) else counts,
        "skips": _slices(skips.view(np.uint8).ravel(), 16 * skip_edge), "docs": docs_, "counts": counts_, "places": places_}


def _slices(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes between neighbouring edges, without copying them."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _zones(keys: Sequence[str], zone_tokens: int, block: int):
    """Rows of both kinds: documents (zone, place, keys) and postings (token, zone, streams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            words = batch.column("words")
            start = words.offsets.to_numpy().astype(np.int64)
            start = start - start[0]
            flat = words.flatten()
            a = 0
            while a < batch.num_rows:  # a document of more tokens than a zone is one alone
                b = max(a + 1, int(np.searchsorted(start, start[a] + zone_tokens, "right")) - 1)
                b = min(b, batch.num_rows)
                n = np.diff(start[a:b + 1])
                part = flat.slice(start[a], start[b] - start[a]).dictionary_encode()
                found = zone_postings(
                    part.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(b - a), n),
                    np.arange(start[b] - start[a]) - np.repeat(start[a:b] - start[a], n), block)
                m = len(found["code"])
                none = {name: pa.nulls(b - a, kind) for name, kind in _KINDS.items()}
                rows = {**none, "zone": pa.array(np.full(b - a, number)), "place": pa.array(np.arange(b - a, dtype=np.int32)),
                        **{k: batch.column(batch.schema.get_field_index(k)).slice(a, b - a) for k in keys}}
                yield pa.RecordBatch.from_pydict({"is_doc": pa.array(np.ones(b - a, bool)), **rows})
                if m:
                    rows = {"token": part.dictionary.take(pa.array(found["code"])), "zone": pa.array(np.full(m, number)), "place": pa.nulls(m, pa.int32()),
                            **{c: pa.array(found[c].astype(np.int32)) for c in ("n_docs", "n_words")},
                            **{c: found[c] for c in ("skips", "docs", "counts", "places")},
                            **{k: pa.nulls(m, batch.schema.field(k).type) for k in keys}}
                    yield pa.RecordBatch.from_pydict({"is_doc": pa.array(np.zeros(m, bool)), **{c: rows[c] for c in [*_KINDS, "zone", "place", *keys]}})
                number += 1
                a = b

    return run


_KINDS = {"token": pa.string(), "n_docs": pa.int32(), "n_words": pa.int32(), **{c: pa.binary() for c in ("skips", "docs", "counts", "places")}}


@dataclass
class TextIndex:
    """``docs``: zone, place and keys of every document; ``postings``: one row for each token and zone."""

    docs: DataFrame
    postings: DataFrame
    keys: list[str]
    block: int = BLOCK


def bucket(token: Column | str) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def write_index(texts: DataFrame, keys: Sequence[str], path: str | None = None, column: str = "text", zone_tokens: int = ZONE_TOKENS, block: int = BLOCK) -> TextIndex:
    """Index the texts under ``path``, by default a new folder in the shared one."""
    spark, keys = texts.sparkSession, list(keys)
    if path is None:
        ensure_checkpoint_dir(spark)
        path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/index-{uuid.uuid4().hex}"
    words = texts.select(*keys, F.coalesce(tokens(column), F.array().cast("array<string>")).alias("words"))
    kinds = ", ".join(f"`{k}` {words.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"is_doc boolean, token string, n_docs int, n_words int, skips binary, docs binary, counts binary, places binary, zone long, place int, {kinds}"
    # both kinds come from one pass, written once: zones are numbered by that pass alone
    words.mapInArrow(_zones(keys, zone_tokens, block), schema).write.partitionBy("is_doc").parquet(f"{path}/raw")
    raw = spark.read.schema(schema).parquet(f"{path}/raw")
    raw.where("is_doc").select("zone", "place", *keys).write.parquet(f"{path}/docs")
    rows = raw.where("NOT is_doc").withColumn("bucket", bucket("token")).select(*[c.split()[0] for c in _POSTINGS.split(", ")])
    # by range, so that a frequent token's rows are dealt to several tasks
    rows.repartitionByRange("bucket", "token", "zone").sortWithinPartitions("bucket", "token", "zone").write.partitionBy("bucket").parquet(f"{path}/postings")
    raw._cut_path = f"{path}/raw"
    forget(raw)
    return open_index(spark, path, keys, block)


def open_index(spark: SparkSession, path: str, keys: Sequence[str], block: int = BLOCK) -> TextIndex:
    return TextIndex(spark.read.parquet(f"{path}/docs"), spark.read.schema(_POSTINGS).parquet(f"{path}/postings"), list(keys), block)


def frequencies(index: TextIndex) -> DataFrame:
    """Rows (token, keys, frequency): the postings spelled out, without their places."""
    size = index.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_docs").to_numpy().astype(np.int64)
            step, count = (unpacked(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)) for c in ("docs", "counts"))
            row = np.repeat(np.arange(len(n)), n)
            block = np.flatnonzero((np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) % size == 0)
            total = np.cumsum(step)
            doc = total - np.repeat(total[block] - step[block], np.diff(block, append=len(row)))
            yield pa.RecordBatch.from_pydict({
                "token": batch.column("token").take(pa.array(row)), "zone": batch.column("zone").take(pa.array(row)),
                "place": pa.array(doc.astype(np.int32)), "frequency": pa.array(count)})

    rows = index.postings.select("token", "zone", "n_docs", "docs", "counts").mapInArrow(run, "token string, zone long, place int, frequency long")
    return rows.join(index.docs, ["zone", "place"]).groupBy("token", *index.keys).agg(F.sum("frequency").alias("frequency"))


# --- reading -----------------------------------------------------------------------------

class Postings:
    """Postings of a token in a zone. ``decoded`` counts the documents that were decoded."""

    def __init__(self, skips: bytes, docs: bytes, counts: bytes, places: bytes):
        self.skips = np.frombuffer(skips, np.uint32).reshape(-1, 4).astype(np.int64)
        self.streams = [np.frombuffer(s, np.uint8) for s in (docs, counts, places)]
        self.ends = np.vstack([self.skips[1:, 1:], [len(s) for s in self.streams]])
        self.decoded = 0

    def part(self, stream: int, block: int) -> np.ndarray:
        return unpacked(self.streams[stream][self.skips[block, 1 + stream]:self.ends[block, stream]])

    def blocks(self, wanted: np.ndarray | None) -> np.ndarray:
        """Blocks that can hold one of the wanted documents (ascending), by the skip entries."""
        if wanted is None:
            return np.arange(len(self.skips))
        block = np.searchsorted(self.skips[:, 0], wanted, "right") - 1
        return np.unique(block[block >= 0])

    def documents(self, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, occurrences), of the wanted ones or of all."""
        doc, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in self.blocks(wanted):
            doc.append(np.cumsum(self.part(0, b)))
            count.append(self.part(1, b))
            self.decoded += len(doc[-1])
        doc, count = np.concatenate(doc), np.concatenate(count)
        if wanted is not None:
            kept = np.isin(doc, wanted)
            doc, count = doc[kept], count[kept]
        return doc, count

    def words(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, word place) of every occurrence in the wanted documents."""
        out = [(np.zeros(0, np.int64),) * 2]
        for b in self.blocks(wanted):
            doc, count, step = np.cumsum(self.part(0, b)), self.part(1, b), self.part(2, b)
            first = np.cumsum(count) - count
            total = np.cumsum(step)
            place = total - np.repeat(total[first] - step[first], count)
            doc = np.repeat(doc, count)
            kept = np.isin(doc, wanted)
            out.append((doc[kept], place[kept]))
        return tuple(np.concatenate(x) for x in zip(*out))


def matching(found: dict[str, Postings], words: Sequence[str], mode: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents, distinct tokens they hold, their occurrences) that answer a query in a zone; ``mode`` is any, all or phrase."""
    wanted = list(dict.fromkeys(words))
    none = (np.zeros(0, np.int64),) * 3
    if mode == "any":
        parts = [found[w].documents() for w in wanted if w in found]
        if not parts:
            return none
        doc, where = np.unique(np.concatenate([d for d, _ in parts]), return_inverse=True)
        return doc, np.bincount(where, minlength=len(doc)), np.bincount(where, np.concatenate([c for _, c in parts]), len(doc)).astype(np.int64)
    if not wanted or any(w not in found for w in wanted):
        return none
    doc, score = None, {}
    for w in sorted(wanted, key=lambda w: len(found[w].streams[0])):  # the rarest first: later ones decode only its blocks
        doc, count = found[w].documents(doc)
        score[w] = dict(zip(doc.tolist(), count.tolist()))
    if mode == "phrase" and len(words) > 1:
        runs = None
        for i, w in enumerate(words):
            d, place = found[w].words(doc)
            start = (d << 32) + place - i + len(words)  # places before the text's first word stay apart from other documents
            runs = start if runs is None else np.intersect1d(runs, start)
        doc = np.unique((runs - len(words)) >> 32) if len(runs) else doc[:0]
    return doc, np.full(len(doc), len(wanted)), np.array([sum(s[d] for s in score.values()) for d in doc.tolist()], np.int64)


def search(index: TextIndex, queries: DataFrame) -> DataFrame:
    """Rows (query_id, keys, terms, score) that answer ``queries`` (query_id, mode, words).

    ``mode`` is any, all (every token somewhere) or phrase (one after the other). ``terms`` counts the
    distinct tokens of the query in the document, ``score`` their occurrences. Queries without words
    have no answer.
    """
    kind = queries.schema["query_id"].dataType.simpleString()
    asked = queries.select("query_id", "mode", F.transform("words", F.lower).alias("words")).where(F.size("words") > 0)
    parts = asked.select("query_id", "mode", F.size(F.array_distinct("words")).alias("need"), F.explode(F.array_distinct("words")).alias("token"))
    parts = parts.withColumn("bucket", bucket("token"))
    postings = index.postings
    named = [r.token for r in parts.select("token").distinct().limit(NAMED + 1).collect()]
    if len(named) <= NAMED:  # few enough to be named in the scan: other folders and row groups are not read
        folders = [r.bucket for r in parts.select("bucket").distinct().collect()]
        postings = postings.where(F.col("bucket").isin(folders) & F.col("token").isin(named))
    # zones that can answer are found without the streams
    can = postings.select("token", "bucket", "zone").join(parts, ["bucket", "token"]).groupBy("query_id", "mode", "need", "zone").agg(F.count("*").alias("have"))
    can = can.where((F.col("mode") == "any") | (F.col("have") == F.col("need"))).join(asked.select("query_id", "words"), "query_id")
    zones = can.select(F.col("query_id").alias("name"), F.col("mode").alias("how"), F.col("words").alias("asked"), F.col("zone").alias("at"))
    streams = postings.select("token", "bucket", "zone", "skips", "docs", "counts", "places").join(parts.select("bucket", "token", "query_id"), ["bucket", "token"])

    def answer(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q in left.itertuples(index=False):
            mine = right[right["query_id"] == q.name]
            found = {r.token: Postings(r.skips, r.docs, r.counts, r.places) for r in mine.itertuples(index=False)}
            doc, terms, score = matching(found, list(q.asked), q.how)
            out += [(q.name, key[0], *row) for row in zip(doc.tolist(), terms.tolist(), score.tolist())]
        return pd.DataFrame(out, columns=["query_id", "zone", "place", "terms", "score"], dtype=None if out else object)

    hits = zones.groupBy("at").cogroup(streams.groupBy("zone")).applyInPandas(answer, f"query_id {kind}, zone long, place int, terms long, score long")
    rows = hits.join(index.docs, ["zone", "place"])
    return rows.groupBy("query_id", *index.keys).agg(F.max("terms").alias("terms"), F.max("score").alias("score"))


def ask(spark: SparkSession, **queries: tuple[str, Sequence[str]]) -> DataFrame:
    """A table of queries from ``name=(mode, words)``."""
    return spark.createDataFrame([(n, m, list(w)) for n, (m, w) in queries.items()], "query_id string, mode string, words array<string>")
