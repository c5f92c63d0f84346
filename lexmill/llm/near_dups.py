"""MinHash near-dedup: many universal hash minima, banding, signature verification, components by stars.

A document's set is its distinct shingles; documents of equal sets are one set, represented by one
row. The signature of a set is the least value of each of many universal hashes ``a * x + b`` over its
shingles; its minima are dealt to bands, and sets whose minima agree in a whole band meet in that
band's bucket. A pair at the threshold misses all buckets with probability ``(1 - 0.8^rows)^bands``, about
3 in a million.

1. Every set of a bucket is paired with the bucket's lowest set. Pairs whose signatures agree in too
   few minima, or whose sizes differ too much, go; the others are confirmed on their full sets.
2. Components of the confirmed links: every larger neighbour of a node moves to the node's lowest
   neighbour (large star), then every smaller one (small star), until nothing moves.
3. A bucket that still holds several components is open. The sets of open buckets that hang together
   are compared, but only pairs of different components whose signatures agree: a few sets in one
   task, more bucket by bucket in pairs of blocks of bounded size. No pair leaves its task; a tree of
   the confirmed links does. So no link between different components is lost, and links inside a
   component, which change nothing, are never looked for.

Shingles are ``n`` words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words are one shingle.

Cases: null and empty texts, and texts without words, have an empty set and are linked with nothing;
equal rows are one set; documents without an id are members of components too, which are named by
their lowest id, null if no member has one; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut, forget
from .common import blob, gram_hashes, lower, mix64, pieces, raw, row_key, words

WORDS, PERCENT = 4, 80
BANDS, ROWS = 32, 5
#: agreeing minima of a pair, of all: 5.6 standard deviations below what the threshold gives
AGREE = 0.62
#: sets, and shingles, of one block; sets of one comparison of signatures; shingles multiplied at a time
BLOCK_SETS, BLOCK_SHINGLES, STRIP, COLUMNS = 2048, 1 << 20, 256, 4096


def shingles(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    data, offsets = raw(texts)
    w = words(lower(data), offsets)
    hashes = w.hashes()[w.code] if len(w.code) else np.zeros(0, np.uint64)
    grams, out = gram_hashes(hashes, n), []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        whole = grams[a:b - n + 1] if b - a >= n else gram_hashes(hashes[a:b], max(1, b - a))
        out.append(np.unique(whole))
    return out


def minima(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(sets, bands * rows) least value of every universal hash. Sets must not be empty."""
    rng = np.random.default_rng(12)
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    out, y = np.empty((len(sets), bands * rows), np.uint32), np.empty_like(x)
    for i in range(bands * rows):
        a, b = rng.integers(0, 1 << 32, 2, dtype=np.uint64).astype(np.uint32)
        np.multiply(x, a | np.uint32(1), out=y)
        np.add(y, b, out=y)
        out[:, i] = np.minimum.reduceat(y, first)
    return out


def band_labels(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(sets, bands) one hash for the minima of each band."""
    label = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands)).copy()
    for part in np.moveaxis(signatures.reshape(len(signatures), bands, -1), 2, 0):
        label = mix64(label * np.uint64(0x9E3779B97F4A7C15) + part)
    return label


def check_bytes(signatures: np.ndarray) -> np.ndarray:
    """The lowest byte of every minimum: unequal minima agree there once in 256 times."""
    return (signatures & np.uint32(255)).astype(np.uint8)


def _signed(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=4 << 20):
            sets = shingles(batch.column("text"), n)
            full = [i for i, s in enumerate(sets) if len(s)]
            ids, labels, checks = ([None] * len(sets) for _ in range(3))
            if full:
                signatures = minima([sets[i] for i in full])
                for i, label, check in zip(full, band_labels(signatures), check_bytes(signatures)):
                    ids[i], labels[i], checks[i] = xxhash.xxh3_128_digest(blob(sets[i])), blob(label), blob(check)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("k1"), batch.column("k2"), pa.array(ids, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(labels, pa.binary()), pa.array(checks, pa.binary())], ["id", "k1", "k2", "set", "n", "labels", "checks"])

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            labels = raw(batch.column("labels"))[0].view(np.int64)
            where = np.repeat(np.arange(batch.num_rows), len(labels) // batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("set").take(pa.array(where)), pa.array(labels)], ["set", "bucket"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose signatures agree."""
    for batch in batches:
        if batch.num_rows:
            a, b = (raw(batch.column(c))[0].reshape(batch.num_rows, -1) for c in ("checks", "hub_checks"))
            good = (a == b).mean(axis=1) >= AGREE
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("set", "hub")], ["set", "hub"])


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """(left, right) sizes of the intersections, as products of 0/1 matrices."""
    both = left + right
    who = np.repeat(np.arange(len(both)), [len(s) for s in both])
    _, column, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    kept = (count > 1)[column]
    who, column = who[kept], (np.cumsum(count > 1) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for a in range(0, int((count > 1).sum()), COLUMNS):
        x, y = np.searchsorted(column, [a, a + COLUMNS])
        one = np.zeros((len(both), COLUMNS), np.float32)
        one[who[x:y], column[x:y] - a] = 1
        out += (one[:len(left)] @ one[len(left):].T).astype(np.int64)
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs (left, right) have ``100 * intersection >= percent * union``."""
    size = [np.array([len(s) for s in side], np.int64) for side in (left, right)]
    inter = common(left, right)
    return 100 * inter >= percent * (size[0][:, None] + size[1] - inter)


def _hub_links(percent: int):
    """Sets (hub, part, set, shingles) against the hub, one row of which every part has."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("set")
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        own = frame["set"].to_numpy() == key[0]
        hub = [s for s, o in zip(sets, own) if o]
        rest = [i for i in range(len(sets)) if not own[i]]
        good = [rest[j] for j in np.flatnonzero(linked(hub, [sets[i] for i in rest], percent)[0])] if hub and rest else []
        return pd.DataFrame({"u": frame["set"].to_numpy()[good], "v": [key[0]] * len(good)})

    return run


def _block_links(percent: int):
    """Links (u, v) that join all sets of two blocks that links join; only agreeing pairs of different components are compared."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["block", "set"]).sort_values(["block", "set"])
        names, component = frame["set"].to_numpy(), pd.factorize(frame["component"])[0]
        left = np.flatnonzero(frame["block"] == key[2])
        right = np.flatnonzero(frame["block"] == key[3])
        checks = np.frombuffer(b"".join(frame["checks"]), np.uint8).reshape(len(frame), -1)
        root, u, v = component.copy(), [], []
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        for s in range(0, len(left), STRIP):
            a = left[s:s + STRIP]
            same = np.zeros((len(a), len(right)), np.int16)
            for i in range(checks.shape[1]):
                same += checks[a, i][:, None] == checks[right, i]
            worth = (same >= AGREE * checks.shape[1]) & (root[a][:, None] != root[right])
            x, y = np.flatnonzero(worth.any(axis=1)), np.flatnonzero(worth.any(axis=0))
            if not len(x):
                continue
            good = linked([sets[i] for i in a[x]], [sets[i] for i in right[y]], percent) & worth[np.ix_(x, y)]
            for i, j in zip(*np.nonzero(good)):
                p, q = a[x[i]], right[y[j]]
                if root[p] != root[q]:
                    root[root == root[p]] = root[q]
                    u.append(names[p])
                    v.append(names[q])
        return pd.DataFrame({"u": u, "v": v})

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (u, v); the component is its lowest node. One write and one sum a half round."""
    links = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = cut(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        forget(links, large)
        links = small
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            heads = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)
        before = now


def near_duplicates(docs: DataFrame, percent: int = PERCENT, n: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, k1, k2, n_shingles, component_id, kept) for all documents.

    ``kept`` marks the documents that have the lowest id of their component.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    signed = cut(rows.mapInArrow(_signed(n), f"id {kind}, k1 long, k2 long, set binary, n long, labels binary, checks binary"))
    sets = cut(signed.where("set IS NOT NULL").groupBy("set").agg(
        F.min(F.struct("k1", "k2")).alias("from"), F.first("n").alias("n"), F.first("labels").alias("labels"), F.first("checks").alias("checks")))

    # pairs of a bucket's lowest set and each other one
    buckets = cut(sets.select("set", "labels").mapInArrow(_buckets, "set binary, bucket long"))
    lowest = buckets.groupBy("bucket").agg(F.min("set").alias("hub"), F.count("*").alias("many")).where("many > 1").select("bucket", "hub")
    shared = cut(buckets.join(lowest, "bucket"))

    # full sets of all that share a bucket, each worked out from one text that has it
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            packed = pa.array([blob(s) for s in shingles(batch.column("text"), n)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("set"), packed], ["set", "shingles"])

    wanted = shared.select("set").distinct().join(sets.select("set", "from"), "set").select("set", "from.k1", "from.k2")
    texts = rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("set", "text")
    content = cut(texts.mapInArrow(take, "set binary, shingles binary"))

    pairs = shared.where("set <> hub").select("set", "hub").distinct()
    facts = sets.select("set", "n", "checks")
    pairs = pairs.join(facts, "set").join(facts.withColumnsRenamed({"set": "hub", "n": "hub_n", "checks": "hub_checks"}), "hub")
    pairs = pairs.where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    pairs = cut(pairs.select("set", "hub", "checks", "hub_checks").mapInArrow(_agreeing, "set binary, hub binary"))
    sized = pairs.join(sets.select("set", "n"), "set")
    parts = sized.groupBy("hub").agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    members = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("set"), "parts").cast("int").alias("part"), "set")
    hubs = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("hub").alias("set"))
    starred = members.unionByName(hubs).join(content, "set")
    links = cut(starred.groupBy("hub", "part").applyInPandas(_hub_links(percent), "u binary, v binary"))
    first = cut(components(links).select(F.col("node").alias("set"), "component"))

    # buckets that still hold several components
    named = shared.join(first, "set", "left").select("bucket", "set", "hub", F.coalesce("component", "set").alias("component"))
    facts = F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("many")
    still = cut(named.groupBy("bucket").agg(*facts).where("low <> high").select("bucket", "many"))
    open_ = cut(named.join(still, "bucket"))
    groups = components(open_.select(F.col("set").alias("u"), F.col("hub").alias("v")))
    groups = cut(groups.select(F.col("node").alias("set"), F.col("component").alias("grp")))
    weights = groups.join(sets.select("set", "n"), "set").groupBy("grp").agg(F.count("*").alias("m"), F.sum("n").alias("size"))
    small = weights.select("grp", ((F.col("m") <= BLOCK_SETS) & (F.col("size") <= BLOCK_SHINGLES)).alias("small"))
    inside = open_.join(groups, "set").join(small, "grp")
    # a small group is one place of one block; of a larger one every open bucket is a place
    place = F.when(F.col("small"), F.lit(0)).otherwise(F.col("bucket")).alias("place")
    placed = cut(inside.select("grp", place, "set", "component").distinct())
    sizes = placed.join(sets.select("set", "n"), "set").groupBy("grp", "place").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = placed.join(sizes, ["grp", "place"]).withColumn("block", F.pmod(F.xxhash64("set"), "blocks").cast("int"))
    full = dealt.join(content, "set").join(sets.select("set", "checks"), "set")
    paired = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    late = paired.groupBy("grp", "place", "low", "high").applyInPandas(_block_links(percent), "u binary, v binary")
    # components of step 2 stay whole: their sets hang on their lowest one
    whole = first.select(F.col("set").alias("u"), F.col("component").alias("v"))
    joined = components(whole.unionByName(late)).select(F.col("node").alias("set"), "component")

    found = signed.select("id", "k1", "k2", "set", "n").where("set IS NOT NULL").join(joined, "set", "left")
    found = cut(found.select("id", "k1", "k2", "n", F.coalesce("component", "set").alias("component")))
    least = cut(found.groupBy("component").agg(F.min("id").alias("component_id")))
    out = found.join(least, "component").select("id", "k1", "k2", F.col("n").alias("n_shingles"), "component_id")
    alone = signed.where("set IS NULL").select("id", "k1", "k2", F.lit(0).cast("long").alias("n_shingles"), F.col("id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)
