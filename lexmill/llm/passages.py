"""Passages that may repeat: windows grouped by content-defined anchors.

The anchor of a window is its n-gram of lowest hash, so equal windows have equal anchors at equal
places. Windows in a row with one anchor form a segment. A window can occur twice only among the
segments of its anchor; a segment whose whole content occurs twice is repeated as it is, and only
the segments that share an anchor with others and have a content of their own need a closer look.

Where those of one anchor are more than a task should hold, they are cut anew by longer anchors, at
last by whole windows, so no group grows with how common its anchor is.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut
from .common import inside

#: base is the place of the text in its document, n how often the text occurs as a whole
SEGMENT = "k1 long, k2 long, base long, start long, windows long, anchor long, content long, n long"
PART = "k1 long, k2 long, start long, anchor long, content long, n long, hot boolean, items binary"


def sliding_least(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the lowest gram (of equal ones, the first) in every run of ``width`` grams."""
    n = len(grams)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    full = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:n] = key
    blocks = full.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(after[:m], before[width - 1:width - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(grams: np.ndarray, first: np.ndarray, window: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, windows, anchor) of all segments; ``grams`` has the n-gram hash of every place."""
    total = int(first[-1])
    if total < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    least = sliding_least(grams, window - n + 1)
    fits = inside(first, window, total)
    new = fits.copy()
    new[1:] &= ~fits[:-1] | (least[1:] != least[:-1])
    start = np.flatnonzero(new)
    upto = np.concatenate([[0], np.cumsum(fits)])
    windows = np.diff(np.append(upto[start], upto[-1]))
    return np.searchsorted(first, start, "right") - 1, start, windows, grams[least[start]]


def contested(found: DataFrame, window: int, limit: int | None) -> tuple[DataFrame, DataFrame]:
    """Split segments, columns SEGMENT, into what repeats as a whole and what needs a closer look.

    First (k1, k2, start, windows): segments whose content occurs again. Second (k1, k2, base, parts):
    one place of every distinct content under anchors that have several, of which some occur once;
    each part has start, windows, anchor, content, n, its number of occurrences, and hot: whether the
    anchor's parts have more than ``limit`` items. A row of the second has the parts of one text, so
    it is bounded by that text.
    """
    kinds = cut(found.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "base", "start", "windows")).alias("at")))
    items = F.sum(F.col("at.windows") + (window - 1))
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"), items.alias("items")).where("kinds > 1 AND least = 1")
    hot = F.lit(False) if limit is None else F.col("items") > limit
    twice = kinds.where("n > 1").select("anchor", "content")
    whole = found.where("n = 1").join(twice, ["anchor", "content"], "left_semi").select("k1", "k2", "start", "windows")
    odd = kinds.join(anchors.select("anchor", hot.alias("hot")), "anchor").select("anchor", "content", "n", "hot", "at.*")
    part = F.struct("start", "windows", "anchor", "content", "n", "hot")
    return whole, odd.groupBy("k1", "k2", "base").agg(F.collect_list(part).alias("parts"))


def narrowed(texts: DataFrame, find: Callable, take: Callable, window: int, n: int, limit: int, unit: int = 1) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, start, windows) of all that repeats as a whole, and PART rows, at most ``limit`` items an anchor.

    ``texts`` has k1, k2 and text. ``find(n, packed)`` makes SEGMENT rows of texts by anchors of ``n``
    items, a multiple of ``unit``, ``take(packed)`` PART rows; ``packed`` texts are items of PART.
    A part of a hot anchor is a text of the next round. Anchors of whole windows leave nothing over.
    """
    texts, packed = texts.withColumns({"base": F.lit(0).cast("long"), "n": F.lit(1).cast("long")}), False
    whole = parts = None
    while True:
        again, odd = contested(cut(texts.mapInArrow(find(n, packed), SEGMENT)), window, limit if n < window else None)
        own = cut(texts.join(odd, ["k1", "k2", "base"]).mapInArrow(take(packed), PART))
        whole = again if whole is None else whole.unionByName(again)
        parts = own.where("NOT hot") if parts is None else parts.unionByName(own.where("NOT hot"))
        if n >= window or own.where("hot").isEmpty():
            return whole, parts
        texts, packed = own.where("hot").select("k1", "k2", F.col("start").alias("base"), "n", F.col("items").alias("text")), True
        longer = (window - (window - n) // 8) // unit * unit
        n = longer if longer > n else window


def covered(*ranges: DataFrame) -> DataFrame:
    """(k1, k2, ranges): all (start, windows) of a document together; bounded by the document."""
    every = ranges[0]
    for more in ranges[1:]:
        every = every.unionByName(more)
    return every.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "windows")).alias("ranges"))


def marks(ranges: pa.Array, size: int, window: int) -> np.ndarray:
    """Which of ``size`` items the windows of one document cover."""
    edge = np.zeros(size + 1, np.int64)
    if ranges is not None and len(ranges):
        start = np.array([r["start"] for r in ranges])
        np.add.at(edge, start, 1)
        np.subtract.at(edge, start + np.array([r["windows"] for r in ranges]) + window - 1, 1)
    return np.cumsum(edge[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the runs of true flags."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
