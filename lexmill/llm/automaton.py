"""Substring dedup on words, by suffix automata of reference shards.

The reference is the corpus itself: one copy of every distinct passage that may repeat in part (see
``passages``), dealt into shards of bounded size by anchor; equal windows have equal anchors, so a
passage only has to be streamed through the shards of its anchor, and the task that builds a
shard's automaton streams them. Passages of an anchor that has more than a shard holds are cut anew
by longer anchors, down to single windows, until each has less; what is alone then is left out, and
windows that then repeat as a whole are settled by their count. Streaming gives the matching statistics: at every
word the longest match that ends there, cut at the window, and how often it occurs; all words of
windows that occur elsewhere go.

Cases: null texts have no words; texts shorter than a window keep all; equal rows count as two
documents, so both lose their windows; a document that loses all words keeps an empty text; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blob, gram_hashes, pieces, raw, row_key, words
from .passages import covered, marks, narrowed, runs, segments

WINDOW, ANCHOR = 35, 8
#: words of one shard of the reference, on average, and of one anchor at most
SHARD_WORDS = 60_000


class SuffixAutomaton:
    """Of the given sequences of non-negative items, with how often every substring occurs."""

    def __init__(self, sequences: list[list[int]], times: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]
        for number, (sequence, n) in enumerate(zip(sequences, times)):
            last = 0
            if number:
                last = self._add(self._last, -number, 0)  # parts sequences; never matched
            for item in sequence:
                last = self._add(last, item, n)
            self._last = last
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def _add(self, last: int, item: int, n: int) -> int:
        follow, link, length, count = self.next, self.link, self.length, self.count
        own = len(length)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        count.append(n)
        state = last
        while state >= 0 and item not in follow[state]:
            follow[state][item] = own
            state = link[state]
        if state < 0:
            return own
        to = follow[state][item]
        if length[to] == length[state] + 1:
            link[own] = to
            return own
        twin = len(length)
        follow.append(dict(follow[to]))
        length.append(length[state] + 1)
        link.append(link[to])
        count.append(0)
        while state >= 0 and follow[state].get(item) == to:
            follow[state][item] = twin
            state = link[state]
        link[to] = link[own] = twin
        return own

    def statistics(self, sequence: list[int], longest: int) -> tuple[list[int], list[int]]:
        """For every item the length of the longest match that ends there, up to ``longest``, and its count."""
        follow, link, length, count = self.next, self.link, self.length, self.count
        state = matched = 0
        sizes, counts = [], []
        for item in sequence:
            while state and item not in follow[state]:
                state = link[state]
                matched = length[state]
            if item in follow[state]:
                state = follow[state][item]
                matched = min(matched + 1, longest)
            while state and length[link[state]] >= matched:
                state = link[state]
            sizes.append(matched)
            counts.append(count[state])
        return sizes, counts


def _hashes(texts: pa.Array, packed: bool) -> tuple[np.ndarray, np.ndarray]:
    """The texts' word hashes in one array and where each text starts; packed texts are such hashes."""
    data, offsets = raw(texts)
    if packed:
        return data.copy().view(np.uint64), offsets // 8
    w = words(data, offsets)
    return w.hashes()[w.code] if len(w.code) else np.zeros(0, np.uint64), w.first


def _segments(window: int, n: int, packed: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hashes, offsets = _hashes(batch.column("text"), packed)
            text, start, many, anchor = segments(gram_hashes(hashes, n), offsets, window, n)
            whole = blob(hashes)
            content = np.fromiter((xxhash.xxh3_64_intdigest(whole[8 * a:8 * b]) for a, b in zip(start.tolist(), (start + many + window - 1).tolist())), np.uint64, len(start))
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(owner) for c in ("k1", "k2", "base")),
                pa.array(start - offsets[text] + batch.column("base").to_numpy()[text]), pa.array(many),
                pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), batch.column("n").take(owner)],
                ["k1", "k2", "base", "start", "windows", "anchor", "content", "n"])

    return run


def _passages(window: int, packed: bool = False):
    """The word hashes of the parts of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hashes, offsets = _hashes(batch.column("text"), packed)
            rows = []
            for first, k1, k2, base, parts in zip(offsets.tolist(), *(batch.column(c).to_pylist() for c in ("k1", "k2", "base", "parts"))):
                for p in parts:
                    a = first + p["start"] - base
                    rows.append((k1, k2, p["start"], p["anchor"], p["content"], p["n"], p["hot"], blob(hashes[a:a + p["windows"] + window - 1])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 6, pa.bool_(), pa.binary()))],
                    ["k1", "k2", "start", "anchor", "content", "n", "hot", "items"])

    return run


def _match(window: int):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["anchor", "content"])
        hashes = [np.frombuffer(x, np.uint64) for x in frame["items"]]
        _, code = np.unique(np.concatenate(hashes), return_inverse=True)
        code = code.tolist()
        stop = np.cumsum([len(h) for h in hashes]).tolist()
        sequences = [code[b - len(h):b] for h, b in zip(hashes, stop)]
        n = frame["n"].tolist()
        automaton = SuffixAutomaton(sequences, n)
        found = []
        for sequence, times, k1, k2, start in zip(sequences, n, *(frame[c].tolist() for c in ("k1", "k2", "start"))):
            if times > 1:
                continue  # repeats as a whole
            sizes, counts = automaton.statistics(sequence, window)
            again = np.array([s == window and c > 1 for s, c in zip(sizes[window - 1:], counts[window - 1:])], bool)
            found += [(k1, k2, start + a, b - a) for a, b in zip(*(x.tolist() for x in runs(again)))]
        return pd.DataFrame(found, columns=["k1", "k2", "start", "windows"]).astype("int64")

    return run


def _remove(window: int, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = raw(batch.column("text"))
            w = words(data, offsets)
            whole, kept, gone = data.tobytes(), [], []
            for a, b, ranges in zip(w.first[:-1].tolist(), w.first[1:].tolist(), batch.column("ranges").to_pylist()):
                stay = a + np.flatnonzero(~marks(ranges, b - a, window))
                gone.append(b - a - len(stay))
                kept.append(b" ".join([whole[x:y] for x, y in zip(w.start[stay].tolist(), w.stop[stay].tolist())]))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(np.diff(w.first)), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                [id_col, "n_words", "n_removed", "text"])

    return run


def dedup_words(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_words, n_removed, text): every document without the windows of words that occur elsewhere."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    whole, parts = narrowed(
        rows.select("k1", "k2", "text"), lambda n, packed: _segments(window, n, packed), lambda packed: _passages(window, packed), window, anchor, SHARD_WORDS)
    size = parts.agg(F.sum(F.octet_length("items") / 8).alias("n")).first().n or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(int(size // SHARD_WORDS) + 1)).alias("shard")
    again = parts.groupBy(shard).applyInPandas(_match(window), "k1 long, k2 long, start long, windows long")
    ranges = covered(whole, again)
    return rows.join(ranges, ["k1", "k2"], "left").select("id", "text", "ranges").mapInArrow(
        _remove(window, id_col), f"`{id_col}` {kind}, n_words long, n_removed long, text string")
