"""Suffix-array dedup on bytes, by a distributed merge sort that knows common prefixes.

Which suffixes have to be sorted, and how far, is found first (the distinguishing prefixes): windows
of bytes are grouped by anchors (see ``passages``), segments that repeat as a whole are settled (an
anchor with more than a task holds is split by longer ones, so first windows are bounded too), and of the others only suffixes stay whose first window has the fingerprint of another one. Neighbouring
suffixes with neighbouring twins are one string, as long as all their windows together.

Every task sorts its strings into one run per target, front-coded: the length of the prefix shared
with the string before, and the rest. Runs are exchanged by the fingerprint of the first window, so
equal windows meet. The target merges its runs with a loser tree whose nodes remember how much of
their string equals the last one put out: strings are compared from there on, and not at all where
these numbers differ. Two neighbours of the merged order that share a window or more are equal there;
fingerprints alone decide nothing.

Cases: a null text has no bytes; texts shorter than a window keep all; equal rows count as two
documents, so both lose their windows; kept bytes need not be whole characters; a document that
loses all keeps no bytes; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, pieces, raw, row_key
from .passages import covered, marks, narrowed, runs, segments

WINDOW, ANCHOR = 400, 32
#: bytes of segments one task looks through, on average, and of one anchor at most; bytes of strings one target merges
TASK_BYTES, TARGET_BYTES = 4 << 20, 8 << 20
PIECE = 1 << 20


# ---------------------------------------------------------------- sorted runs and their merge
def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    most, at = min(len(a), len(b)), known
    while at < most and a[at:at + 64] == b[at:at + 64]:
        at += 64
    at = min(at, most)
    stop = min(at + 64, most)
    x, y = int.from_bytes(a[at:stop], "big"), int.from_bytes(b[at:stop], "big")
    return stop if x == y else stop - (x ^ y).bit_length() // 8 - ((x ^ y).bit_length() % 8 > 0)


def front_code(strings: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Of sorted strings: how much each shares with the one before, and the rest."""
    common = [0] * len(strings)
    for i in range(1, len(strings)):
        common[i] = shared(strings[i - 1], strings[i], 0)
    return np.array(common, np.int64), [s[c:] for s, c in zip(strings, common)]


class Run:
    """Reads a front-coded run: the string at hand, and what it shares with the one before."""

    def __init__(self, common: list[int], rests: list[bytes]):
        self.common, self.rests, self.at = common, rests, -1
        self.text: bytes | None = b""
        self.step()

    def step(self) -> None:
        self.at += 1
        if self.at == len(self.rests):
            self.text, self.known = None, -1
        else:
            self.known = self.common[self.at]
            self.text = self.text[:self.known] + self.rests[self.at]


def merge_runs(readers: list[Run]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, place in the run, string, bytes shared with the string before) in sorted order.

    ``known`` of a run is what its string shares with the last string put out. Of two strings the
    one that shares more is the smaller one; only if both share as much, they are compared, from
    there on, and the loser then remembers what it shares with the winner.
    """
    k = 1
    while k < len(readers):
        k *= 2
    readers = readers + [Run([], []) for _ in range(k - len(readers))]

    def duel(i: int, j: int) -> tuple[int, int]:
        a, b = readers[i], readers[j]
        if a.text is None or b.text is None:
            return (j, i) if a.text is None else (i, j)
        if a.known != b.known:
            return (i, j) if a.known > b.known else (j, i)
        common = shared(a.text, b.text, a.known)
        if len(a.text) == common or (len(b.text) > common and a.text[common] < b.text[common]):
            b.known = common
            return i, j
        a.known = common
        return j, i

    loser, level = [0] * k, list(range(k))
    width = k
    while width > 1:
        width //= 2
        for n in range(width):
            level[n], loser[width + n] = duel(level[2 * n], level[2 * n + 1])
    winner = level[0]
    while readers[winner].text is not None:
        best = readers[winner]
        yield winner, best.at, best.text, best.known
        best.step()
        node = (winner + k) // 2
        while node:
            winner, loser[node] = duel(winner, loser[node])
            node //= 2


# ---------------------------------------------------------------- fingerprints
def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as a number, with zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data), np.uint64)
    for j in range(8):
        m = len(out[j::8])
        out[j::8] = padded[j:j + 8 * m].view(np.uint64)
    return out


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from every place on, n a multiple of 8."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    eights, m = _eights(data), len(data) - n + 1
    out = np.full(m, n, np.uint64)
    for j in range(0, n, 8):
        out = out * np.uint64(0x9E3779B97F4A7C15) + eights[j:j + m]
        out ^= out >> np.uint64(29)
    return mix64(out)


def fingerprints(data: np.ndarray, window: int) -> np.ndarray:
    """Hash of the ``window`` bytes from every place on, window a multiple of 8."""
    m = len(data) - window + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    eights, out = mix64(_eights(data)), np.zeros(m, np.uint64)
    for j in range(0, window, 8):
        out = out * np.uint64(0x9E3779B97F4A7C15) + eights[j:j + m]
    return mix64(out)


# ---------------------------------------------------------------- jobs
def _segments(window: int, n: int, packed: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            data, offsets = raw(batch.column("text"))
            text, start, many, anchor = segments(byte_grams(data, n), offsets, window, n)
            whole = data.tobytes()
            content = np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(start.tolist(), (start + many + window - 1).tolist())), np.uint64, len(start))
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(owner) for c in ("k1", "k2", "base")),
                pa.array(start - offsets[text] + batch.column("base").to_numpy()[text]), pa.array(many),
                pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), batch.column("n").take(owner)],
                ["k1", "k2", "base", "start", "windows", "anchor", "content", "n"])

    return run


def _passages(window: int, packed: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            data, offsets = raw(batch.column("text"))
            whole, rows = data.tobytes(), []
            for first, k1, k2, base, parts in zip(offsets.tolist(), *(batch.column(c).to_pylist() for c in ("k1", "k2", "base", "parts"))):
                for p in parts:
                    a = first + p["start"] - base
                    rows.append((k1, k2, p["start"], p["anchor"], p["content"], p["n"], p["hot"], whole[a:a + p["windows"] + window - 1]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 6, pa.bool_(), pa.binary()))],
                    ["k1", "k2", "start", "anchor", "content", "n", "hot", "items"])

    return run


_RUN = "target int, common binary, sizes binary, rests binary, k1 binary, k2 binary, start binary, own binary"


def twin_strings(segments: list[bytes], single: list[bool], window: int) -> list[tuple[int, int, int, bool, int]]:
    """(segment, place, length, own, fingerprint of the first window) of the strings to be sorted.

    Own strings are those of segments that occur once; the others are the places where their
    fingerprints occur first, or second for the first ones.
    """
    size = np.array([len(s) for s in segments])
    begin = np.cumsum(size) - size
    prints = fingerprints(np.frombuffer(b"".join(segments), np.uint8), window)
    owner = np.repeat(np.arange(len(segments)), size - window + 1)
    place = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(size - window + 1) - (size - window + 1)), size - window + 1)
    prints = prints[place]
    order = np.argsort(prints, kind="stable")
    new = np.concatenate([[True], prints[order][1:] != prints[order][:-1]])
    head = np.flatnonzero(new)
    many = np.diff(np.append(head, len(order)))
    mate = np.empty(len(order), np.int64)
    mate[order] = np.repeat(order[head], many)
    several = np.zeros(len(order), bool)
    several[order] = np.repeat(many > 1, many)
    firsts = head[many > 1]
    mate[order[firsts]] = order[firsts + 1]  # the first one's twin is the second
    alone = np.array(single)[owner]
    asks = several & alone
    shift = place[mate] - place
    joins = np.zeros(len(order), bool)
    joins[1:] = asks[1:] & asks[:-1] & (owner[1:] == owner[:-1]) & (shift[1:] == shift[:-1]) & (owner[mate][1:] == owner[mate][:-1])
    start = np.flatnonzero(asks & ~joins)
    length = np.diff(np.append(np.searchsorted(np.flatnonzero(asks), start), asks.sum())) + window - 1
    found: dict[int, tuple[int, bool]] = {}
    for w, m in zip(start.tolist(), length.tolist()):
        for at, own in ((w, True), (int(mate[w]), False)):
            had = found.get(at, (0, False))
            found[at] = (max(m, had[0]), own or had[1])
    return [(int(owner[w]), int(place[w] - begin[owner[w]]), m, own, int(prints[w])) for w, (m, own) in found.items()]


def _runs(window: int, targets: int):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["anchor", "content"]).reset_index(drop=True)
        texts, rows = frame["items"].tolist(), {}
        k1, k2, start = (frame[c].to_numpy(np.int64) for c in ("k1", "k2", "start"))
        for seg, at, length, own, first in twin_strings(texts, (frame["n"] == 1).tolist(), window):
            # a string of a segment that occurs once ends with the segment at most
            rows.setdefault(first % targets, []).append((texts[seg][at:at + length], int(k1[seg]), int(k2[seg]), int(start[seg]) + at, own))
        out = []
        for target, strings in rows.items():
            strings.sort()
            common, rests = front_code([s[0] for s in strings])
            columns = [np.array([s[i] for s in strings], np.int64).tobytes() for i in (1, 2, 3)]
            out.append((target, common.tobytes(), np.array([len(r) for r in rests], np.int64).tobytes(), b"".join(rests), *columns, bytes(s[4] for s in strings)))
        return pd.DataFrame(out, columns=["target", "common", "sizes", "rests", "k1", "k2", "start", "own"]).astype({"target": "int32"})

    return run


def _merged(window: int):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        readers, facts = [], []
        for row in frame.itertuples():
            stop = np.cumsum(np.frombuffer(row.sizes, np.int64)).tolist()
            rests = [row.rests[a:b] for a, b in zip([0, *stop[:-1]], stop)]
            readers.append(Run(np.frombuffer(row.common, np.int64).tolist(), rests))
            facts.append([np.frombuffer(getattr(row, c), np.int64) for c in ("k1", "k2", "start")] + [row.own])
        found, held = [], None  # held: the string before, whose next neighbour is not known yet
        for number, at, text, common in merge_runs(readers):
            if held is not None:
                _settle(found, held, common, window)
            k1, k2, start, own = facts[number]
            held = (int(k1[at]), int(k2[at]), int(start[at]), common) if own[at] else None
        if held is not None:
            _settle(found, held, 0, window)
        return pd.DataFrame(found, columns=["k1", "k2", "start", "windows"]).astype("int64")

    return run


def _settle(found: list, held: tuple, after: int, window: int) -> None:
    """An own string shares this much with a neighbour: so many of its windows occur there too."""
    windows = max(held[3], after) - window + 1
    if windows > 0:
        found.append((*held[:3], windows))


def _remove(window: int, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = raw(batch.column("text"))
            sizes, gone, spans, kept = np.diff(offsets), [], [], []
            for a, n, ranges in zip(offsets.tolist(), sizes.tolist(), batch.column("ranges").to_pylist()):
                drop = marks(ranges, n, window)
                gone.append(int(drop.sum()))
                spans.append(len(runs(drop)[0]))
                kept.append(data[a:a + n][~drop].tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(sizes), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def dedup_bytes(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_removed, n_spans, kept): every document without the byte windows that occur elsewhere."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    whole, parts = narrowed(
        rows.select("k1", "k2", "text"), lambda n, packed: _segments(window, n, packed), lambda packed: _passages(window, packed), window, anchor, TASK_BYTES, 8)
    size = parts.agg(F.sum(F.octet_length("items")).alias("n")).first().n or 0
    tasks, targets = int(size // TASK_BYTES) + 1, int(size // TARGET_BYTES) + 1
    sorted_runs = parts.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(tasks)).alias("task")).applyInPandas(_runs(window, targets), _RUN)
    again = sorted_runs.groupBy("target").applyInPandas(_merged(window), "k1 long, k2 long, start long, windows long")
    ranges = covered(whole, again)
    return rows.join(ranges, ["k1", "k2"], "left").select("id", "text", "ranges").mapInArrow(
        _remove(window, id_col), f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
