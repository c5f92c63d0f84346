"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are the word n-grams of a test item that are rare: by count over all documents, in few of
them, or hardly more common than the item's rarest, so a passage that has leaked into many documents
keeps its seeds. The rarest of every stretch is one in any case, so an item has seeds all along.
N-grams that no document holds are no help and don't count. Where edits leave no n-gram whole, pairs of
words at most one word apart are seeds, of which two near one diagonal are asked for (one of items of
fewer than ``ALONE`` words, where two words are score enough). A document that holds a seed is aligned
with the item around it, word by word; edited and paraphrased copies score lower than exact ones.
Test items go to the workers in blocks of bounded size, and every block looks at all documents.

Words are runs of letters and digits, A-Z lower-cased; marks don't count.

Cases: null or empty texts have no hits; of items of fewer than ``seed`` words only whole
copies are looked for; items
of one text are found each; equal documents are found each; an empty table gives an empty result;
extra columns are carried in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, inside, lower, mix64, pieces, raw, words

SEED, STRETCH, MIN_SCORE = 4, 6, 0.4
#: an n-gram is rare with at most this share of the documents, or so many times the count of the item's rarest
RARE_SHARE, RARE_TIMES = 1e-3, 10
#: pairs of words: places apart in item and document, share of the documents up to which one is rare, stretch of
#: which the rarest is a seed in any case, and words of an item from which on two are asked for
GAPS, PAIR_SHARE, PAIR_STRETCH, ALONE = (1, 2), 0.05, 3, 6
GRAM, SHORT, PAIR = 0, 1, 2
#: items and text bytes of one block, which is broadcast
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
MATCH, MISMATCH, GAP = 2, -1, 1

_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw(texts)
    w = words(lower(data), offsets, _BETWEEN)
    return w.hashes()[w.code] if len(w.code) else np.zeros(0, np.uint64), w.first


def _pairs(hashes: np.ndarray, gap: int) -> np.ndarray:
    """Hash of the word at every place and the one ``gap`` places on, alike for all gaps."""
    return mix64(hashes[:-gap] * np.uint64(0x9E3779B97F4A7C15) + (hashes[gap:] ^ (hashes[gap:] >> np.uint64(29)))) if len(hashes) > gap else np.zeros(0, np.uint64)


def _seeds_of(hashes: np.ndarray, first: np.ndarray, lengths: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length or 0 for pairs, hash at every place, whether it is in one text) of n-grams and pairs."""
    for n in lengths:
        yield n, gram_hashes(hashes, n), inside(first, n, len(hashes))
    for gap in GAPS:
        yield 0, _pairs(hashes, gap), inside(first, gap + 1, len(hashes))


@dataclass
class Items:
    """A block of test items: word hashes, and seeds with the places they come from."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    gram: np.ndarray  # every n-gram and pair of the items,
    item: np.ndarray  # its item,
    offset: np.ndarray  # its place there
    kind: np.ndarray  # and GRAM, SHORT (a whole item shorter than a seed) or PAIR and up, one for each gap
    lengths: list  # of n-grams to look for

    @staticmethod
    def of(rows: list, seed: int) -> Items:
        hashes, first = _word_hashes(pa.array([r.text for r in rows], pa.string()))
        size, parts, lengths = np.diff(first), [], {seed, *(n for n in np.unique(np.diff(first)).tolist() if 0 < n < seed)}
        pair = PAIR
        for n, grams, fits in _seeds_of(hashes, first, sorted(lengths)):
            at = np.flatnonzero(fits)
            item = np.searchsorted(first, at, "right") - 1
            own = size[item] == n if 0 < n < seed else size[item] >= seed
            at, item = at[own], item[own]
            parts.append((grams[at], item, at - first[item], np.full(len(at), pair if not n else GRAM if n == seed else SHORT)))
            pair += not n
        gram, item, offset, kind = (np.concatenate(x) for x in zip(*parts))
        return Items([r.item for r in rows], hashes, first, gram, item, offset, kind, sorted(lengths))

    def rarest(self, count: dict[int, int], documents: int, stretch: int) -> Items:
        """Keep the seeds, sorted by n-gram."""
        n = np.array([count.get(int(g), 0) for g in self.gram.view(np.int64)], float)
        n[n == 0] = np.inf
        keep = self.kind == SHORT
        for kind in {*np.unique(self.kind).tolist()} - {SHORT}:
            own = np.flatnonzero(self.kind == kind)
            share, reach = (RARE_SHARE, stretch) if kind == GRAM else (PAIR_SHARE, PAIR_STRETCH)
            m = n[own]
            stay = m <= share * documents
            edge = np.flatnonzero(np.diff(self.item[own], prepend=-1, append=len(self.ids) + 1))
            for a, b in zip(edge[:-1], edge[1:]):
                stay[a:b] |= m[a:b] <= RARE_TIMES * m[a:b].min()
                for i in range(a, max(a + 1, b - reach + 1)):
                    stay[i + int(np.argmin(m[i:min(i + reach, b)]))] = True
            keep[own] = stay
        by = np.flatnonzero(keep & np.isfinite(n))
        by = by[np.argsort(self.gram[by], kind="stable")]
        return Items(self.ids, self.words, self.first, self.gram[by], self.item[by], self.offset[by], self.kind[by], self.lengths)


def _found(seeds: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Places of the grams that are among the sorted seeds."""
    if not len(seeds):
        return np.zeros(0, np.int64)
    bits = np.uint64(64 - min(24, max(16, len(seeds).bit_length() + 6)))
    maybe = np.zeros(1 << (64 - int(bits)), bool)  # leading bits of a seed; most grams have others
    maybe[seeds >> bits] = True
    some = np.flatnonzero(maybe[grams >> bits])
    at = np.minimum(np.searchsorted(seeds, grams[some]), len(seeds) - 1)
    return some[seeds[at] == grams[some]]


def _places(seeds: np.ndarray, hashes: np.ndarray, first: np.ndarray, lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places where a seed starts in a text, and its hash."""
    found = []
    for _, grams, fits in _seeds_of(hashes, first, lengths):
        at = _found(seeds, grams)
        at = at[fits[at]]
        found.append((at, grams[at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def align(texts: np.ndarray, text_range: np.ndarray, items: np.ndarray, item_range: np.ndarray, cells: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of every (text range, item range) pair, and the text place where it ends."""
    score, end = np.zeros(len(text_range), np.int64), np.zeros(len(text_range), np.int64)
    size, height = np.diff(text_range)[:, 0], np.diff(item_range)[:, 0]
    order = np.lexsort((height, size))
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and size[order[b]] * (b + 1 - a) <= cells:
            b += 1
        own = order[a:b]
        width, rows = int(size[own].max()), int(height[own].max())
        column = np.arange(width)
        text = np.where(column < size[own, None], texts[np.minimum(text_range[own, :1] + column, max(0, len(texts) - 1))], np.uint64(0))
        row = np.arange(rows)
        item = np.where(row < height[own, None], items[np.minimum(item_range[own, :1] + row, max(0, len(items) - 1))], np.uint64(1))
        h, best, place = np.zeros((len(own), width + 1), np.int32), np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        slope = (GAP * column).astype(np.int32)
        for i in range(rows):
            t = np.where(text == item[:, i:i + 1], np.int32(MATCH), np.int32(MISMATCH))
            t += h[:, :-1]
            np.maximum(t, h[:, 1:] - GAP, out=t)
            np.maximum(t, 0, out=t)
            t += slope
            h[:, 1:] = np.maximum.accumulate(t, axis=1) - slope
            top = h[:, 1:].argmax(axis=1)
            value = h[np.arange(len(own)), top + 1]
            better = value > best
            best[better], place[better] = value[better], top[better]
        score[own], end[own] = best, place
        a = b
    return score, end


def _backed(text: np.ndarray, item: np.ndarray, diagonal: np.ndarray, pick: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Which hits have another seed's hit of the same text and item near their diagonal."""
    by = np.lexsort((diagonal, item, text))
    out = np.zeros(len(by), bool)
    for step in range(1, 4):
        a, b = by[:-step], by[step:]
        near = (text[a] == text[b]) & (item[a] == item[b]) & (pick[a] != pick[b]) & (diagonal[b] - diagonal[a] <= slack[a])
        out[a[near]] = out[b[near]] = True
    return out


def _candidates(items: Items, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, item, start, stop): word ranges around seeds, ranges of one text and item that overlap as one."""
    at, grams = _places(items.gram, hashes, first, items.lengths)
    low, high = np.searchsorted(items.gram, grams), np.searchsorted(items.gram, grams, "right")
    times = high - low
    pick = np.arange(int(times.sum())) + np.repeat(low - (np.cumsum(times) - times), times)
    at = np.repeat(at, times)
    text, item = np.searchsorted(first, at, "right") - 1, items.item[pick]
    size = np.diff(items.first)[item]
    unsure = np.flatnonzero((items.kind[pick] >= PAIR) & (size >= ALONE))
    if len(unsure):
        backed = _backed(text[unsure], item[unsure], at[unsure] - items.offset[pick[unsure]], pick[unsure], size[unsure] // 4 + 2)
        stay = np.delete(np.arange(len(at)), unsure[~backed])
        at, pick, text, item, size = at[stay], pick[stay], text[stay], item[stay], size[stay]
    start = np.maximum(first[text], at - items.offset[pick] - size // 2 - 2)
    stop = np.minimum(first[text + 1], at - items.offset[pick] + size + size // 2 + 2)
    by = np.lexsort((start, item, text))
    text, item, start, stop = text[by], item[by], start[by], stop[by]
    group = np.cumsum((np.diff(text, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
    reach = np.maximum.accumulate(stop + group * (len(hashes) + 1))
    new = np.ones(len(by), bool)
    new[1:] = start[1:] + group[1:] * (len(hashes) + 1) > reach[:-1]
    edge = np.flatnonzero(new)
    if len(edge):
        stop = np.maximum.reduceat(stop, edge)
    return text[edge], item[edge], start[edge], stop


_HITS = "array<struct<item_id:{kind},score:double,first_word:long,last_word:long>>"


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, seed: int = SEED, stretch: int = STRETCH, keep: Sequence[str] | None = None,
    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Rows (doc, hits) for all documents; ``hits`` has the items found there.

    A hit's score is the alignment score over that of an exact copy of the whole item; its words are
    places in the document, counted from 0. The best alignment of each item counts.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("doc")
    tests = benchmark.where(F.col(item_text_col).isNotNull()).select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("text")).distinct()
    kind = tests.schema["item"].dataType.simpleString()
    hits_type = _HITS.format(kind=kind)
    rows = docs.select(carried, F.col(text_col).alias("text"), F.expr(f"cast(array() AS {hits_type})").alias("hits"))
    texts = rows.select("text")
    total = tests.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(-(-total.n // BLOCK_ITEMS), -(-(total.b or 0) // BLOCK_BYTES))
    schema, documents = rows.schema, docs.count()

    def count_of(items: Items):
        seeds = np.unique(items.gram)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                hashes, first = _word_hashes(batch.column("text"))
                found, n = np.unique(_places(seeds, hashes, first, items.lengths)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["gram", "n"])

        return run

    def leaks_of(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                hashes, first = _word_hashes(batch.column("text"))
                text, item, start, stop = _candidates(items, hashes, first)
                where, what = np.stack([start, stop], axis=1), np.stack([items.first[item], items.first[item + 1]], axis=1)
                score, end = align(hashes, where, items.words, what)
                share = score / (MATCH * np.maximum(1, np.diff(what)[:, 0]))
                good = np.lexsort((start, -share, item, text))
                whole = np.diff(what)[:, 0] >= seed  # of shorter items the whole is asked for
                good = good[share[good] >= np.where(whole[good], min_score, 1)]
                good = good[np.concatenate([[True], (np.diff(text[good]) != 0) | (np.diff(item[good]) != 0)])] if len(good) else good
                # the same alignment backwards gives where it starts
                n = len(hashes)
                _, back = align(hashes[::-1], np.stack([n - (start[good] + end[good] + 1), n - start[good]], axis=1),
                                items.words[::-1], len(items.words) - what[good][:, ::-1])
                last = start[good] + end[good]
                found = batch.column("hits").to_pylist()
                for k, i in enumerate(good.tolist()):
                    base = int(first[text[i]])
                    found[text[i]].append({"item_id": items.ids[item[i]], "score": float(share[i]), "first_word": int(last[k] - back[k]) - base, "last_word": int(last[k]) - base})
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text"), pa.array(found, batch.schema.field("hits").type)], ["doc", "text", "hits"])

        return run

    for block in range(blocks):
        own = tests.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "text").collect()
        items = Items.of(own, seed)
        count = texts.mapInArrow(count_of(items), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
        rows = rows.mapInArrow(leaks_of(items.rarest({r.gram: r.n for r in count}, documents, stretch)), schema)
    return rows.select("doc", "hits")
