"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded (byte pairs hashed to buckets, and shares
of kinds of characters and words), mapped to a hidden vector, and weighted by gated attention:
``softmax(w . (tanh(V h) * sigmoid(U h)))``. The label of the document is all there is to learn
from; its score is a logistic function of the weighted sum of the hidden vectors. The model is
fitted on at most ``max_docs`` labelled documents with at most ``max_passages`` passages each; every
document is scored with all its passages.

Cases: a null or empty text is one empty passage and gets a score too; a null id is never learnt
from; labels other than 0 and 1 are left out; of several labels of one document the lowest holds;
without any label, or with one kind only, the score is the smoothed share of label 1; extra columns
are carried in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _IS_SPACE, lower, pieces, raw, words

PASSAGE_WORDS = 64
BUCKETS = 128
MAX_DOCS, MAX_PASSAGES = 8000, 400
HIDDEN, GATE = 32, 16
#: text bytes encoded at once; every byte takes some forty bytes of numbers on the way
SLICE = 1 << 19

_KINDS = np.zeros((6, 256), bool)  # upper, lower, digit, mark, other ASCII, beyond ASCII
_KINDS[0, 65:91] = _KINDS[1, 97:123] = _KINDS[2, 48:58] = True
_KINDS[3, [ord(c) for c in ".,;:!?'\"()-"]] = True
_KINDS[5, 128:] = True
_KINDS[4] = ~_KINDS.any(axis=0) & ~_IS_SPACE
_KIND = np.where(_IS_SPACE, 6, _KINDS.argmax(axis=0)).astype(np.int64)
_PAIRS = (np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BUCKETS
FEATURES = BUCKETS + 7 + 7


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row of features for each passage, and the n+1 first passages of the texts."""
    data, offsets = raw(texts)
    w = words(data, offsets)
    count = np.diff(w.first)
    first = np.concatenate([[0], np.cumsum(np.maximum(1, -(-count // PASSAGE_WORDS)))])
    n = int(first[-1])
    x = np.zeros((n, FEATURES), np.float32)
    if not len(w.start):
        return x, first
    text_of_word = np.repeat(np.arange(len(count)), count)
    passage = first[text_of_word] + (np.arange(len(w.start)) - w.first[text_of_word]) // PASSAGE_WORDS
    fresh = np.flatnonzero(np.diff(passage, prepend=-1))  # first word of each passage that has words
    own = passage[fresh]
    begin, end = w.start[fresh], w.stop[np.append(fresh[1:], len(passage)) - 1]
    size = end - begin
    where = np.repeat(np.arange(len(own)), size)
    at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    chars = data[at]
    low = lower(chars).astype(np.int64)
    after = np.append(low[1:], 32)
    after[np.cumsum(size) - 1] = 32  # a passage ends as with a space, whatever text comes next
    pairs = _PAIRS[low * 256 + after]
    hashed = np.bincount(where * BUCKETS + pairs, minlength=len(own) * BUCKETS).reshape(-1, BUCKETS)
    kinds = np.bincount(where * 7 + _KIND[chars], minlength=len(own) * 7).reshape(-1, 7)
    n_words = np.bincount(np.searchsorted(own, passage), minlength=len(own))
    pair = np.sort(np.searchsorted(own, passage) * len(w.vocabulary) + w.code)
    new = np.flatnonzero(np.diff(pair, prepend=-1))
    runs, run_of = np.diff(np.append(new, len(pair))), pair[new] // len(w.vocabulary)
    distinct = np.bincount(run_of, minlength=len(own))
    most = np.zeros(len(own))
    np.maximum.at(most, run_of, runs)
    same = np.zeros(len(passage))
    same[1:] = (w.code[1:] == w.code[:-1]) & (passage[1:] == passage[:-1])
    length = w.stop - w.start
    mean = np.add.reduceat(length, fresh) / n_words
    spread = np.sqrt(np.maximum(0, np.add.reduceat(length.astype(float) ** 2, fresh) / n_words - mean ** 2))
    x[own, :BUCKETS] = np.sqrt(hashed / np.maximum(size, 1)[:, None])
    x[own, BUCKETS:BUCKETS + 7] = kinds / np.maximum(size, 1)[:, None]
    x[own, BUCKETS + 7:] = np.stack([
        np.log1p(n_words), np.log1p(mean), np.log1p(spread), distinct / n_words, most / n_words,
        np.add.reduceat(same, fresh) / n_words, (count[text_of_word[fresh]] < PASSAGE_WORDS).astype(float)], axis=1)
    return x, first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Weights of the scorer; without any, ``prior`` is the score of every document."""

    prior: float
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(first) - 1, self.prior)
        return _sigmoid(forward(self.weights, np.clip((x - self.shift) * self.scale, -8, 8), first)["logit"]).astype(float)


def forward(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * s) @ p["w"]
    size = np.diff(first)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), size))
    a = e / np.repeat(np.add.reduceat(e, first[:-1]), size)
    z = np.add.reduceat(a[:, None] * h, first[:-1])
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "logit": z @ p["c"] + p["d"]}


def gradient(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    o = forward(p, x, first)
    size = np.diff(first)
    dlogit = (_sigmoid(o["logit"]) - y) / len(y)
    dz = np.repeat(dlogit[:, None] * p["c"], size, axis=0)
    part = np.einsum("ij,ij->i", dz, o["h"])  # change of the loss with each attention weight
    de = o["a"] * (part - np.repeat(np.add.reduceat(o["a"] * part, first[:-1]), size))
    dt, ds = de[:, None] * p["w"] * o["s"] * (1 - o["t"] ** 2), de[:, None] * p["w"] * o["t"] * o["s"] * (1 - o["s"])
    dh = (o["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - o["h"] ** 2)
    return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": o["h"].T @ dt, "U": o["h"].T @ ds, "w": (o["t"] * o["s"]).T @ de,
            "c": o["z"].T @ dlogit, "d": dlogit.sum(keepdims=True)}


def train(x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, seed: int = 7) -> Model:
    """Adam on the bags, runs of rows of ``x``, which is scaled in place.

    The weights of the epoch with the least loss on a tenth of the bags are kept.
    """
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y.tolist())) < 2:
        return Model(prior)
    rng = np.random.default_rng(seed)
    shift, scale = x.mean(axis=0), 1 / (x.std(axis=0) + 1e-3)
    x -= shift
    x *= scale
    np.clip(x, -8, 8, out=x)
    shape = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": (1,)}
    p = {k: (rng.normal(0, 0.5 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s)) for k, s in shape.items()}
    p["d"][:] = np.log(prior / (1 - prior))
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    order = rng.permutation(len(y))
    held, own = order[:len(order) // 10], order[len(order) // 10:]
    best, least, step = {k: a.copy() for k, a in p.items()}, np.inf, 0

    def stack(idx):
        return np.concatenate([x[first[i]:first[i + 1]] for i in idx]), np.concatenate([[0], np.cumsum(np.diff(first)[idx])]), y[idx]

    for epoch in range(epochs):
        rng.shuffle(own)
        for a in range(0, len(own), batch):
            g, step = gradient(p, *stack(own[a:a + batch])), step + 1
            for k in p:
                d = g[k] + (1e-4 * p[k] if k not in "bd" else 0)
                m[k] += 0.1 * (d - m[k])
                v[k] += 0.001 * (d * d - v[k])
                p[k] -= 3e-3 * (1 - epoch / epochs) * m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        bags, starts, truth = stack(held if len(held) else own)
        score = np.clip(_sigmoid(forward(p, bags, starts)["logit"]), 1e-6, 1 - 1e-6)
        loss = -np.mean(truth * np.log(score) + (1 - truth) * np.log(1 - score))
        if loss < least:
            best, least = {k: a.copy() for k, a in p.items()}, loss
    return Model(prior, shift, scale, best)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_docs: int = MAX_DOCS, max_passages: int = MAX_PASSAGES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the labelled documents with the lowest hashes, at most ``max_docs`` of them."""
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("y"))
        .orderBy(F.xxhash64("id", F.lit(7)), "id").limit(max_docs)
    )

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=SLICE):
            x, first = encode(batch.column("text"))
            kept = []
            for a, b in zip(first[:-1], first[1:]):
                rows = np.unique(np.linspace(a, b - 1, min(b - a, max_passages)).astype(np.int64))
                kept.append(x[rows].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(kept, pa.binary())], ["id", "y", "x"])

    # at most max_docs rows of two numbers are broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "y", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(bags, f"id {kind}, y int, x binary").collect()
    found = sorted({(r.id, bytes(r.x), r.y) for r in found})[:max_docs]
    if not found:
        return Model(0.5)
    first = np.concatenate([[0], np.cumsum([len(x) // (2 * FEATURES) for _, x, _ in found])])
    x = np.empty((first[-1], FEATURES), np.float32)
    for a, b, (_, row, _) in zip(first[:-1], first[1:], found):
        x[a:b] = np.frombuffer(row, np.float16).reshape(-1, FEATURES)
    return train(x, first, np.array([y for _, _, y in found], float))


def score(docs: DataFrame, model: Model, keep: Sequence[str] | None = None, text_col: str = "text") -> DataFrame:
    """Rows (doc, score, predicted); ``doc`` holds the columns named by ``keep`` (all, if not given)."""
    kept = docs.columns if keep is None else list(keep)
    carried = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    inside = kept.index(text_col) if kept.count(text_col) == 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if inside is not None:
            batches = (pa.RecordBatch.from_arrays([b.column(0), b.column(0).field(inside)], ["doc", "text"]) for b in batches)
        for batch in pieces(batches, limit=SLICE):
            found = model.score(*encode(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found)], ["doc", "score"])

    # a text that is carried along is handed over once
    rows = docs.select(carried) if inside is not None else docs.select(carried, F.col(text_col).alias("text"))
    scored = rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
