"""Citation graph, index and vector jobs.

Iterative jobs keep one narrow (node, value) table per round and write it to the shared folder,
so plans stay short and a lost executor costs at most one round.
Hubs never gather their neighbours: every round is a join on the edge and a combining aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as X
from .dedup import top_per_key
from .lineage import cut, forget


def build_edges(cases: DataFrame, source: str = "celex_id", cell: str = "cites") -> DataFrame:
    """(source, target) for every token whose target is in the corpus."""
    pairs = cases.select(F.col(source).alias("source"), F.explode(X.toks(cell)).alias("target"))
    return pairs.join(cases.select(F.col(source).alias("target")).distinct(), "target", "left_semi").select("source", "target")


def _simple(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source_case_id").alias("src"), F.col("target_case_id").alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").distinct()


def pagerank(edges: DataFrame, alpha: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """PageRank with the mass of dangling nodes shared by all, until a round changes the ranks by less than ``tolerance`` a node."""
    e = _simple(edges)
    out = e.groupBy("src").agg(F.count("*").alias("degree"))
    e = cut(e.join(out, "src").withColumn("share", 1.0 / F.col("degree")).select("src", "dst", "share"))
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    sources = e.select(F.col("src").alias("node"), F.lit(True).alias("cites")).distinct()
    nodes = cut(nodes.join(sources, "node", "left").select("node", F.col("cites").isNull().alias("dangling")))
    n = max(1, nodes.count())
    rank = cut(nodes.withColumn("rank", F.lit(1.0 / n)).withColumn("change", F.lit(0.0)))
    while True:
        flow = e.join(rank.select(F.col("node").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("node")).agg(
            F.sum(F.col("rank") * F.col("share")).alias("flow"))
        lost = rank.agg(F.coalesce(F.sum(F.when(F.col("dangling"), F.col("rank"))), F.lit(0.0))).first()[0]
        new = F.lit((1 - alpha) / n + alpha * lost / n) + alpha * F.coalesce("flow", F.lit(0.0))
        moved = cut(rank.join(flow, "node", "left").select("node", "dangling", new.alias("rank"), F.abs(new - F.col("rank")).alias("change")))
        forget(rank)
        rank = moved
        if (rank.agg(F.sum("change")).first()[0] or 0.0) < n * tolerance:
            forget(nodes, e)
            return rank.select("node", "rank")


def top_ranked(ranks: DataFrame, n: int = 10) -> DataFrame:
    """The n nodes of highest rank, ties by node."""
    return ranks.orderBy(F.col("rank").desc(), "node").limit(n)


def degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree of distinct pairs."""
    e = _simple(edges)
    sides = e.select(F.inline(F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))))
    return sides.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def _push(e: DataFrame, values: DataFrame, column: str, read: str, write: str) -> DataFrame:
    """Sum of ``column`` over the edges, from the ``read`` end to the ``write`` end."""
    return e.join(values.withColumnRenamed("node", read), read).groupBy(F.col(write).alias("node")).agg(F.sum(column).alias(column))


def _scaled(values: DataFrame, column: str) -> DataFrame:
    """Values written once, then divided by their length."""
    written = cut(values)
    norm = written.agg(F.sqrt(F.sum(F.col(column) * F.col(column)))).first()[0] or 1.0
    out = written.withColumn(column, F.col(column) / F.lit(norm))
    out._cut_path = written._cut_path
    return out


def network_metrics(edges: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Degrees, hub, authority and eigenvector scores by power iteration with unit length.

    Ends with the round in which each kind of score moves by less than ``tolerance`` a node.
    """
    e = cut(_simple(edges))
    deg = cut(degrees(edges))
    hub = deg.select("node", F.lit(1.0).alias("hub"))
    authority = deg.select("node", F.lit(0.0).alias("authority"))
    eigen, n = deg.select("node", F.lit(1.0).alias("eigen")), deg.count()

    def moved(old: DataFrame, new: DataFrame, column: str) -> float:
        both = old.select("node", F.col(column).alias("a")).join(new.select("node", F.col(column).alias("b")), "node", "full_outer")
        return both.agg(F.sum(F.abs(F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0))))).first()[0] or 0.0

    while True:
        new_authority = _scaled(_push(e, hub, "hub", "src", "dst").withColumnRenamed("hub", "authority"), "authority")
        new_hub = _scaled(_push(e, new_authority, "authority", "dst", "src").withColumnRenamed("authority", "hub"), "hub")
        # own value is added, so the iteration also settles on graphs without cycles
        pulled = _push(e, eigen, "eigen", "src", "dst").withColumnRenamed("eigen", "pulled")
        new_eigen = _scaled(eigen.join(pulled, "node", "left").select("node", (F.col("eigen") + F.coalesce("pulled", F.lit(0.0))).alias("eigen")), "eigen")
        change = max(moved(hub, new_hub, "hub"), moved(authority, new_authority, "authority"), moved(eigen, new_eigen, "eigen"))
        forget(hub, authority, eigen)
        hub, authority, eigen = new_hub, new_authority, new_eigen
        if change < max(1, n) * tolerance:
            break
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return deg.join(hub, "node", "left").join(authority, "node", "left").join(eigen, "node", "left").select(
        "node", "in_degree", "out_degree", zero("hub"), zero("authority"), zero("eigen"))


def network_size(edges: DataFrame) -> DataFrame:
    e = _simple(edges)
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    return e.agg(F.count("*").alias("edges")).withColumn("nodes", nodes.agg(F.count("*")).scalar())


def trigrams(c) -> Column:
    """Distinct trigrams of the lower-case words, each padded by two blanks before and one after it."""
    words = F.filter(F.split(F.lower(X.as_col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def _signatures(shape: Column, ranked: Column, own: Column) -> Column:
    """Hashes of the trigram sets by which a side of a pair is looked up; ``ranked`` are its trigrams, rarest first.

    A pair that shares ``o`` trigrams shares ``l`` of the first ``own - o + l`` of either side. ``l`` is the greatest for
    which a side has few such sets; where neither side may miss any, the whole is the set.
    """
    first = F.slice(ranked, F.lit(1), own - shape["o"] + shape["l"])
    rest = lambda i: F.slice(first, i + F.lit(2), F.size(first))
    key = lambda *grams: F.xxhash64(shape, *grams)
    one = F.transform(first, lambda x: key(x))
    two = F.flatten(F.transform(first, lambda x, i: F.transform(rest(i), lambda y: key(x, y))))
    three = F.flatten(F.transform(first, lambda x, i: F.flatten(F.transform(first, lambda y, j: F.when(
        j > i, F.transform(rest(j), lambda z: key(x, y, z))).otherwise(F.array().cast("array<bigint>"))))))
    return F.when(shape["whole"], F.array(key(ranked))).when(shape["l"] == 3, three).when(shape["l"] == 2, two).otherwise(one)


def similar_names(names: DataFrame, queries: DataFrame, threshold: float) -> DataFrame:
    """Rows (query, value, similarity) of all pairs of distinct ``names`` (value) and ``queries`` (query) of at least the threshold.

    Sizes settle how many trigrams a pair must share, so pairs meet by size and by sets of their rarest trigrams
    (``_signatures``), of which no side has more than about ten for high thresholds, whatever a single trigram has.
    Trigrams of a query that no name has count for its size only.
    """
    left = cut(names.select("value").where("value IS NOT NULL").distinct().select(F.xxhash64("value").alias("id"), "value", trigrams("value").alias("grams")).where("size(grams) > 0"))
    right = cut(queries.select("query").where("query IS NOT NULL").distinct().select(F.xxhash64("query").alias("qid"), "query", trigrams("query").alias("grams")).where("size(grams) > 0"))
    rarity = cut(left.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("df")))

    def ranked(df: DataFrame, key: str) -> DataFrame:
        rows = df.select(key, F.size("grams").alias("n"), F.explode("grams").alias("g")).join(rarity, "g")
        by_rarity = rows.groupBy(key, "n").agg(F.array_sort(F.collect_set(F.struct("df", "g"))).alias("r"))
        return by_rarity.select(key, "n", F.transform("r", lambda x: x["g"]).alias("ranked")).withColumn("own", F.size("ranked"))

    # names whose ids collide are both compared below; they are looked up one by one here
    held, asked = cut(ranked(left.withColumn("id", F.struct("id", "value")), "id").withColumn("id", F.col("id.id"))), cut(ranked(right.withColumn("qid", F.struct("qid", "query")), "qid").withColumn("qid", F.col("qid.qid")))
    q, s, p = F.col("q"), F.col("s"), F.col("p")
    o = F.greatest(F.ceil(threshold / (1 + threshold) * (q + s) - 1e-9), F.lit(1)).cast("int")
    spare = F.greatest(p, s) - F.col("o")
    sets = F.least(F.col("o"), F.when(spare <= 2, 3).when(spare <= 8, 2).otherwise(1))
    sizes = held.select(F.col("own").alias("s")).distinct()
    shapes = asked.select(F.col("n").alias("q"), F.col("own").alias("p")).distinct().crossJoin(sizes).withColumn("o", o).where("o <= least(p, s)")
    shapes = shapes.select("q", "p", "s", F.struct("q", "p", "s", "o", sets.alias("l"), (spare == 0).alias("whole")).alias("shape"))
    shapes = F.broadcast(cut(shapes))  # as many rows as names have sizes: bounded by their lengths
    left_keys = held.join(shapes, held["own"] == F.col("s")).select("id", F.explode(_signatures(F.col("shape"), F.col("ranked"), F.col("own"))).alias("key"))
    right_keys = asked.join(shapes, (asked["n"] == F.col("q")) & (asked["own"] == F.col("p"))).select("qid", F.explode(_signatures(F.col("shape"), F.col("ranked"), F.col("own"))).alias("key"))
    pairs = left_keys.join(right_keys, "key").select("id", "qid").distinct()
    compared = pairs.join(right.withColumnRenamed("grams", "__q"), "qid").join(left, "id")
    both = F.size(F.array_intersect("grams", "__q"))
    return compared.select("query", "value", (both / (F.size("grams") + F.size("__q") - both)).alias("similarity")).where(F.col("similarity") >= threshold)


def trigram_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, column: str, threshold: float) -> DataFrame:
    """Exact similarity join of two name tables by sets of their rarest trigrams (``similar_names``)."""
    found = similar_names(left.select(F.col(column).alias("value")), right.select(F.col(column).alias("query")), threshold)
    return found.join(left.select(left_id, F.col(column).alias("value")), "value").join(right.select(right_id, F.col(column).alias("query")), "query").select(left_id, right_id, "similarity")


#: query vectors read at once; scores that a task holds at once
MAX_QUERY_VECTORS, MAX_SCORES = 1_024, 1 << 20


def nearest(segments: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact cosine top-k per query vector: query_id, segment_id, similarity.

    The query vectors are written to the shared folder once, and tasks read them from there block
    by block; none pass the driver. Each task keeps only its own top k per query, so the shuffle
    carries k rows per query and task. Without queries the result is empty.
    """
    asked = cut(queries.select("query_id", F.col("vector").cast("array<double>").alias("vector")))
    files = asked.inputFiles()
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"query_id {kind(queries, 'query_id')}, segment_id {kind(segments, 'segment_id')}, similarity double"

    def local_top(batches: Iterator) -> Iterator:
        best: list[tuple[np.ndarray, ...]] = []
        for frame in batches:
            if not len(frame):
                continue
            names, vectors = frame["segment_id"].to_numpy(), _unit(frame["embedding"])
            for number, block in enumerate(_query_blocks(files)):
                asked_by, wanted = block["query_id"].to_numpy(), _unit(block["vector"])
                for start in range(0, len(names), max(1, MAX_SCORES // len(asked_by))):
                    part = slice(start, start + max(1, MAX_SCORES // len(asked_by)))
                    found = _best(wanted @ vectors[part].T, names[part], k)
                    if number == len(best):
                        best.append((asked_by, *found))
                    else:
                        _, *held = best[number]
                        best[number] = (asked_by, *_top(*(np.concatenate(x) for x in zip(held, found)), k))
        for asked_by, row, column, score in best:
            yield pd.DataFrame({"query_id": asked_by[row], "segment_id": column, "similarity": score})

    found = segments.select("segment_id", "embedding").mapInPandas(local_top, schema)
    return top_per_key(found, ["query_id"], [F.col("similarity").desc(), F.col("segment_id").asc()], k)


def _best(scores: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(row, name, score) of the ``k`` best columns of every row; all ties at the limit stay in the race."""
    last = max(0, scores.shape[1] - k)
    row, column = np.nonzero(scores >= np.partition(scores, last, axis=1)[:, last, None])
    return _top(row, names[column], scores[row, column], k)


def _top(row: np.ndarray, name: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((name, -score, row))
    row, name, score = row[order], name[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], name[place < k], score[place < k]


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.array(vectors.tolist(), dtype=np.float64)
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)


def _query_blocks(files: Sequence[str]) -> Iterator[pd.DataFrame]:
    for uri in files:
        system, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
        with system.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(MAX_QUERY_VECTORS):
                if batch.num_rows:
                    yield batch.to_pandas()


def clusters(edges: DataFrame) -> DataFrame:
    """Connected components: (node, component), the component named by its lowest node.

    Alternates two star operations on the edge list until it stops changing; the minimum per
    node is a combining aggregate joined back, so hub neighbourhoods are never gathered. The
    files of a round go when the next one is written.
    """
    both = _simple(edges)
    nodes = both.select(F.col("src").alias("node")).union(both.select("dst")).distinct()
    links = cut(both.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    mark = None
    while True:
        # the totals that tell whether anything changed are taken while the round is written
        seen = Observation()
        settled = cut(_small_star(_large_star(links)).observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        forget(links)
        links = settled
        now = (seen.get["n"], seen.get["h"])
        if mark == now:
            return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
                "node", F.coalesce("component", "node").alias("component"))
        mark = now


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points at the node's lowest neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point at the lowest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def cluster_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("component").agg(F.count("*").alias("size"))


def expand(edges: DataFrame, ids: DataFrame, datasets: DataFrame, direction: str = "both", relations: Sequence[str] = ()) -> DataFrame:
    """Neighbours of the given cases over active datasets, with relation and direction."""
    live = edges.where("target_case_id IS NOT NULL").join(datasets.where("active").select("source_dataset"), "source_dataset", "left_semi")
    if relations:
        live = live.where(F.col("relation_type").isin(list(relations)))
    roots = ids.select(F.col("case_id").alias("root")).distinct()
    parts = []
    if direction in ("out", "both"):
        parts.append(live.join(roots, F.col("source_case_id") == F.col("root")).select("root", F.col("target_case_id").alias("neighbour"), "relation_type", "source_dataset", F.lit("out").alias("direction")))
    if direction in ("in", "both"):
        parts.append(live.join(roots, F.col("target_case_id") == F.col("root")).select("root", F.col("source_case_id").alias("neighbour"), "relation_type", "source_dataset", F.lit("in").alias("direction")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.distinct()


#: jumps are squared while they are at most so many times the steps
GROWTH = 16

#: levels walked in one job; such jobs after which chains are taken for too long for them
LEVELS, WALKS = 16, 16

#: steps that are held whether a root reaches them or not; steps that a task holds at most; roots it walks from
FEW_STEPS, HELD_STEPS, TASK_ROOTS = 1 << 20, 1 << 23, 1_024


def timeline(edges: DataFrame, cases: DataFrame, roots: DataFrame, relations: Sequence[str]) -> DataFrame:
    """Cases reached from each root over typed relations, with the least number of steps and the date.

    There can be far more pairs of a root and a case than steps, so pairs are neither shuffled nor written: the steps within
    reach of any root are found first, level by level, and tasks read these and walk from their roots one by one. Where
    they are more than a task holds, pairs are found by doubling jumps.
    """
    steps = cut(edges.where("target_case_id IS NOT NULL").where(F.col("relation_type").isin(list(relations))).select(
        F.col("source_case_id").alias("a"), F.col("target_case_id").alias("b")).where("a <> b").distinct())
    asked = cut(roots.select(F.col("case_id").alias("root")).distinct())
    dated = cases.select("case_id", "date_decision")
    near = steps if steps.count() <= FEW_STEPS else _within_reach(steps, asked)
    if near is not steps:
        forget(steps)
    if near.count() <= HELD_STEPS:
        named = cut(near.select(F.explode(F.array("a", "b")).alias("case_id")).distinct().join(dated, "case_id", "left"))
        if named.count() <= 2 * HELD_STEPS:
            return _walks(near, named, asked, dated)
        forget(named)
    return _doubled(near, asked).join(dated, "case_id", "left")


def _within_reach(steps: DataFrame, asked: DataFrame) -> DataFrame:
    """The steps from cases that any root reaches, or ``steps`` itself where that is not settled by ``WALKS`` jobs.

    ``hop`` is the level of this job in which a case was reached, -1 for those of earlier jobs.
    """
    seen = cut(asked.where("root IS NOT NULL").select(F.col("root").alias("node"), F.lit(0).alias("hop")))
    for _ in range(WALKS):
        far = seen
        for level in range(LEVELS):
            here, there = F.struct("node", "hop"), F.struct(F.col("b").alias("node"), F.lit(level + 1).alias("hop"))
            both = far.join(steps.hint("merge"), (F.col("node") == F.col("a")) & (F.col("hop") == level), "left")
            far = both.select(F.inline(F.when(F.col("b").isNull(), F.array(here)).otherwise(F.array(here, there)))).groupBy("node").agg(F.min("hop").alias("hop"))
        walked = cut(far.select("node", F.when(F.col("hop") == LEVELS, 0).otherwise(-1).alias("hop")))
        forget(seen)
        seen = walked
        if seen.where("hop = 0").isEmpty():
            near = cut(steps.join(seen.hint("merge"), F.col("a") == F.col("node"), "left_semi"))
            forget(seen)
            return near
    forget(seen)
    return steps


def _walks(steps: DataFrame, named: DataFrame, asked: DataFrame, dated: DataFrame) -> DataFrame:
    """(case, root, step, date) by a walk from each root; ``named`` are all ends of the steps with their dates."""
    starts = steps.select(F.col("a").alias("root")).distinct()
    walkers = asked.join(starts, "root", "left_semi")
    alone = asked.join(starts, "root", "left_anti").select(F.col("root").alias("case_id"), "root", F.lit(0).alias("step")).join(dated, "case_id", "left")
    parts = max(asked.sparkSession.sparkContext.defaultParallelism, asked.count() // TASK_ROOTS + 1)
    step_files, named_files = tuple(steps.inputFiles()), tuple(named.inputFiles())
    kind = lambda c: named.schema[c].dataType.simpleString()
    schema = f"case_id {kind('case_id')}, root {kind('case_id')}, step int, date_decision {kind('date_decision')}"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _walk(_held(step_files, named_files), batch.column(0))

    # by a key of its own: where the join before has as many parts by root, this deal would be left out and its parts merged by their bytes
    return walkers.repartition(parts, F.xxhash64("root")).mapInArrow(walk, schema).unionByName(alone)


#: rows that a task hands over at once
MAX_ROWS = 1 << 17


def _walk(graph: tuple, roots: pa.Array) -> Iterator[pa.RecordBatch]:
    table, first, rows, start, target = graph
    nodes, seen = table["case_id"].to_numpy(zero_copy_only=False)[first], np.full(len(first), -1, np.int32)
    found: list[tuple[np.ndarray, ...]] = []

    def out() -> pa.RecordBatch:
        root, node, step = (np.concatenate(x) for x in zip(*found))
        found.clear()
        at, n = _runs(first[node], rows[node]), rows[node]  # a case that comes twice has two rows
        own = pa.array(np.repeat(first[root], n))
        return pa.RecordBatch.from_arrays([table["case_id"].take(pa.array(at)), table["case_id"].take(own), pa.array(np.repeat(step, n)), table["date_decision"].take(pa.array(at))],
                                          names=["case_id", "root", "step", "date_decision"])

    held = 0
    for number, root in enumerate(np.searchsorted(nodes, roots.to_numpy(zero_copy_only=False))):
        front, step = np.array([root]), 0
        while len(front):
            seen[front] = number
            found.append((np.full(len(front), root), front, np.full(len(front), step, np.int32)))
            held += len(front)
            if held >= MAX_ROWS:
                yield out()
                held = 0
            ends = target[_runs(start[front], start[front + 1] - start[front])]
            front, step = np.unique(ends[seen[ends] != number]), step + 1
    if found:
        yield out()


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one run after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


@lru_cache(maxsize=1)
def _held(step_files: Sequence[str], named_files: Sequence[str]) -> tuple:
    """Cases with their dates, sorted; where each case starts there, and its rows; where its steps start, and where they lead."""
    steps, table = _table(step_files), _table(named_files)
    table = {c: v.combine_chunks() for c, v in zip(table.column_names, table.sort_by("case_id").columns)}
    case = table["case_id"].to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.concatenate(([True], case[1:] != case[:-1])))
    a, b = (np.searchsorted(case[first], steps[c].to_numpy()).astype(np.int32) for c in ("a", "b"))
    order = np.argsort(a, kind="stable")
    return table, first, np.diff(np.append(first, len(case))), np.searchsorted(a[order], np.arange(len(first) + 1)), b[order]


def _table(files: Sequence[str]) -> pa.Table:
    parts = []
    for uri in files:
        system, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
        with system.open_input_file(path) as f:
            parts.append(pq.ParquetFile(f).read())
    return pa.concat_tables(parts)


def _doubled(steps: DataFrame, asked: DataFrame) -> DataFrame:
    """(case, root, step) by jumps, which are paths with their least number of steps.

    A round follows every jump from all that is reached, then joins the jumps with themselves, which doubles their length, so
    the longest chain takes as many rounds as its length has binary digits. Where chains cross so much that the jumps
    would outgrow the steps ``GROWTH`` times, they stay as they are, and a round goes on by their length.
    """
    jumps = cut(steps.withColumn("n", F.lit(1)))
    most = GROWTH * jumps.count()
    reach = cut(asked.select("root", F.col("root").alias("case_id"), F.lit(0).alias("step")))
    before, squaring = None, True
    while True:
        moved = reach.join(jumps, F.col("case_id") == F.col("a")).select("root", F.col("b").alias("case_id"), (F.col("step") + F.col("n")).alias("step"))
        further = cut(reach.unionByName(moved).groupBy("root", "case_id").agg(F.min("step").alias("step")))
        forget(reach)
        reach = further
        now = tuple(reach.agg(F.count("*"), F.sum("step")).first())
        if now == before:
            forget(jumps)
            return reach
        before = now
        if squaring:
            twice = jumps.alias("x").join(jumps.alias("y"), F.col("x.b") == F.col("y.a")).where(F.col("x.a") != F.col("y.b")).select("x.a", "y.b", (F.col("x.n") + F.col("y.n")).alias("n"))
            squared = cut(jumps.unionByName(twice).groupBy("a", "b").agg(F.min("n").alias("n")))
            squaring = squared.count() <= most
            forget(jumps if squaring else squared)
            jumps = squared if squaring else jumps


def citation_trend(edges: DataFrame, cases: DataFrame) -> DataFrame:
    """Citing rows per year of the citing decision."""
    years = cases.select(F.col("case_id").alias("source_case_id"), F.year("date_decision").alias("year"))
    per_source = edges.groupBy("source_case_id").agg(F.count("*").alias("n"), F.count("target_case_id").alias("resolved"))
    return per_source.join(years, "source_case_id").groupBy("year").agg(F.sum("n").alias("citations"), F.sum("resolved").alias("resolved"))
