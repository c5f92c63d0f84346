"""Trigram index of names, and similarity search in it for a table of queries.

The index holds the distinct names with their trigrams, and for every trigram posting lists of the
names that have it, by how many trigrams those have, in lists of bounded length. A name whose
similarity (common trigrams of all trigrams) to a query of ``q`` reaches ``t`` has between ``t * q`` and
``q / t`` trigrams and shares at least ``t / (1 + t) * (q + size)`` with it. So the longest lists of a query,
all but one of as many as must be shared, are skipped: whoever is similar is in the others often
enough. Only names that pass this count are compared with the query by their trigrams.

Many queries ask for the same lists again and again. Where the lists to read hold more than ``SCAN`` times as many
entries as there are names, all names are read once instead and meet the queries by sets of trigrams.

Queries and names without trigrams have no similarity. Null names are left out.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import similar_names, trigrams
from .lineage import cut, ensure_checkpoint_dir

#: names of a posting list, folders, trigrams named in a filter
LIST, BUCKETS, NAMED = 4_096, 32, 2_000

#: entries of lists read per name from which all names are read instead
SCAN = 64


@dataclass
class NameIndex:
    """``names``: id, value, grams, size; ``lists``: gram, size, part, ids; ``rarity``: gram, n."""

    names: DataFrame
    lists: DataFrame
    rarity: DataFrame


def write_names(df: DataFrame, column: str, path: str | None = None, list_size: int = LIST) -> NameIndex:
    """Index the distinct values of ``column`` under ``path``, by default a new folder in the shared one.

    The id is a hash of the name; names that collide are in the lists once and are both compared.
    """
    spark = df.sparkSession
    if path is None:
        ensure_checkpoint_dir(spark)
        path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/names-{uuid.uuid4().hex}"
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    named = values.select(F.xxhash64("value").alias("id"), "value", trigrams("value").alias("grams"))
    named.select("*", F.size("grams").alias("size")).where("size > 0").write.parquet(f"{path}/names")
    names = spark.read.parquet(f"{path}/names")
    posts = names.select("id", "size", F.explode("grams").alias("gram"))
    counts = cut(posts.groupBy("gram", "size").agg(F.count("*").alias("n")))
    parts = counts.select("gram", "size", F.ceil(F.col("n") / list_size).alias("parts"))
    dealt = posts.join(parts, ["gram", "size"]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), "parts"))
    lists = dealt.groupBy("gram", "size", "part").agg(F.array_sort(F.collect_set("id")).alias("ids")).withColumn("bucket", _bucket("gram"))
    lists.repartitionByRange("bucket", "gram", "size").sortWithinPartitions("bucket", "gram", "size").write.partitionBy("bucket").parquet(f"{path}/lists")
    counts.groupBy("gram").agg(F.sum("n").alias("n")).write.parquet(f"{path}/rarity")
    return open_names(spark, path)


def open_names(spark: SparkSession, path: str) -> NameIndex:
    lists = spark.read.schema("gram string, size int, part long, ids array<long>, bucket int").parquet(f"{path}/lists")
    return NameIndex(spark.read.parquet(f"{path}/names"), lists, spark.read.parquet(f"{path}/rarity"))


def _bucket(gram):
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def short_lists(index: NameIndex, queries: DataFrame, threshold: float) -> DataFrame:
    """Rows (query, q, skipped, gram): the lists to read, the rarest of every query."""
    asked = queries.select("query").where("query IS NOT NULL").distinct().withColumn("grams", trigrams("query")).withColumn("q", F.size("grams"))
    rare = asked.select("query", "q", F.explode("grams").alias("gram")).join(index.rarity, "gram", "left")
    ranked = rare.groupBy("query", "q").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("by_length"))
    skipped = F.ceil(F.lit(threshold) * F.col("q") - 1e-9).cast("int") - 1  # at least t * q are shared, so one of the rest is
    kept = ranked.withColumn("skipped", F.greatest(skipped, F.lit(0)))
    return kept.select("query", "q", "skipped", F.explode(F.slice("by_length", F.lit(1), F.col("q") - F.col("skipped"))).alias("s")).select(
        "query", "q", "skipped", F.col("s.gram").alias("gram"))


def candidates(index: NameIndex, queries: DataFrame, threshold: float) -> DataFrame:
    """Rows (query, id): names of a fitting size that are in enough of the short lists."""
    wanted = cut(short_lists(index, queries, threshold).withColumn("bucket", _bucket("gram")))
    lists = index.lists
    named = [r.gram for r in wanted.select("gram").distinct().limit(NAMED + 1).collect()]
    if len(named) <= NAMED:  # few enough to be named in the scan: other folders and row groups are not read
        folders = [r.bucket for r in wanted.select("bucket").distinct().collect()]
        lists = lists.where(F.col("bucket").isin(folders) & F.col("gram").isin(named))
    fits = F.col("size").between(F.ceil(threshold * F.col("q") - 1e-9), F.floor(F.col("q") / threshold + 1e-9))
    read = lists.join(wanted, ["bucket", "gram"]).where(fits).select("query", "q", "skipped", "size", F.explode("ids").alias("id"))
    least = F.ceil(threshold / (1 + threshold) * (F.col("q") + F.col("size")) - 1e-9) - F.col("skipped")
    return read.groupBy("query", "id", "q", "skipped", "size").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("query", "id").distinct()


def search_names(index: NameIndex, queries: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows (query, value, similarity): the names of the index that are similar to ``queries`` (query)."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and up to 1")
    wanted = short_lists(index, queries, threshold).join(index.rarity, "gram").agg(F.sum("n")).first()[0] or 0
    if wanted > SCAN * index.names.count():
        return similar_names(index.names, queries, threshold)
    pairs = candidates(index, queries, threshold).join(index.names, "id").withColumn("__q", trigrams("query"))
    both = F.size(F.array_intersect("grams", "__q"))
    out = pairs.select("query", "value", (both / (F.col("size") + F.size("__q") - both)).alias("similarity"))
    return out.where(F.col("similarity") >= threshold)


def trigram_search(df: DataFrame, column: str, queries: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows of ``df`` whose trigram similarity to one of ``queries`` (query) reaches the threshold, with query and similarity."""
    found = search_names(write_names(df, column), queries, threshold).withColumnRenamed("value", "__value")
    return df.join(found, F.col(column) == F.col("__value")).drop("__value")
