"""Filters and search predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def filter_cases(cases: DataFrame, start: str | None = None, end: str | None = None, sector: str | None = None) -> DataFrame:
    """Publication date (first token) inside the range, sector equal."""
    day = X.parse_date(X.first_tok("date_publication"))
    if start:
        cases = cases.where(day >= F.lit(start).cast("date"))
    if end:
        cases = cases.where(day <= F.lit(end).cast("date"))
    return cases.where(F.col("sector") == sector) if sector else cases


def filter_keywords(cases: DataFrame, column: str, keywords: Sequence[str]) -> DataFrame:
    """Every keyword occurs somewhere in the cell, letter case ignored."""
    cell = F.lower(F.coalesce(F.col(column), F.lit("")))
    for keyword in keywords:
        cases = cases.where(F.contains(cell, F.lit(keyword.lower())))
    return cases


def tokens(c) -> Column:
    """Lower-cased word tokens without stemming or stop words."""
    return F.filter(F.split(F.lower(X.as_col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def text_match(c, terms: Sequence[str] = (), phrase: Sequence[str] = (), mode: str = "all") -> Column:
    """Term match on tokens (all or any), and optionally consecutive words."""
    words = tokens(c)
    wanted = F.array(*[F.lit(w.lower()) for w in terms])
    test = F.lit(True)
    if terms and mode == "any":
        test = F.arrays_overlap(words, wanted)
    elif terms:
        test = F.size(F.array_except(wanted, words)) == 0
    if phrase:
        run = F.lit(" " + " ".join(w.lower() for w in phrase) + " ")
        test = test & F.contains(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), run)
    return F.coalesce(test, F.lit(False))


def cases_with_articles(articles: DataFrame, codes: Sequence[str], kind: str, mode: str = "any") -> DataFrame:
    """Documents with any, or all, of the article codes of a kind."""
    hits = articles.where((F.col("kind") == kind) & F.col("article_code").isin(list(codes)))
    pairs = hits.select("item_id", "article_code").distinct()
    need = len(set(codes)) if mode == "all" else 1
    return pairs.groupBy("item_id").agg(F.count("*").alias("n")).where(F.col("n") >= need).select("item_id")


def filter_domains(df: DataFrame, column: str, domains: Sequence[str]) -> DataFrame:
    return df.where(F.arrays_overlap(column, F.array(*[F.lit(d) for d in domains])))


def in_corpus(df: DataFrame, corpus: str, column: str = "sources") -> DataFrame:
    return df.where(F.array_contains(column, corpus))


def number_like(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """Case-insensitive substring of any of the columns."""
    pattern = "%" + part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    test = F.lit(False)
    for column in columns:
        test = test | F.coalesce(F.col(column).ilike(pattern), F.lit(False))
    return df.where(test)


def judgments_decisions(docs: DataFrame) -> DataFrame:
    """Judgments and decisions; press items are left out."""
    kind = F.col("doctype")
    return docs.where((kind.ilike("%JUD%") | kind.ilike("%DEC%")) & ~kind.isin("PR", "CLIN", "CLINF"))


def always_null_columns(df: DataFrame, protect: Sequence[str]) -> list[str]:
    """Columns null or blank in every row, found in one aggregation."""
    columns = [c for c in df.columns if c not in set(protect)]
    if not columns:
        return []
    row = df.agg(*[F.bool_or(~X.is_blank(F.col(c).cast("string"))).alias(c) for c in columns]).first()
    return [c for c in columns if not row[c]]


def drop_always_null(df: DataFrame, protect: Sequence[str] = ("ecli", "celex", "sector", "source_window")) -> DataFrame:
    return df.drop(*always_null_columns(df, protect))


def guard_ecli(df: DataFrame, allowed_prefix: str, column: str = "ecli") -> tuple[DataFrame, DataFrame]:
    """(allowed rows, rejected rows): only ECLIs of the allowed corpus may be processed."""
    allowed = F.coalesce(F.upper(X.strip(column)).startswith(allowed_prefix), F.lit(False))
    return df.where(allowed), df.where(~allowed)


def guard_or_fail(df: DataFrame, allowed_prefix: str, column: str = "ecli") -> DataFrame:
    """Same guard before a write: a forbidden row stops the job."""
    allowed = F.coalesce(F.upper(X.strip(column)).startswith(allowed_prefix), F.lit(False))
    failure = F.raise_error(F.concat(F.lit("row may not be processed: "), F.coalesce(F.col(column), F.lit("null"))))
    return df.withColumn(column, F.when(allowed, F.col(column)).otherwise(failure.cast("string")))


def dark_violations(links: DataFrame, datasets: DataFrame) -> DataFrame:
    """Datasets of the links that are unregistered, counted or active, with the reason."""
    used = links.groupBy("source_dataset").agg(F.count("*").alias("links"))
    known = datasets.select("source_dataset", "counted", "active", F.lit(True).alias("registered"))
    reason = X.first_rule([
        (F.col("registered").isNull(), F.lit("not registered")),
        (F.col("counted"), F.lit("counted")), (F.col("active"), F.lit("active"))])
    return used.join(known, "source_dataset", "left").withColumn("reason", reason).where(
        "reason IS NOT NULL").select("source_dataset", "links", "reason")


def assert_dark(links: DataFrame, datasets: DataFrame) -> None:
    """Stop if any dataset of the links is not dark (the list is one row per dataset)."""
    bad = dark_violations(links, datasets).limit(20).collect()
    if bad:
        raise RuntimeError(f"datasets not dark: {[(r.source_dataset, r.reason) for r in bad]}")
