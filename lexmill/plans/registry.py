"""Registry: query name -> (blueprint row, Spark query, SQL check)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Inputs, oracle


@dataclass(frozen=True)
class Query:
    name: str
    row: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Inputs(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(name: str, row: str, sql: str | None = None):
    """Register a query for a blueprint row; ``sql`` is its independent check."""

    def wrap(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, row, build, oracle(sql) if sql else None)
        return build

    return wrap


def load_all() -> dict[str, Query]:
    from . import (  # noqa: F401
        q_aggregates, q_columns, q_dedup, q_filters, q_graph, q_joins, q_linking,
        q_maintenance, q_mapping, q_quality, q_sets, q_sources,
    )

    return QUERIES
