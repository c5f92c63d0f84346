"""Texts without an owner are most texts: they must not meet in one task."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import quality as Q


@pytest.fixture
def by_shuffle(spark):
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(key, value)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def largest(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_ownerless_texts_are_dealt_apart(spark, by_shuffle):
    n = 240
    cases = spark.createDataFrame([(i, f"ECLI:EU:C:1995:{i}", f"61995CJ{i:04d}", f"C-{i}/95", None, "judgment") for i in range(n)],
                                  "case_id long, ecli string, celex_id string, case_number string, date_decision date, doctype string")
    stored = spark.createDataFrame([(i, i, "en", "CELLAR_ITEM", f"61999CJ{i:04d} text {i}") for i in range(n)],
                                   "text_id long, case_id long, language string, text_source string, text string")
    corpus = spark.createDataFrame([], "text_id long, ecli string, language string, text_source string, text string")
    classified = Q.classify_texts(stored, cases, corpus, cases.select("ecli", F.col("celex_id").alias("celex")))
    assert classified.count() == n and largest(classified) < n / 2
    plan = Q.cleanup_plan(classified, cases, stored)
    assert largest(plan) < n / 2
    assert {(r.action, r.owner_id, r.new_kind, r.new_celex) for r in plan.collect()} == {("keep: owner unknown", None, None, None)} and plan.count() == n
