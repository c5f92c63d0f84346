"""Files of windows: their number grows with the bodies, not with the bodies times the windows."""

import json

from pyspark.sql import functions as F

from lexmill.plans.q_sources import _json_lists


def test_a_window_is_cut_by_its_own_bodies(spark):
    texts = spark.range(400).select(
        F.lit("E").alias("ecli"), F.col("id").alias("text_id"), F.lit("S").alias("text_source"), F.when(F.col("id") != 7, F.repeat(F.lit("x"), 10_000)).alias("text"),
        F.lit(10_000).alias("n_chars"), F.when(F.col("id") >= 300, F.concat(F.lit("w"), F.col("id") % 40)).when(F.col("id") < 290, "large").alias("source_window"))
    lists = _json_lists(texts).collect()
    assert sum(r.source_window == "large" for r in lists) == 2 and len(lists) == 2 + 1 + 40
    assert sorted(item["text_id"] for r in lists for item in json.loads(r.value)) == list(range(400))
