"""Running a maintenance job again changes nothing; order of arrival is respected."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import filters
from lexmill.operators import maintenance as M
from lexmill.operators import quality

TEXT = "text_id long, ecli string, language string, text string"


def table(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture
def old(spark):
    return spark.createDataFrame([(1, "E1", "en", "a"), (2, "E1", "fr", "b"), (3, "E2", "en", "c")], TEXT)


@pytest.fixture
def new(spark):
    return spark.createDataFrame([(10, "E1", "EN", "x"), (11, "E3", "de", "y"), (12, "E3", "de", "z")], TEXT)


def test_append_is_idempotent(old, new):
    once = M.append_rows(old, new)
    assert {r.text_id for r in once.collect()} == {1, 2, 3, 11, 12}
    assert table(M.append_rows(once, new)) == table(once)


def test_replace_is_idempotent(old, new):
    new = new.withColumn("position", F.col("text_id"))
    once, dropped = M.replace_rows(old, new, "position")
    assert {r.text_id for r in once.collect()} == {2, 3, 10, 12} and [r.text_id for r in dropped.collect()] == [1]
    assert table(M.replace_rows(once, new, "position")[0]) == table(once)


def test_insert_absent_null_keys(spark):
    new = spark.createDataFrame([(1, None), (2, None), (3, "a")], "i int, k string")
    held = spark.createDataFrame([("a",)], "k string")
    assert [r.i for r in M.insert_absent(held, new, ["k"], [F.col("i").asc()]).collect()] == [1]


def test_sync_follows_arrival_order(spark):
    cols = "text_id long, case_id long, language string, text_source string, text string"
    stored = spark.createDataFrame([(1, 7, "en", "A", "old"), (2, 7, "en", "RECHTSPRAAK", "rs"), (3, 8, "en", "A", "same")], cols)
    incoming = spark.createDataFrame([(1, 7, "en", "B", "new"), (2, 7, "en", "A", "again"), (3, 8, "EN", "A", "same"), (4, 9, "en", "A", "first"), (5, 9, "en", "B", "second")],
                                     "position long, case_id long, language string, text_source string, text string")
    got = {r.position: (r.action, r.target_id) for r in M.sync_texts(stored, incoming).collect()}
    # the upgrade turns row 1 into source B, so the next text of source A upgrades it again
    assert got == {1: ("upgrade", 1), 2: ("upgrade", 1), 3: ("unchanged", 3), 4: ("insert", None), 5: ("upgrade", None)}


def test_count_deltas_floor_at_zero(spark):
    counts = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "case_id long, cites_count long, cited_by_count long")
    changes = spark.createDataFrame([(1, 2, None, None), (1, 2, None, None), (None, None, 3, 1)], "old_source long, old_target long, new_source long, new_target long")
    assert sorted(tuple(r) for r in M.apply_count_deltas(counts, changes).collect()) == [(1, 0, 1), (2, 0, 0), (3, 1, 0)]


def test_rekey_twice(spark):
    df = spark.createDataFrame([(1, 1, "S", "english", "sum"), (2, 1, "S", "en", None), (3, 2, "S", "dutch", None)], "text_id long, case_id long, text_source string, language string, summary string")
    once = M.rekey_language(df)
    assert sorted((r.text_id, r.language, r.summary) for r in once.collect()) == [(2, "en", "sum"), (3, "nl", None)]
    assert table(M.rekey_language(once)) == table(once)


def test_windows_clip(spark):
    span = spark.createDataFrame([("2020-01-15", "2020-03-02")], "start string, end string").select(F.col("start").cast("date"), F.col("end").cast("date"))
    got = [(r.window_id, str(r.sd), str(r.ed)) for r in M.windows(span, "month").orderBy("window_id").collect()]
    assert got == [("2020-01", "2020-01-15", "2020-01-31"), ("2020-02", "2020-02-01", "2020-02-29"), ("2020-03", "2020-03-01", "2020-03-02")]
    assert M.windows(span.select(F.col("end").alias("start"), F.col("start").alias("end")), "year").count() == 0


def test_guards_stop(spark):
    df = spark.createDataFrame([("ECLI:NL:X",), ("ECLI:EU:C:1",)], "ecli string")
    with pytest.raises(Exception, match="may not be processed"):
        filters.guard_or_fail(df, "ECLI:NL:").collect()
    links = spark.createDataFrame([("d1",)], "source_dataset string")
    with pytest.raises(RuntimeError, match="not registered"):
        filters.assert_dark(links, spark.createDataFrame([], "source_dataset string, counted boolean, active boolean"))
    with pytest.raises(RuntimeError, match="preflight"):
        quality.preflight(spark.createDataFrame([("E", "C")], "ecli string, celex string"), spark.createDataFrame([], "text_id long, ecli string, celex string, language string, text_source string, text string"))


def test_gates(spark):
    report = spark.createDataFrame([("duplicate_case_eclis", 0), ("cases_rows", 46_000), ("malformed_celex", 2)], "metric string, value long")
    bad = {r.metric for r in quality.publish_gates(report, quality.gate_rules(spark)).collect()}
    assert "cases_rows" not in bad and "duplicate_case_eclis" not in bad and {"malformed_celex", "lost_eclis", "fulltexts_rows"} <= bad


def test_deleted_case_without_ecli_leaves_no_link(spark):
    edges = spark.createDataFrame([("e1", 1, 2, "cites", "d", None, None)], "edge_id string, source_case_id long, target_case_id long, relation_type string, source_dataset string, target_ecli_raw string, target_celex_raw string")
    cases = spark.createDataFrame([(1, "E1", None), (2, None, "62001CJ0001")], "case_id long, ecli string, celex_id string")
    after, _ = M.delete_cases(edges, cases, spark.createDataFrame([(2,)], "case_id long"))
    r = after.first()
    assert (r.target_case_id, r.target_ecli_raw, r.target_celex_raw) == (None, None, "62001CJ0001")


def test_namesakes_that_nobody_listed_stay_apart(spark):
    people = spark.createDataFrame([(1, "Rossi", []), (2, "Rossi", []), (3, "Rosi", ["R."]), (4, "Bianchi", []), (5, "Verdy", [])], "person_id long, full_name string, aliases array<string>")
    links = spark.createDataFrame([(10, 1, "judge"), (10, 2, "judge"), (11, 3, "judge"), (12, 5, "judge")], "case_id long, person_id long, role string")
    none = spark.createDataFrame([], "old_name string, new_name string")
    same, kept = M.merge_people(people, links, none)
    assert same.count() == 5 and sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in links.collect())
    some = spark.createDataFrame([("Rosi", "Rossi"), ("Verdy", "Verdi")], "old_name string, new_name string")
    merged, moved = M.merge_people(people, links, some)
    assert sorted((r.person_id, r.full_name, tuple(r.aliases)) for r in merged.collect()) == [(1, "Rossi", ("R.", "Rosi")), (2, "Rossi", ()), (4, "Bianchi", ()), (5, "Verdi", ("Verdy",))]
    assert sorted((r.case_id, r.person_id) for r in moved.collect()) == [(10, 1), (10, 2), (11, 1), (12, 5)]


def test_rollback_keeps_rows_without_dataset(spark):
    live = spark.createDataFrame([("a", None), ("b", "new")], "edge_id string, source_dataset string")
    archive = spark.createDataFrame([("c", "old")], "edge_id string, source_dataset string")
    assert sorted(r.edge_id for r in M.rollback_swap(live, archive, "new").collect()) == ["a", "c"]


def test_two_open_rows_become_one_link(spark):
    from lexmill.operators import linking

    edges = spark.createDataFrame([("e2", 1, None, "cites", "rs_x", "E9", None), ("e1", 1, None, "cites", "rs_x", "E9", None)], "edge_id string, source_case_id long, target_case_id long, relation_type string, source_dataset string, target_ecli_raw string, target_celex_raw string")
    new = spark.createDataFrame([(9, "E9", None)], "case_id long, ecli string, celex_id string")
    assert [r.edge_id for r in linking.link_existing(edges, new).collect()] == ["e1"]
