"""Shuffles of a plan: each is bytes on the disks of the executors."""

from lexmill.operators.aggregates import refresh_counts
from lexmill.operators.communities import weights
from lexmill.operators.joins import match_by_date_and_token
from lexmill.operators.linking import stage_to_edges
from lexmill.operators.mapping import load_people, map_cases
from lexmill.operators.sets import compare_edges, provision_labels


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_edge_builds_are_compared_in_one_shuffle(spark):
    schema = "source_case_id long, target_case_id long"
    old, new = spark.createDataFrame([(1, 2), (1, 2), (3, None), (5, 6)], schema), spark.createDataFrame([(1, 2), (3, None), (7, 8), (7, 8)], schema)
    out = compare_edges(old, new)
    assert exchanges(out) == 1
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, "kept"), (3, None, "kept"), (5, 6, "dropped"), (7, 8, "added")]


def test_links_are_weighed_in_one_shuffle(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (3, 1), (4, 4), (4, 4), (None, 1), (5, None)], "source_case_id long, target_case_id long")
    out = weights(edges)
    assert exchanges(out) == 1
    assert sorted(map(tuple, out.collect())) == [(1, 2, 2), (1, 3, 1), (2, 1, 2), (3, 1, 1), (4, 4, 2)]


def test_cells_of_a_case_are_read_once(spark):
    columns = "ecli celex title date_publication formation sector type_procedure language_procedure agents subject_matter judges cites origin_country".split()
    row = {"ecli": "E1", "celex": "62000CJ0001", "judges": " ;A; B;A", "agents": "X", "origin_country": "NL", "cites": "1;2"}
    corpus = spark.createDataFrame([tuple(row.get(c) for c in columns)] * 2, ", ".join(f"{c} string" for c in columns))
    satellites = map_cases(corpus)["satellite"]
    plan = satellites._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1 and "Union" not in plan
    got = {(r.kind, r.value) for r in satellites.collect()}
    assert got == {("judge:judge", "A"), ("judge:judge", "B"), ("judge:rapporteur", "A"), ("party:agent", "X"), ("party:referring_state", "NL"), ("cite:cites", "1"), ("cite:cites", "2")}
    names = spark.createDataFrame([("B",)], "name string")
    parties = spark.createDataFrame([("X", "agent")], "name string, role_class string")
    out = {k: sorted(map(tuple, v.collect())) for k, v in load_people(satellites.unionByName(satellites), names, parties).items()}
    assert out == {"judge": [("A",)], "case_judge": [("E1", "judge", "A"), ("E1", "judge", "B"), ("E1", "rapporteur", "A")],
                   "party": [("NL", "state")], "case_party": [("E1", "agent", "X", "agent"), ("E1", "referring_state", "NL", "state")]}


def test_staged_rows_meet_documents_that_are_resolved_once(spark):
    staged = spark.createDataFrame([("r2", "scl_judgment", "i1", "i2"), ("r1", "scl_judgment", "i1b", "i2"), ("r0", "scl_judgment", "i1", "i3"), ("r3", "scl_judgment", "i1", "i1b"),
                                    ("r4", "scl_judgment", "i1", "gone"), ("r5", "scl_judgment", "i4", "i1"), ("r6", "scl_judgment", None, "i1")],
                                   "staged_id string, rule string, source_item_id string, target_item_id string")
    documents = spark.createDataFrame([("i1", "E1"), ("i1b", "E1"), ("i2", "E2"), ("i3", None), ("i4", "unknown")], "item_id string, ecli string")
    cases = spark.createDataFrame([("i1", "E1", 10), ("i1b", "E1", 11), ("i2", "E2", 20), ("i3", None, 30)], "item_id string, ecli string, case_id long")
    out = stage_to_edges(staged, cases, documents)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "source_ecli" not in plan and "target_ecli" not in plan  # no key of a document travels with the staged rows
    got = sorted((r.source_case_id, r.target_case_id, r.staged_id) for r in out.collect())
    assert got == [(10, 20, "r1"), (10, 30, "r0")]
    named = staged.join(documents.toDF("source_item_id", "source_ecli"), "source_item_id").join(documents.toDF("target_item_id", "target_ecli"), "target_item_id")
    assert sorted((r.source_case_id, r.target_case_id, r.staged_id) for r in stage_to_edges(named, cases).collect()) == got


def test_edges_are_not_dealt_by_relation_type(spark):
    edges = spark.createDataFrame([(1, 2, "cites", "a"), (1, 2, "appeal", "a"), (2, 1, "cites", "b"), (3, 2, "joins", "a"), (3, 3, "cites", "a"), (3, None, "cites", "a"), (4, 1, "cites", "a"),
                                   (5, 1, "cites", "c")], "source_case_id long, target_case_id long, relation_type string, source_dataset string")
    relations = spark.createDataFrame([("cites", True), ("appeal", True), ("joins", False)], "relation_type string, counted boolean")
    datasets = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "source_dataset string, counted boolean")
    cases = spark.range(1, 6).withColumnRenamed("id", "case_id")
    subset = spark.createDataFrame([(1,), (1,), (3,), (None,), (9,)], "case_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        every, some = refresh_counts(edges, relations, datasets, cases), refresh_counts(edges, relations, datasets, cases, subset)
        for out in (every, some):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin [relation_type" not in plan and "SortMergeJoin [source_dataset" not in plan
        assert sorted(map(tuple, every.collect())) == [(1, 1, 2), (2, 1, 1), (3, 0, 0), (4, 1, 0), (5, 0, 0)]
        assert sorted(map(tuple, some.collect())) == [(1, 1, 2), (3, 0, 0)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_labels_of_references_meet_their_case_once(spark):
    refs = spark.createDataFrame([(1, "bwb", "R1", "1", 7, "Wet 1"), (1, "bwb", "R1", "1", 7, "Wet 1"), (2, "bwb", "R1", "A", None, ""), (3, "bwb", "R2", None, 8, None), (4, None, "R1", "1", 7, "no"),
                                  (5, "bwb", None, "1", 7, "lost"), (6, "bwb", "R1", "", None, None)],
                                 "case_id long, raw_scheme string, raw_resource string, raw_subdivision string, raw_label_id long, raw_reference string")
    cases = spark.createDataFrame([(1, "E1"), (2, "E1"), (3, "E3"), (4, "E4"), (6, "E6")], "case_id long, ecli string")
    acts = spark.createDataFrame([("R1", "Act"), ("R2", "")], "bwb_id string, title string")
    provisions = spark.createDataFrame([("R1", "artikel", 7, "1", "first"), ("R1", "artikel", 7, "a", "letter"), ("R1", "wet", 7, "1", "Act"), ("R2", "artikel", 8, "1", ""), ("R2", "artikel", 8, None, "bare")],
                                       "bwb_id string, element_type string, bwb_label_id long, number string, title string")
    out = provision_labels(refs, cases, acts, provisions)
    assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1  # the case; the catalogue is met unsorted
    assert sorted(map(tuple, out.collect())) == sorted([
        ("E1", "Wet 1"), ("E1", "first"), ("E1", "letter"), ("E1", "Act"), ("E1", "Act, Artikel 1"), ("E1", "Act, Bijlage 1"), ("E1", "Act, Artikel A"), ("E1", "Act, Bijlage A"), ("E3", "bare"), ("E6", "Act")])


def test_dates_of_all_cases_are_not_broadcast(spark):
    from lexmill.plans.registry import load_all

    out = load_all()["targets_not_in_the_future"](spark, "/root/testdata/sf0.001")
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_a_date_and_token_are_not_held(spark):
    schema = "doc_id long, date_decision string, zaaknummer string, instance string"
    numbers = [(7, "d1", "AWB 12 / 345", "A"), (7, "d1", "AWB 12 / 345", "A"), (7, "d1", "awb12/3456", "A"), (7, "d1", "AWB 12 / 345", "B"), (7, "d2", "AWB 12 / 345", "A"), (8, "d1", "AWB 9 / 1234", None),
               (None, "d1", "C 12/345", "A"), (None, "d1", "D 12/345", "A"), (9, "d1", "12/", "A"), (9, "d1", None, "A"), (10, None, "AWB 12 / 345", "A"), (11, "d3", "AWB 12 / 345", "A")]
    tokens = [(1, "d1", "12/345"), (1, "d1", "12/345"), (2, "d1", "12/345"), (3, "d1", "awb1"), (4, "d1", "345awb"), (5, "d1", "345 awb"), (6, "d1", "12/"), (None, "d1", "12/3456"), (8, "d2", "12/345"), (9, None, "12/345"), (10, "d1", None)]
    entries, docs = spark.createDataFrame(tokens, "e long, date_decision string, token string"), spark.createDataFrame(numbers, schema)
    out = match_by_date_and_token(entries, docs)
    assert out.columns == ["e", "date_decision", "token", "doc_id", "instance"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[:plan.index("Join")]  # pairs are distinct as the join gives them
    plain = lambda s: "".join((s or "").lower().split())
    want = {(e, d, t, i, c) for e, d, t in tokens for i, day, z, c in numbers if d and d == day and t and len(t) >= 4 and t in plain(z)}
    got = [*map(tuple, out.collect())]
    assert len(got) == len(want) and set(got) == want and len(want) == 10
