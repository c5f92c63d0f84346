import json

from lexmill.streaming import state as S


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def paths(tmp_path):
    return tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ck")


def test_first_rows(spark, tmp_path):
    src, table, ck = paths(tmp_path)
    schema = "n long, ecli string, language string, text string"
    run = lambda: S.run_to_end(S.first_rows(spark.readStream.schema(schema).json(str(src)), ["ecli", "language"], "n"), table, ck)
    drop(src, "1.json", [{"n": 2, "ecli": "E1", "language": "EN", "text": "late"}, {"n": 1, "ecli": "E1", "language": "EN", "text": "a"}, {"n": 3, "ecli": None, "language": "EN", "text": "x"}])
    run()
    drop(src, "2.json", [{"n": 0, "ecli": "E1", "language": "EN", "text": "again"}, {"n": 5, "ecli": "E2", "language": "EN", "text": None}])
    last = run()
    assert sorted((r.ecli, r.text, r.n) for r in spark.read.parquet(table).collect()) == [("E1", "a", 1), ("E2", None, 5)]
    # the second batch wrote the state of its new key only
    assert sum(op.numRowsUpdated for p in last.recentProgress for op in p.stateOperators) == 1
    run()
    assert spark.read.parquet(table).count() == 2


def test_running_counts(spark, tmp_path):
    src, table, ck = paths(tmp_path)
    schema = "old_source long, old_target long, new_source long, new_target long"
    run = lambda: S.run_to_end(S.running_counts(spark.readStream.schema(schema).json(str(src))), table, ck)
    drop(src, "1.json", [{"new_source": 1, "new_target": 2}, {"new_source": 1, "new_target": 3}, {"old_source": 9, "old_target": 2}])
    run()
    drop(src, "2.json", [{"old_source": 1, "old_target": 3}, {"new_source": 9, "new_target": 9}])
    run()
    got = sorted(tuple(r) for r in S.newest(spark.read.parquet(table), "case_id").select("case_id", "cites_count", "cited_by_count").collect())
    assert got == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (9, 0, 1)]


def test_newest_states(spark, tmp_path):
    src, table, ck = paths(tmp_path)
    run = lambda: S.run_to_end(S.newest_states(spark.readStream.schema("window_id string, status string, event_id long").json(str(src))), table, ck)
    drop(src, "1.json", [{"window_id": "a", "status": "pending", "event_id": 1}, {"window_id": "a", "status": "completed", "event_id": 7}, {"window_id": "b", "status": "failed", "event_id": 2}])
    run()
    drop(src, "2.json", [{"window_id": "a", "status": "in_progress", "event_id": 3}, {"window_id": "b", "status": "exhausted", "event_id": 9}, {"window_id": "c", "status": None, "event_id": 1}])
    run()
    rows = spark.read.parquet(table)
    assert sorted(((r.window_id, r.status) for r in S.newest(rows, "window_id").collect()), key=str) == [("a", "completed"), ("b", "exhausted"), ("c", None)]
    assert rows.count() == 4  # a batch adds rows of the keys it changes


def test_running_counts_hold_their_sums_in_the_engine(spark, tmp_path):
    src, table, ck = paths(tmp_path)
    schema = "old_source long, old_target long, new_source long, new_target long"
    job = lambda: S.running_counts(spark.readStream.schema(schema).json(str(src)))
    drop(src, "1.json", [{"new_source": 1, "new_target": 2}, {"old_source": 3, "new_target": None}])
    assert "Python" not in job()._jdf.queryExecution().analyzed().toString()  # no call of a processor for each key
    S.run_to_end(job(), table, ck)
    drop(src, "2.json", [{"new_source": 1, "new_target": 1}])
    S.run_to_end(job(), table, ck)
    rows = spark.read.parquet(table)
    assert rows.count() == 4 and sorted(map(tuple, S.newest(rows, "case_id").collect())) == [(1, 2, 1), (2, 0, 1), (3, 0, 0)]
    S.run_to_end(job(), table, ck)  # nothing new: no further rows
    assert spark.read.parquet(table).count() == 4


def test_first_rows_are_found_by_the_engine(spark, tmp_path):
    src, table, ck = paths(tmp_path)
    schema = "n long, ecli string, text string"
    job = lambda: S.first_rows(spark.readStream.schema(schema).json(str(src)), ["ecli"], "n")
    drop(src, "1.json", [{"n": None, "ecli": "E1", "text": "unnumbered"}, {"n": 7, "ecli": "E1", "text": "b"}, {"n": 4, "ecli": "E1", "text": "a"}, {"n": None, "ecli": "E3", "text": None}])
    drop(src, "2.json", [{"n": 3, "ecli": "E1", "text": "same batch"}, {"n": 1, "ecli": None, "text": "no key"}])
    assert "Python" not in job()._jdf.queryExecution().analyzed().toString()  # no call of a processor for each key
    S.run_to_end(job(), table, ck)
    drop(src, "3.json", [{"n": 0, "ecli": "E1", "text": "again"}, {"n": 2, "ecli": "E2", "text": "c"}])
    S.run_to_end(job(), table, ck)
    S.run_to_end(job(), table, ck)  # nothing new: no further rows
    assert sorted((r.ecli, r.n, r.text) for r in spark.read.parquet(table).collect()) == [("E1", 3, "same batch"), ("E2", 2, "c"), ("E3", None, None)]
