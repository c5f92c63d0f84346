import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lexmill.sources import readers, writers
from lexmill.streaming import jobs


def test_window_csv_with_drifting_headers(spark, tmp_path):
    (tmp_path / "2020-01.csv").write_text('ecli,celex\nE1,"C1;\nC2"\nE2,\n')
    (tmp_path / "2020-02.csv").write_text("ecli,sector\nE3,6\n")
    (tmp_path / "2020-03.csv").write_text("")
    out = readers.read_window_csv(spark, str(tmp_path)).orderBy("ecli").collect()
    assert [(r.ecli, r.celex, r.sector, r.source_window) for r in out] == [
        ("E1", "C1;\nC2", None, "2020-01"), ("E2", None, None, "2020-01"), ("E3", None, "6", "2020-02")]


def test_window_json_rejects_and_positions(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"ecli": "E1", "n": 3, "x": {"b": 1, "a": "q"}}, 5, {"ecli": "E2", "text": "t"}]))
    (tmp_path / "b.json").write_text("{not json")
    (tmp_path / "c.json").write_text('{"ecli": "E9"}')
    rows, rejects = readers.read_window_json(spark, str(tmp_path))
    assert rows.columns[:2] == ["ecli", "text"]
    assert [(r.ecli, r.position, r.n, r.x) for r in rows.orderBy("position").collect()] == [("E1", 0, "3", '{"a": "q", "b": 1}'), ("E2", 2, None, None)]
    assert sorted((r.source_window, r.reason) for r in rejects.collect()) == [("b", "malformed"), ("c", "not a list")]


def test_checked_write_publishes_or_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_checked(spark.range(1200), path, expected=1200, rows_per_group=500) == 1200
    with pytest.raises(writers.RowCountError):
        writers.write_checked(spark.range(5), path, expected=6)
    assert spark.read.parquet(path).count() == 1200
    writers.write_corpus(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_row_groups_are_small(spark, tmp_path):
    path = tmp_path / "t"
    writers.write_corpus(spark.range(2000).coalesce(1), str(path), rows_per_group=500)
    meta = pq.ParquetFile(next(path.glob("*.parquet"))).metadata
    assert meta.num_row_groups >= 4 and meta.row_group(0).column(0).compression == "ZSTD"


def test_target_list_needs_its_columns(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("case\tecli\nx\te1\n")
    with pytest.raises(ValueError, match="celex"):
        readers.read_targets_tsv(spark, str(tmp_path / "t.tsv"))


def test_archive_is_never_overwritten(spark, tmp_path):
    path = str(tmp_path / "a")
    writers.archive_rows(spark.range(2), path)
    with pytest.raises(Exception):
        writers.archive_rows(spark.range(2), path)


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_stream_appends_new_files_once(spark, tmp_path):
    src, table, ck = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ck")
    run = lambda: jobs.append_window_files(spark, str(src), "ecli string, language string, text string", table, ck).awaitTermination()
    drop(src, "1.json", [{"ecli": "E1", "language": "en", "text": "a"}])
    run()
    drop(src, "2.json", [{"ecli": "E1", "language": "EN", "text": "late"}, {"ecli": "E2", "language": "en", "text": "b"}])
    run()
    run()
    assert sorted((r.ecli, r.text) for r in jobs.appended(spark, table).collect()) == [("E1", "a"), ("E2", "b")]
    # a batch writes its own rows only
    assert jobs.latest(spark, table).count() == 1


def test_stream_maintains_counts(spark, tmp_path):
    src, table, ck = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ck")
    run = lambda: jobs.maintain_counts(spark, str(src), table, ck).awaitTermination()
    drop(src, "1.json", [{"new_source": 1, "new_target": 2}, {"new_source": 1, "new_target": 3}])
    run()
    drop(src, "2.json", [{"old_source": 1, "old_target": 3}])
    run()
    assert sorted(tuple(r) for r in jobs.latest(spark, table).select("case_id", "cites_count", "cited_by_count").collect()) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    for i in range(3, 6):
        drop(src, f"{i}.json", [{"new_source": i, "new_target": 1}])
        run()
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("v=")]) == 2
    assert jobs.latest(spark, table).where("case_id = 1").first().cited_by_count == 3


def test_window_json_of_any_size(spark, tmp_path):
    body = "x" * 1000
    items = [{"ecli": f"E{i}", "text": body, "n": i, "ok": True, "f": 1.5} for i in range(20_000)]
    (tmp_path / "big.json").write_text(json.dumps(items, indent=1))
    assert (tmp_path / "big.json").stat().st_size > 20 << 20
    (tmp_path / "one.json").write_text(json.dumps([{"ecli": "L", "text": "é" * (17 << 20)}]), encoding="utf-8")
    (tmp_path / "cut.json").write_text(json.dumps(items[:3])[:-2])
    (tmp_path / "tail.json").write_text("[] x")
    (tmp_path / "none.json").write_text(" [ ] ")
    rows, rejects = readers.read_window_json(spark, str(tmp_path))
    assert rows.count() == 20_001
    r = rows.where("ecli = 'E777'").first()
    assert (r.position, r.text, r.n, r.ok, r.f, r.source_window) == (777, body, "777", "true", "1.5", "big")
    assert rows.where("ecli = 'L'").selectExpr("length(text)").first()[0] == 17 << 20
    assert sorted((r.source_window, r.reason) for r in rejects.collect()) == [("cut", "malformed"), ("tail", "malformed")]


def test_nested_json_beyond_the_parse_limit_is_kept(spark, tmp_path):
    nested = {"b": ["é" * 1000] * 11_000, "a": {"n": 1}}
    (tmp_path / "big.json").write_text(json.dumps([{"ecli": "E1", "x": nested}, {"ecli": "E2", "x": {"b": [2, 1], "a": None}}], ensure_ascii=False), encoding="utf-8")
    assert (tmp_path / "big.json").stat().st_size > 20 << 20
    rows, rejects = readers.read_window_json(spark, str(tmp_path))
    got = {r.ecli: r.x for r in rows.collect()}
    assert json.loads(got["E1"]) == nested and got["E1"].startswith('{"a": {"n": 1}, "b": ["') and rejects.count() == 0
    assert got["E2"] == '{"a": null, "b": [2, 1]}'
