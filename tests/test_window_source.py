import csv
import random

import pytest

from lexmill.sources import readers
from lexmill.sources import window_source as S


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("source_window", "position").collect()]


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows([header, *rows])


@pytest.mark.parametrize("span", [1, 7, 50, 1 << 20])
def test_every_split_size_gives_the_same_rows(spark, tmp_path, span):
    rng = random.Random(4)
    parts = ["a", ",", '"', "\n", "\r\n", "é", " x", '""', "\n\n", '",\n"']
    rows = [(f"E{i}", "".join(rng.choices(parts, k=rng.randrange(1, 9))), "q") for i in range(60 if span > 1 else 12)]
    write(tmp_path / "w1.csv", ["ecli", "te\nxt", "last"], rows)
    got = S.read_window_splits(spark, str(tmp_path), span)
    assert rows_of(got, "ecli", "te\nxt", "last", "source_window") == [(*r, "w1") for r in rows]
    places = [r.position for r in got.collect()]
    assert len(set(places)) == len(rows)
    assert got.rdd.getNumPartitions() == 1 if span == 1 << 20 else got.rdd.getNumPartitions() > 3


def test_drifting_headers_and_odd_files(spark, tmp_path):
    (tmp_path / "2020-01.csv").write_text('ecli,celex\nE1,"C1;\nC2"\n\nE2,\nE3,""\nE4\nE5,C5,surplus')
    (tmp_path / "2020-02.csv").write_bytes(b"\xef\xbb\xbfECLI,sector,ecli\r\nE6,6,no\r\n")
    (tmp_path / "2020-03.csv").write_text("")
    (tmp_path / "2020-04.csv").write_text("ecli,alone")
    (tmp_path / "2020-05.csv").write_text("\n\n")
    out = S.read_window_splits(spark, str(tmp_path), 16)
    assert out.columns == ["ecli", "celex", "sector", "alone", "source_window", "position"]
    assert rows_of(out, "ecli", "celex", "sector", "source_window") == [
        ("E1", "C1;\nC2", None, "2020-01"), ("E2", None, None, "2020-01"), ("E3", "", None, "2020-01"), ("E4", None, None, "2020-01"),
        ("E5", "C5", None, "2020-01"), ("E6", None, "6", "2020-02")]


def test_no_files_and_compressed_files(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.csv").write_text("")
    assert S.read_window_splits(spark, str(tmp_path / "e")).collect() == []
    (tmp_path / "e" / "y.csv.gz").write_bytes(b"0")
    with pytest.raises(ValueError, match="compressed"):
        S.read_window_splits(spark, str(tmp_path / "e"))


def test_a_long_body_lies_in_several_ranges(spark, tmp_path):
    body = 'line "one"\n' * 40000
    write(tmp_path / "a.csv", ["ecli", "text"], [("E1", "s"), ("E2", body), ("E3", "t")])
    out = S.read_window_splits(spark, str(tmp_path), 1 << 15)
    assert rows_of(out, "ecli", "text") == [("E1", "s"), ("E2", body), ("E3", "t")]
    old = readers.read_window_csv(spark, str(tmp_path))
    assert sorted(map(tuple, old.select("ecli", "text").collect())) == sorted(rows_of(out, "ecli", "text"))
