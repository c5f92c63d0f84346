"""The pipeline on a small table, stage by stage against plain Python."""

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from lexmill.llm import tokens
from lexmill.llm.queries import QUERIES, SQL
from lexmill.operators.lineage import cut

from .test_mixing import targets


def small_tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int(not (r[1] or "").startswith("###")), 0) for r in rows if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    folder = str(tmp_path_factory.mktemp("sf"))
    prose = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    item = prose(40)
    rows = [(i, prose(rng.randrange(40, 200)), "en", f"src{i % 3}", 1) for i in range(120)]
    rows += [(200 + i, "### " + " ".join(["$$$ ###"] * 60) + f" {i} $ % ^ " + "@ # ! " * i, "en", "src0", 1) for i in range(60)]
    rows += [(300 + i, rows[i][1] + " tail", "en", "src1", 1) for i in range(10)]  # near copies
    rows += [(320 + i, rows[20 + i][1], "en", "src2", 1) for i in range(10)]  # exact copies
    rows += [(340 + i, prose(60) + " " + item + " " + prose(30), "en", "src1", 1) for i in range(5)]
    rows += [(None, prose(50), None, None, None), (400, None, None, "src9", None), (401, "", None, None, None), (5, rows[5][1], "en", "src2", 1)]
    small_tables(spark, folder, rows)
    spark.createDataFrame([(1, item), (2, None), (3, "never seen anywhere at all here")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, folder))
        kept[name] = docs.collect()
        if name != "token_files":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    text = dict((r[0], r[1]) for r in rows)
    # junk goes, prose stays
    ids = [r.doc_id for r in kept["quality"]]
    assert not any(i is not None and 200 <= i < 260 for i in ids)
    assert {i for i in text if i is not None and (i < 120 or 300 <= i < 345)} <= set(ids)
    # one of each group stays, nothing else goes
    left = [r.doc_id for r in kept["near_duplicates"]]
    assert sorted(i for i in left if i is not None and i < 400) == sorted([*range(120), *range(340, 345)])
    assert left.count(5) == 1 and set(ids) - set(left) <= {*range(300, 330), 5}
    clean = [r.doc_id for r in kept["benchmark_leaks"]]
    assert sorted(set(map(repr, left)) - set(map(repr, clean))) == [repr(i) for i in range(340, 345)]
    # mixing: rows repeat, sizes near the targets of what was left
    size = lambda r: len((r.text or "").split())
    sizes = {}
    for r in kept["benchmark_leaks"]:
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
    want = targets(sizes, (3, 1, 2), 1.5, 2.0)
    for s in sizes:
        taken = sum(size(r) for r in kept["mix"] if r.source == s)
        assert abs(taken - want[s]) <= max(0.03 * want[s], 60)
    times = {}
    for r in kept["mix"]:
        times[(r.doc_id, r.text)] = times.get((r.doc_id, r.text), 0) + 1
    assert max(times.values()) <= 2 and {k[0] for k in times} <= set(clean)
    # token files: exactly the tokenizer's ids of the mixed rows, in order
    want_ids = sorted((repr(r.doc_id), zlib.crc32(np.array(tokens._tokenizer(tokens.default_tokenizer()).encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for r in kept["mix"])
    assert sorted((repr(r.doc_id), r.ids_crc32) for r in kept["token_files"]) == want_ids
    starts = sorted(kept["token_files"], key=lambda r: r.start)
    assert [r.start for r in starts] == np.cumsum([0] + [r.n_tokens for r in starts])[:-1].tolist()


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    small_tables(spark, folder, [])
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_contract_names():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)} and set(QUERIES) | {"pipeline"} <= names
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(contract.oracle_sql())
