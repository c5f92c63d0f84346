"""Jobs against brute force on small inputs, whatever the partitioning."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import fixed
from lexmill.operators import aggregates as A
from lexmill.operators import dedup, graph, joins, linking, maintenance, names, quality, topk


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_top_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 2)
    top = dedup.top_per_key(df, ["k"], [F.col("id").desc()])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(r.id for r in top.collect()) == [98, 99]


@pytest.mark.parametrize("parts", [1, 7])
def test_dedup_cases(spark, parts):
    data = [(1, "E1", None, "2020-01"), (2, "E1", "InfoCuria", "2019-01"), (3, None, None, "2020-02"), (4, None, None, " "), (5, "E2", None, "  ")]
    df = spark.createDataFrame(data, "position long, ecli string, metadata_catalog_source string, source_window string").repartition(parts)
    out = dedup.dedup_cases(df, ["position"])
    assert rows(out, "position", "source_window") == [(2, "2019-01;2020-01"), (3, "2020-02"), (4, " "), (5, "")]


def brute_consolidate(texts):
    """Plain statement of the rules: best rendition per key, then untrusted shared bodies go."""
    norm = lambda s: " ".join((s or "").split())
    longest = {}
    for _, e, _, _, t in texts:
        longest[e] = max(longest.get(e, 0), len((t or "").strip()))
    best = {}
    for i, e, lang, src, t in texts:
        n = len((t or "").strip())
        eff = "INFOCURIA_OJ_NOTICE" if src == fixed.SOURCE_INFOCURIA and 0 < n < 0.25 * longest[e] and longest[e] >= 10_000 else src
        rank = 4 if n == 0 else {"CELLAR_ITEM": 0, "INFOCURIA_OJ_NOTICE": 3, "INFOCURIA_BLOB_HTML": 2}.get(eff, 1)
        best.setdefault((e, lang.upper()), []).append((rank, i, src, norm(t)))
    chosen = {k: min(v) for k, v in best.items()}
    users = {}
    for (e, lang), (_, _, _, body) in chosen.items():
        if len(body) >= 500:
            users.setdefault((lang, body), set()).add(e)
    return sorted(v[1] for (e, lang), v in chosen.items()
                  if v[2] == "CELLAR_ITEM" or len(users.get((lang, v[3]), ())) < 2)


@pytest.mark.parametrize("seed", range(3))
def test_consolidate_texts_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    bodies = ["", "  ", "short", "w " * 400, "v  " * 400, "u\n" * 8000]
    sources = ["CELLAR_ITEM", "INFOCURIA_BLOB_HTML", "OTHER"]
    data = [(i, f"E{rng.randrange(8)}", rng.choice(["en", "EN", "fr"]), rng.choice(sources), rng.choice(bodies)) for i in range(120)]
    schema = "text_id long, ecli string, language string, text_source string, text string"
    df = spark.createDataFrame(data, schema).withColumn("celex", F.lit("62000CJ0001")).withColumn("source_window", F.lit("2020-01")).repartition(5)
    cases = spark.createDataFrame([("E1", "62000CJ0001", "infocuria"), ("E2", "62000CJ0001", "cellar")], "ecli string, celex string, identity_source string")
    out = quality.consolidate_texts(df, cases)
    assert sorted(r.text_id for r in out.collect()) == brute_consolidate(data)
    assert {r.celex for r in out.where("ecli = 'E1'").collect()} <= {None}


def test_hot_key_is_whole(spark):
    df = spark.range(30_000).select(F.col("id").alias("edge_id"), F.when(F.col("id") < 10_000, 1).otherwise(F.col("id")).alias("source_case_id"),
                                    (F.col("id") % 50).alias("target_case_id"))
    got = A.degree_summary(df).first()
    assert (got.sources, got.edges, got.max_degree) == (20_001, 20_050, 50)


def test_median_histogram(spark):
    df = spark.createDataFrame([(1, n) for n in (5, 1, 9, 9)] + [(2, 4)], "case_id long, length int")
    assert rows(A.case_medians(df), "case_id", "median") == [(1, 7.0), (2, 4.0)]


def test_mention_offsets_match_python(spark):
    texts = ["Zaak C‑04/19 en T-7/20, C 12/98.", "niets", "é" * 70 + " C-1/11", None]
    df = spark.createDataFrame(list(enumerate(texts)), "case_id long, text string")
    out = linking.scan_mentions(df, ["case_id"], ["text"], [linking.Pattern("cjeu_case_number", fixed.MENTION_EU_NUMBER)])
    want = [(i, m.start(), m.end(), m.group()) for i, t in enumerate(texts) for m in re.finditer(r"\b[CTF] ?[-‑–‐­] ?[0-9]{1,4}/[0-9]{2}\b", t or "")]
    assert rows(out, "case_id", "char_start", "char_end", "raw_text") == sorted(want)
    for r in out.collect():
        assert r.raw_text in r.context and r.context in texts[r.case_id]


def catalog(spark, cands):
    return spark.createDataFrame(cands, "case_id long, kind string, date_decision string, is_gc boolean, docname string, conclusion string, item_id string, ecli string, appnos array<string>").withColumn(
        "date_decision", F.col("date_decision").cast("date"))


def test_citation_resolver_tie_breaks(spark):
    cat = catalog(spark, [
        (10, "judgment", "2003-03-12", False, "A", "Violation", "i10", None, ["46221/99"]),
        (11, "judgment", "2005-05-12", True, "A", "Violation", "i11", None, ["46221/99"]),
        (12, "decision", "2000-12-14", False, "A", None, "i12", None, ["46221/99"]),
        (13, "communicated", "1999-01-01", False, "A", None, "i13", None, ["46221/99"]),
        (20, "judgment", "1995-01-01", False, "X (REVISION)", None, "i20", None, ["1/90"]),
        (21, "judgment", "1996-01-01", False, "X", "Violation", "i21", None, ["1/90", "2/90"]),
        (22, "judgment", "2030-01-01", False, "X", "Violation", "i22", None, ["1/90"]),
    ])
    src = spark.createDataFrame([
        (1, "2010-01-01", 0, "A v. T [GC], no. 46221/99, 12 May 2005"), (2, "2010-01-01", 0, "A v. T (dec.), no. 46221/99"),
        (3, "2010-01-01", 0, "A v. T, no. 46221/99"), (4, "2010-01-01", 0, "X v. Y, nos. 1/90 and 2/90"), (5, "2010-01-01", 0, "X v. Y (revision), no. 1/90"),
        (11, "2010-01-01", 0, "A v. T, no. 46221/99"), (6, "1994-01-01", 0, "X v. Y, no. 1/90"),
    ], "source_case_id long, source_date string, n int, scl string").withColumn("source_date", F.col("source_date").cast("date"))
    out = linking.resolve_scl(src, cat, ["n"])
    assert rows(out, "source_case_id", "target_case_id", "rule") == [
        (1, 11, "scl_judgment_exact_date"), (2, 12, "scl_decision_cue"), (3, 10, "scl_judgment_principal_earliest"),
        (4, 21, "scl_judgment_principal"), (5, 20, "scl_judgment_revision"), (11, 10, "scl_judgment")]


def test_court_compatibility(spark):
    df = spark.createDataFrame([("Hoge Raad", "Hoge Raad", True), ("Rechtbank Den Haag", "Rechtbank 's-Gravenhage", True), ("Rechtbank Utrecht", "Rechtbank Amsterdam", False),
                                ("president", "Kantongerecht Breda", True), ("onbekend", "iets", True), ("Raad van State", "Hoge Raad", False)], "c string, i string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", joins.court_compatible("c", "i")).collect())


def test_clusters_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(500, n) for n in range(501, 560)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    df = spark.createDataFrame(edges, "source_case_id long, target_case_id long")
    assert rows(graph.clusters(df), "node", "component") == sorted((n, find(n)) for n in parent)


def test_pagerank_mass_is_kept(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (4, 3), (1, 3)], "source_case_id long, target_case_id long")
    out = graph.pagerank(df)
    assert abs(out.agg(F.sum("rank")).first()[0] - 1) < 1e-9
    assert out.orderBy(F.desc("rank")).first().node == 3


def test_nearest_blocks_agree(spark, monkeypatch):
    rng = random.Random(1)
    vec = lambda: [rng.random() for _ in range(8)]
    seg = spark.createDataFrame([(i, vec()) for i in range(200)], "segment_id long, embedding array<float>").repartition(4)
    q = spark.createDataFrame([(i, vec()) for i in range(9)], "query_id long, vector array<double>")
    one = rows(graph.nearest(seg, q, 3), "query_id", "segment_id")
    monkeypatch.setattr(graph, "MAX_QUERY_VECTORS", 4)
    assert rows(graph.nearest(seg, q, 3), "query_id", "segment_id") == one and len(one) == 27


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("s", F.col("id") % 3)
    a = rows(topk.stratified_sample(df.repartition(3), "s", ["id"], 100, 10, 7), "id")
    assert a == rows(topk.stratified_sample(df.repartition(11), "s", ["id"], 100, 10, 7), "id") and len(a) == 100
    assert rows(topk.sample_rows(df, ["id"], 5, 1), "id") == rows(topk.sample_rows(df.repartition(9), ["id"], 5, 1), "id")


def test_page_cursor_walks_everything(spark):
    df = spark.createDataFrame([(f"E{i:02d}", None if i % 4 == 0 else f"2000-01-{i % 3 + 1:02d}") for i in range(20)], "ecli string, d string").select("ecli", F.col("d").cast("date").alias("date_decision"))
    seen, after = [], None
    while page := topk.page(df, after, 6).collect():
        seen += [r.ecli for r in page]
        after = (page[-1].date_decision, page[-1].ecli)
    assert len(seen) == len(set(seen)) == 20


def test_trigrams_go_by_word(spark):
    df = spark.createDataFrame([(1, "widgets red"), (2, "Red, Widgets!"), (3, "other")], "i long, v string")
    assert rows(names.trigram_search(df, "v", spark.createDataFrame([("red-widgets",)], "query string")), "i", "similarity") == [(1, 1.0), (2, 1.0)]


def test_nearest_without_queries(spark):
    seg = spark.createDataFrame([("a", [1.0, 0.0])], "segment_id string, embedding array<float>")
    none = spark.createDataFrame([], "query_id string, vector array<double>")
    assert graph.nearest(seg, none, 3).collect() == []
    one = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, vector array<double>")
    assert rows(graph.nearest(seg, one, 3), "query_id", "segment_id", "similarity") == [("q", "a", 1.0)]


def test_rounds_leave_no_files(spark):
    import glob

    from lexmill.operators.lineage import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    count = lambda: len(glob.glob(f"{folder}/cut-*"))
    chain = lambda n: spark.range(n).selectExpr("id AS source_case_id", "id + 1 AS target_case_id")
    before = count()
    graph.clusters(chain(3)).count()
    short = count() - before
    before = count()
    graph.clusters(chain(60)).count()
    assert count() - before == short


def test_docket_tokens_without_digits(spark):
    entries = spark.createDataFrame([(1, "2001-01-01", "abcd"), (2, "2001-01-01", "b ab"), (3, "2001-01-01", "x1234"), (4, "2001-01-01", "zzzz"), (5, "2001-01-01", "abc")], "e long, date_decision string, token string")
    docs = spark.createDataFrame([(7, "2001-01-01", "AWB abcd ab12 x1234", "Rechtbank"), (8, "2001-01-02", "abcd", "Rechtbank"), (9, "2001-01-01", None, "Rechtbank")], "doc_id long, date_decision string, zaaknummer string, instance string")
    assert rows(joins.match_by_date_and_token(entries, docs), "e", "doc_id") == [(1, 7), (3, 7)]


def test_trigrams_of_dockets_are_not_broadcast(spark):
    entries = spark.range(5).selectExpr("id AS e", "'2001-01-01' AS date_decision", "concat('ab1', id) AS token")
    docs = spark.range(5).selectExpr("id AS doc_id", "'2001-01-01' AS date_decision", "concat('AWB ab1', id) AS zaaknummer", "'Rechtbank' AS instance")
    out = joins.match_by_date_and_token(entries, docs)
    assert "Inner, Build" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out, "e", "doc_id") == [(i, i) for i in range(5)]


@pytest.mark.parametrize("length, growth", [(200, 1000), (12, 2)])
def test_timeline_doubles_its_jumps(spark, monkeypatch, length, growth):
    edges = [(i, i + 1) for i in range(length)] + [(5, 1), (3, 3), (9, 0), (300, 301)]
    df = spark.createDataFrame([(a, b, "appeal_of") for a, b in edges] + [(0, 300, "cites"), (7, None, "appeal_of")], "source_case_id long, target_case_id long, relation_type string")
    cases = spark.createDataFrame([(i, "2001-01-01") for i in range(100)], "case_id long, date_decision string")
    roots, want = [0, 8, 300, 999], set()
    for r in roots:
        seen, front, n = {r: 0}, [r], 0
        while front:
            n += 1
            front = sorted({b for a, b in edges if a in front and b not in seen})
            seen.update(dict.fromkeys(front, n))
        want |= {(r, c, s) for c, s in seen.items()}
    writes, real = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda d: writes.append(1) or real(d))
    monkeypatch.setattr(graph, "GROWTH", growth)
    got = graph.timeline(df, cases, spark.createDataFrame([(r,) for r in roots], "case_id long"), ["appeal_of"])
    assert {(r.root, r.case_id, r.step) for r in got.collect()} == want
    assert len(writes) <= 2 * 10 + 2  # a chain of 200 in at most ten rounds of two writes


@pytest.mark.parametrize("few, held, walks, whole", [(0, 1000, 9, False), (1000, 1000, 9, False), (0, 0, 9, True), (0, 1000, 1, False), (0, 0, 1, True)])
def test_timeline_writes_no_pairs(spark, monkeypatch, few, held, walks, whole):
    edges = [(i, i + 1) for i in range(20)] + [(5, 1), (3, 3), (9, 0), (18, 30), (30, 31), (50, 51), (51, 50), (3, 4), (None, 2)]
    df = spark.createDataFrame([(a, b, "appeal_of") for a, b in edges] + [(0, 50, "cites"), (7, None, "appeal_of")], "source_case_id long, target_case_id long, relation_type string")
    dates = [(i, f"2001-01-{i + 1:02d}") for i in range(20)] + [(4, None), (4, None), (20, None), (90, "2001-01-01"), (90, "2001-01-02"), (None, "2001-01-03")]
    roots, want = [*range(18), 30, 90, 91, None], []
    for r in roots:
        seen, front, n = {r: 0}, [r], 0
        while front:
            n += 1
            front = sorted({b for a, b in edges if a in front and a is not None and b not in seen})
            seen.update(dict.fromkeys(front, n))
        want += [(r, c, s, d) for c, s in seen.items() for d in [d for i, d in dates if c is not None and i == c] or [None]]
    rows_written, real = [], graph.cut

    def counted(d):
        out = real(d)
        rows_written.append(out.count())
        return out

    monkeypatch.setattr(graph, "cut", counted)
    for name, value in (("FEW_STEPS", few), ("HELD_STEPS", held), ("WALKS", walks), ("LEVELS", 8)):
        monkeypatch.setattr(graph, name, value)
    got = graph.timeline(df, spark.createDataFrame(dates, "case_id long, date_decision string"), spark.createDataFrame([(r,) for r in roots * 2], "case_id long"), ["appeal_of"])
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.root, r.case_id, r.step, r.date_decision) for r in got.collect()), key=key) == sorted(want, key=key)
    assert got.columns == ["case_id", "root", "step", "date_decision"]
    assert (max(rows_written) > 2 * len(edges)) == whole and len(want) > 4 * len(edges)


def test_timeline_roots_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(graph, "TASK_ROOTS", 10)
    steps = spark.range(79).selectExpr("id AS source_case_id", "id + 1 AS target_case_id", "'appeal_of' AS relation_type")
    cases = spark.range(80).selectExpr("id AS case_id", "DATE '2001-01-01' AS date_decision")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for value in zip(before, ("-1", "8")):
        spark.conf.set(*value)
    try:
        out = graph.timeline(steps, cases, cases.where("case_id < 79"), ["appeal_of"])
        assert "8), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == sum(range(2, 81))
    finally:
        for value in before.items():
            spark.conf.set(*value)


def test_fulltext_reads_no_eu_numbers(spark):
    cat = catalog(spark, [(n, "judgment", "2000-01-01", False, "A", "Violation", f"i{n}", None, [a]) for n, a in ((10, "17/98"), (11, "119/96"), (12, "24/08"), (13, "5/01"))])
    texts = spark.createDataFrame([
        (1, "word " * 4 + "joined cases C-17/98 en T-119/96. A. EHRM ECLI:EU:C:1998:4616 (application no. 24/08) and so on"),
        (2, "x" * 40 + " C-17/98 en T-119/96. A. EHRM ECLI:EU:C:1998:46167 (application no. 24/08) and"), (3, "5/01 and application no. 24/08")], "case_id long, text string").withColumn("source_date", F.lit(None).cast("date"))
    out = linking.link_echr_fulltext(texts, texts.where("false"), cat)
    assert {r for r in rows(out, "source_case_id", "appno") if r[0] < 3} == {(1, "24/08"), (2, "24/08")}


def test_fulltext_reads_no_acts_or_papers(spark):
    cat = catalog(spark, [(n, "judgment", "2000-01-01", False, "A", "Violation", f"i{n}", None, [a]) for n, a in ((10, "2001/02"), (11, "1408/71"), (12, "24/08"), (13, "44/20"))])
    paper, act = "Kamerstukken II 2001/02, 28 000, nr. 3", "Regulation (EEC) No 1408/71"
    texts = spark.createDataFrame([
        (1, f"application no. 24/08) {paper}"), (2, f"{act} and no. 24/08"), (3, "x " * 30 + f"{paper} {'y' * 15} no. 24/08"),
        (4, f"no. 24/08 {'z' * 54} 44/2001 and more"), (5, f"{act} alone")], "case_id long, text string").withColumn("source_date", F.lit(None).cast("date"))
    out = linking.link_echr_fulltext(texts, texts.where("false"), cat)
    assert rows(out, "source_case_id", "appno") == [(i, "24/08") for i in range(1, 5)]


def test_replacement_of_just_the_ratio_is_not_longer(spark):
    stored = spark.createDataFrame([("E1", "en", "x" * 200), ("E2", "en", "x" * 200), ("E3", "en", "")], "ecli string, language string, text string")
    fetched = spark.createDataFrame([("E1", "EN", "x" * 201), ("E2", "EN", "x" * 202), ("E3", "EN", "x")], "ecli string, language string, text string")
    assert rows(quality.accept_replacements(stored, fetched, 1.005), "ecli") == [("E2",), ("E3",)]
    assert rows(quality.accept_replacements(stored, fetched, 0), "ecli") == [("E1",), ("E2",), ("E3",)]


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, with as many tasks as planned."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_relations_without_a_key_are_dealt_to_all_tasks(spark, shuffled):
    raw = spark.range(400).selectExpr("id AS edge_id", "if(id = 7, 'C-1/95', concat('?', id)) AS raw_target")
    cases = spark.createDataFrame([(5, "E5", "62000CJ0001", "C-1/95")], "case_id long, ecli string, celex_id string, case_number string")
    maps = spark.createDataFrame([], "uuid string, case_number string, celex string")
    out = linking.resolve_relations(raw, cases, maps.select("uuid", "case_number"), maps.select("uuid", "celex"))
    assert out.where("target_case_id IS NULL").select(F.spark_partition_id()).distinct().count() > 1
    assert rows(out.where("target_case_id IS NOT NULL"), "edge_id", "kind", "target_case_id") == [(7, "case_number", 5)] and out.count() == 400


def test_open_links_are_dealt_to_all_tasks_by_a_delete(spark, shuffled):
    none = "CAST(NULL AS STRING)"
    edges = spark.range(400).selectExpr("id AS edge_id", "id + 1000 AS source_case_id", "if(id = 7, 5L, NULL) AS target_case_id", f"{none} AS target_ecli_raw",
                                        f"{none} AS target_celex_raw", "'cites' AS relation_type", "'d' AS source_dataset")
    cases = spark.createDataFrame([(5, "E5", "62000CJ0001")], "case_id long, ecli string, celex_id string")
    after, _ = maintenance.delete_cases(edges, cases, cases.select("case_id"))
    assert after.select(F.spark_partition_id()).distinct().count() > 2
    assert rows(after.where("target_ecli_raw IS NOT NULL"), "edge_id", "target_case_id", "target_ecli_raw") == [(7, None, "E5")] and after.count() == 400
