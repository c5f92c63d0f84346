import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from lexmill.functions import citations as C
from lexmill.functions import fixed, ids
from lexmill.functions import text as X
from lexmill.operators import mapping


def test_strip_and_collapse_handle_every_whitespace(values):
    odd = [" a\t b \n", "  ", "a  b", None, "x　　y\x1f"]
    assert values(odd, X.strip) == ["a\t b", "", "a  b", None, "x　　y"]
    assert values(odd, X.collapse) == [None if v is None else " ".join(v.split()) for v in odd]


def test_tokens(values):
    assert values(["a; b ;; ", "", None], X.toks) == [["a", "b"], [], []]
    assert values(["2020-05-01;2019-01-02", ";", None], X.min_tok) == ["2019-01-02", None, None]


def test_body_digest_matches_plain_python(values):
    long, short = "word \n" * 200, "short"
    want = hashlib.md5(" ".join(long.split()).encode()).hexdigest()
    assert values([long, short, None], X.body_digest) == [want, None, None]


@pytest.mark.parametrize("cell, want", [
    ("62022CJ0123;62022CJ0123_SUM", "62022CJ0123"), ("62020CJ0414_INF; 62020CJ0414", "62020CJ0414"),
    ("62021CO0201.01", "62021CO0201(01)"), ("62020CJ0414_INF", "62020CJ0414"), ("", None)])
def test_preferred_celex(values, cell, want):
    assert values([cell], ids.preferred_celex) == [want]


def test_celex_facts(values):
    cells = ["62011CJ0444", "62003CC0466(01)", "82025SI1007(51)", "32016R0679", None]
    assert values(cells, ids.case_number) == ["C-444/11", "C-466/03", "C-1007/25", None, None]
    assert [tuple(k) for k in values(cells, ids.celex_kind)] == [
        ("CJEU", "judgment", False), ("CJEU", "opinion", True), (None, "other", False), (None, "other", False), (None, "other", False)]
    assert values(["62011CJ0444_SUM", "62011CJ04", None], ids.celex_ok) == [True, False, False]


def test_formation_order(values):
    assert values(["First Grand Chamber", "Tenth Chamber", "Single", "", None], ids.importance) == [1, 3, 4, None, None]


def test_application_numbers(values):
    assert values(["no. 0046221/99", "no. 046221/99", "1234567/99", "12/345", None], ids.norm_appno) == [None, "46221/99", None, None, None]
    assert values(["ECLI:CE:ECHR:2026:1119JUD003766823", "ECLI:CE:ECHR:2026:1119JUD000000023"], ids.appno_from_ecli) == ["37668/23", None]


def test_dates_in_citations(values):
    texts = ["12 May 2005", "1er février 2015", "March 3rd, 1999", "déc. 5.7.88", "31.02.1999", "1 August 49", None]
    want = [dt.date(2005, 5, 12), dt.date(2015, 2, 1), dt.date(1999, 3, 3), dt.date(1988, 7, 5), None, None, None]
    assert values(texts, C.date_in_text) == want
    assert values(["ECHR 2000-VI", "no. 12/99, 2005", "(1958)", "no. 1/23"], lambda c: C.year_in_text(c, F.lit(None).cast("date"))) == [2000, 2005, None, None]


def test_split_citations(values):
    scl = "Öcalan v. Turkey [GC], no. 46221/99, § 70, 12 May 2005 Weber c. Allemagne (déc.), n° 70287/11; A v. B, no. 1/20"
    assert values([scl], C.split_citations) == [[
        "Öcalan v. Turkey [GC], no. 46221/99, § 70, 12 May 2005", "Weber c. Allemagne (déc.), n° 70287/11", "A v. B, no. 1/20"]]


def test_caps_heading(values):
    heads = ["JUDGMENT OF THE COURT", "Judgment of the Court", "Edizione provvisoria SENTENZA DEL TRIBUNALE", "x " * 25 + "ARRÊT DE LA COUR", "ARRÊT DE LA COUR", None]
    assert values(heads, X.caps_heading) == [True, False, True, False, True, False]


def test_date_in_opening(spark):
    df = spark.createDataFrame([("Arrêt du 5 mai 1997", dt.date(1997, 5, 5)), ("15 mai 1997", dt.date(1997, 5, 5)), ("5 mai 1997", None)], "h string, d date")
    assert [r.o for r in df.select(X.carries_date("h", "d").alias("o")).collect()] == [True, False, False]


def test_scalar_normaliser(values):
    cells = ['{"b": "x, y: z", "a": [1, 2]}', '"text"', "null", "7", "true"]
    assert values(cells, lambda c: X.to_text_scalar(F.parse_json(c))) == ['{"a": [1, 2], "b": "x, y: z"}', "text", None, "7", "true"]


def test_rewrite_keeps_cells_without_uris(spark):
    df = spark.createDataFrame([(1, "A;A"), (2, "http://u1;A;http://u2;A"), (3, None), (4, "http://gone")], "k long, cell string")
    table = spark.createDataFrame([("http://u1", "B"), ("http://u2", "B")], "uri string, celex string")
    out = {r.k: r.cell for r in mapping.rewrite_cell(df, "k", "cell", table, "uri", "celex").collect()}
    assert out == {1: "A;A", 2: "B;A", 3: "", 4: ""}


def test_language_tables(values):
    assert values(["English", "nl", "Klingon", None], ids.norm_lang) == ["en", "nl", None, None]
    assert len(fixed.LANGUAGE_NAMES) == 24 and len(fixed.HUDOC_LANGUAGES) == 40


def test_cues_in_capitals_with_accents_and_no_break_spaces(values):
    from lexmill.functions import citations, text

    flags = values(["AFFAIRE X c. Y (SATISFACTION ÉQUITABLE)", "X (RÉVISION)", "JUST SATISFACTION", "X (DÉC.)", "Grande Chambre"], citations.cue_flags)
    assert [f.secondary_cue for f in flags] == ["just_satisfaction", "revision", "just_satisfaction", None, None]
    assert [f.decision_cue for f in flags] == [False, False, False, True, False] and flags[4].grand_chamber
    assert values(["&#39;s-Gravenhage Li&egrave;ge &amp;lt; &bogus; &#x2014;", None], text.unescape_html) == ["'s-Gravenhage Liège &lt; &bogus; —", None]
