import random
import re
import time

import pytest

from lexmill.functions import fixed
from lexmill.operators import linking as L
from lexmill.operators.scan import Pattern, Scanner, compiled, scan_mentions

TABLE = [L.EU_NUMBER, L.APPNO, L.ECLI, L.EU_ACT, Pattern("ljn", fixed.MENTION_LJN, starts=("LJN",)), L.PARLIAMENTARY_PAPER.pattern]
PARTS = ["C-12/98", "C ‑ 1/04", "T–7/20.", "F-123456/20", "C-1/2", "no. 12345/67", "Nos 1/90/2", "nr.: 5/11", "application 77/01", "notno. 3/44", "ECLI:NL:HR:2001:AB12",
         "ecli:nl:hr:2001:ab12", "richtlijn 98/5/EG, art. 3", "Richtlijnrichtlijn 98/5", "VERORDENING (EG) nr. 44/2001", "LJN: AB1234", "LJN AB1234x",
         "Kamerstukken II 2001/02, 28 123, nr. 3", "é", "İstanbul", "xC-1/11", "éC-1/11", "C-1/11é", " ", ", ", "\n"]


def plain(text):
    """Every pattern searched in the whole text."""
    return [(n, *m.span()) for n, p in enumerate(TABLE) if not p.cue or re.search(p.cue, text) for m in compiled(p.regex).finditer(text)]


def test_scanner_finds_what_a_search_finds():
    rng, scanner = random.Random(1), Scanner(TABLE)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(30)))
        assert list(scanner(text)) == plain(text), text


def test_scanner_finds_what_the_engine_finds(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(30))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "case_id long, text string")
    scheme = {str(i): p for i, p in enumerate(TABLE)}
    found = scan_mentions(df, ["case_id"], ["text"], [Pattern(i, p.regex, None, p.starts) for i, p in scheme.items()])
    got = {}
    for r in found.orderBy("case_id", "scheme", "char_start").collect():
        got.setdefault((r.case_id, r.scheme), []).append(r.raw_text)
    for i, p in scheme.items():
        for r in df.select("case_id", F.regexp_extract_all("text", F.lit(p.regex), F.lit(0)).alias("hits")).collect():
            assert got.get((r.case_id, i), []) == r.hits


def test_empty_null_and_many_columns(spark):
    df = spark.createDataFrame([(1, None, "C-1/11"), (2, "", None), (3, "C-2/22 C-3/33", "T-4/44")], "scheme long, text string, summary string")
    out = scan_mentions(df.withColumnRenamed("scheme", "id"), ["id"], ["text", "summary"], [L.EU_NUMBER], 2)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "cjeu_case_number", "summary", "C-1/11", 0, 6, "C-1/11"), (3, "cjeu_case_number", "summary", "T-4/44", 0, 6, "T-4/44"),
                   (3, "cjeu_case_number", "text", "C-2/22", 0, 6, "C-2/22 C"), (3, "cjeu_case_number", "text", "C-3/33", 7, 13, "2 C-3/33")]
    assert scan_mentions(df.where("false").withColumnRenamed("scheme", "id"), ["id"], ["text"], [L.EU_NUMBER]).count() == 0


@pytest.mark.parametrize("part", ["zaak C-12/98 en ", "no no no nr "])
def test_time_grows_with_the_text(part):
    scanner = Scanner(TABLE)

    def seconds(times):
        text, best = part * times, 1e9
        for _ in range(3):
            start = time.perf_counter()
            assert len(list(scanner(text))) == (times if "C-" in part else 0)
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(32_000) < 10 * seconds(4_000) * 1.5


def test_flags():
    assert compiled(r"(?i)É").search("é") is None and compiled(r"(?iU)É").search("é")
    assert not compiled(r"\bC").search("éC") and compiled(r"\\b").search(r"a\b") and re.search(r"\d", "٣") and not compiled(r"\d").search("٣")
