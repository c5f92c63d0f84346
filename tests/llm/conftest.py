import random

import pytest
from pyspark.sql import functions as F

#: names that the operators use themselves
CLASH = ("id", "k1", "k2", "doc", "score", "predicted", "hits", "size", "target", "copies", "set", "n", "start", "windows", "ranges")


@pytest.fixture
def documents(spark):
    """DataFrame of (doc_id, text, source) rows, with columns whose names clash with the operators' own."""

    def make(rows):
        df = spark.createDataFrame([(*r, "src")[:3] for r in rows], "doc_id long, text string, source string").repartition(3)
        return df.withColumns({"lang": F.lit("en"), "n_chars": F.length("text"), **{c: F.lit(f"<{c}>") for c in CLASH}})

    return make


@pytest.fixture
def odd_texts():
    """Null, empty and blank texts, a very long one, marks, other scripts, null ids, equal rows."""
    rng = random.Random(3)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(400)) for _ in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"), (5, "one two three four"), (6, "Größe naïve 漢字   é ✓\x1c\x85 end"),
        (7, long), (None, "a text that has no id but many words in it"), (None, None), (8, "twice the same row"), (8, "twice the same row"),
        (9, "one id"), (9, "and another text"), (-5, "x" * 3000), (10, "line\n\nline\r\n LINE \n"),
    ]
