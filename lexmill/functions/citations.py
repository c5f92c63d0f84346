"""Expressions over free-text citation strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import as_col, first_match, first_rule, let, lookup, strip

_MONTH = "|".join(sorted(fixed.MONTHS, key=len, reverse=True))
DAY_MONTH_YEAR = rf"(?iU)\b(\d{{1,2}})(?:er|st|nd|rd|th)?\s+({_MONTH})\.?\s+((?:19|20)\d{{2}})\b"
MONTH_DAY_YEAR = rf"(?iU)\b({_MONTH})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+((?:19|20)\d{{2}})\b"
NUMERIC_DATE = r"\b(\d{1,2})\s*\.\s*(\d{1,2})\s*\.\s*((?:19|20)\d{2}|\d{2})\b"


def _ymd(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0")).try_cast("date")


def date_in_text(c) -> Column:
    """First calendar date: day-month-year words, month-day-year words, then digits (pivot 50).

    Each pattern runs once over the text; its parts are read from the short match.
    """
    c = as_col(c)

    def dated(pattern: str, parts) -> Column:
        group = lambda m, i: F.regexp_extract(m, pattern, i)
        return let(F.regexp_extract(c, pattern, 0),
                   lambda m: F.when(m != "", _ymd(*parts(*[group(m, i) for i in (1, 2, 3)]))))

    month = lambda word: lookup(F.lower(word), fixed.MONTHS)
    century = lambda y: first_rule(
        [(F.length(y) == 4, y), (y >= "50", F.concat(F.lit("19"), y))], F.concat(F.lit("20"), y))
    words = F.coalesce(
        dated(DAY_MONTH_YEAR, lambda d, m, y: (y, month(m), d)),
        dated(MONTH_DAY_YEAR, lambda m, d, y: (y, month(m), d)),
    )
    # word dates need a four-digit year, so texts without one skip both word patterns
    return F.coalesce(F.when(c.rlike(r"(?:19|20)\d{2}"), words), dated(NUMERIC_DATE, lambda d, m, y: (century(y), m, d)))


def year_in_text(c, date) -> Column:
    """Year of the date if known; else the first plausible year once numbers and paragraphs are gone."""
    text = F.regexp_replace(as_col(c), fixed.APPNO, " ")
    text = F.regexp_replace(text, r"§+\s*[\d\-–,\s]+", " ")
    low, high = fixed.YEAR_RANGE

    def plausible(t: Column) -> Column:
        years = [F.regexp_extract(t, pattern, 1).try_cast("int") for pattern in fixed.YEAR_PATTERNS]
        return F.coalesce(*[let(y, lambda v: F.when(v.between(low, high), v)) for y in years])

    known = F.year(as_col(date))
    searched = F.when(as_col(c).rlike(r"(?:19|20)\d{2}"), let(text, plausible))
    return F.when(known.isNotNull(), known).otherwise(searched)


def cue_flags(c) -> Column:
    c = as_col(c)
    return F.struct(
        c.rlike(fixed.DECISION_CUE).alias("decision_cue"),
        c.rlike(fixed.GRAND_CHAMBER_CUE).alias("grand_chamber"),
        first_match(c, fixed.SECONDARY_CUES).alias("secondary_cue"),
    )


def secondary_kind(name, conclusion) -> Column:
    """Follow-up class from the name; from the conclusion only if it finds nothing on the merits."""
    conclusion = F.coalesce(as_col(conclusion), F.lit(""))
    return F.coalesce(
        first_match(F.coalesce(as_col(name), F.lit("")), fixed.SECONDARY_CUES),
        F.when(~conclusion.rlike(fixed.MERITS_CONCLUSION),
               first_match(conclusion, fixed.SECONDARY_CONCLUSIONS)),
    )


def split_citations(c) -> Column:
    """Entries of a citation string: repair missing separators, then split twice.

    Short tests keep strings away from the costly patterns they cannot match.
    """
    text = as_col(c)
    (line_break, joined), *repairs = fixed.CITATION_REPAIRS
    text = F.when(F.contains(text, F.lit("\n")), F.regexp_replace(text, line_break, joined)).otherwise(text)
    for pattern, replacement in repairs:
        text = F.regexp_replace(text, pattern, replacement)
    chunks = F.transform(F.split(text, r"[;\n]+"), strip)
    wide = lambda chunk: chunk.rlike(r"\s\s|\s[:.]\s")
    parts = F.flatten(F.transform(
        chunks, lambda chunk: F.when(wide(chunk), F.split(chunk, fixed.CITATION_SUBSPLIT)).otherwise(F.array(chunk))))
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def rule_confidence(rule) -> Column:
    rule = as_col(rule)
    return first_rule(
        [(F.contains(rule, F.lit(word)), F.lit(value)) for word, value in fixed.RULE_CONFIDENCE],
        F.lit(fixed.RULE_CONFIDENCE_DEFAULT),
    )
