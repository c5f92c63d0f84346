"""Cell, text and digest expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind a costly expression once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(c) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(as_col(c), F.lit(fixed.WHITESPACE))


def collapse(c) -> Column:
    """One space per whitespace run, ends trimmed."""
    return strip(F.regexp_replace(as_col(c), fixed.WHITESPACE_TO_COLLAPSE, " "))


def blank_to_null(c) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def is_blank(c) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def lookup(c, table: Mapping[str, object]) -> Column:
    """Small literal map; absent keys give null."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), as_col(c))


def first_rule(rules: Iterable[tuple[Column, Column]], default: Column | None = None) -> Column:
    """Ordered rules: the first true predicate decides."""
    chain = None
    for predicate, value in rules:
        chain = F.when(predicate, value) if chain is None else chain.when(predicate, value)
    return chain.otherwise(default) if default is not None else chain


def first_match(c, patterns: Iterable[tuple[str, str]]) -> Column:
    """Label of the first pattern found in the text, else null."""
    c = as_col(c)
    return first_rule((c.rlike(pattern), F.lit(label)) for label, pattern in patterns)


def toks(c) -> Column:
    """Tokens of a ``;``-joined cell, trimmed, empties dropped; null cell gives an empty array."""
    parts = F.filter(F.transform(F.split(as_col(c), ";"), strip), lambda t: t != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def first_tok(c) -> Column:
    return F.try_element_at(toks(c), F.lit(1))


def whole(c) -> Column:
    """The full cell, trimmed; blank gives null."""
    return blank_to_null(strip(c))


def raw_cell(c) -> Column:
    """The cell exactly as stored, as text."""
    return as_col(c).cast("string")


def min_tok(c) -> Column:
    return F.array_min(toks(c))


def parse_date(c) -> Column:
    return as_col(c).try_cast("date")


def body_digest(c, min_chars: int = fixed.SHARED_BODY_MIN_CHARS) -> Column:
    """md5 of the body with whitespace collapsed; null for short or missing bodies."""
    return let(collapse(c), lambda body: F.when(F.length(body) >= min_chars, F.md5(body.cast("binary"))))


def body_sha256(c) -> Column:
    return F.sha2(collapse(F.coalesce(as_col(c), F.lit(""))).cast("binary"), 256)


def body_length(c) -> Column:
    return F.coalesce(F.length(strip(c)), F.lit(0))


def head(c, chars: int = 400) -> Column:
    """Opening of a text: a slice first, so the body itself never travels further."""
    return F.left(F.regexp_replace(F.left(as_col(c), F.lit(2 * chars)), r"\s+", " "), F.lit(chars))


def slice_ends(c, chars: int) -> Column:
    c = as_col(c)
    return F.struct(F.left(c, F.lit(chars)).alias("opening"), F.right(c, F.lit(chars)).alias("closing"))


def caps_heading(c) -> Column:
    """A run of two or three words in capitals that starts within the first 40 of 60 characters."""
    opening = F.left(F.coalesce(as_col(c), F.lit("")), F.lit(60))
    phrase = r"[\p{L}]{2,}(?:(?U:\s)+[\p{L}]+){1,2}"
    found = F.regexp_extract_all(opening, F.lit(phrase), F.lit(0))
    gaps = F.transform(F.split(opening, phrase, -1), F.length)

    def any_upper(v: Column) -> Column:
        # start of match i = gaps up to i, plus the earlier matches
        def start(i: Column) -> Column:
            before = F.aggregate(F.slice(v["gaps"], F.lit(1), i + 1), F.lit(0), lambda a, n: a + n)
            return F.aggregate(F.slice(v["found"], F.lit(1), i), before, lambda a, m: a + F.length(m))

        hits = F.transform(v["found"], lambda m, i: m.rlike(r"^[\p{Lu}\s]+$") & (start(i) < 40))
        return F.exists(hits, lambda h: h)

    return let(F.struct(found.alias("found"), gaps.alias("gaps")), any_upper)


def carries_date(opening, date) -> Column:
    """Day and year of the date both stand in the first 300 characters."""
    date = as_col(date)
    window = F.left(F.coalesce(as_col(opening), F.lit("")), F.lit(300))
    day = F.concat(F.lit(r"(?<!\d)"), F.dayofmonth(date).cast("string"), F.lit(r"(?!\d)"))
    found = F.contains(window, F.year(date).cast("string")) & F.rlike(window, day)
    return F.coalesce(found, F.lit(False))


def looks_like_judgment(c, markers: Iterable[str] = fixed.JUDGMENT_MARKERS) -> Column:
    opening = F.left(collapse(F.coalesce(as_col(c), F.lit(""))), F.lit(5000))
    opening = F.regexp_replace(opening, r"(?i)\bENJUDGMENT\b", "JUDGMENT")
    return opening.rlike("(?i)(" + "|".join(markers) + ")")


def effective_source(source, length, longest) -> Column:
    """Relabel a short trusted-portal text as an official-journal notice."""
    source, length, longest = as_col(source), as_col(length), as_col(longest)
    notice = (
        (source == fixed.SOURCE_INFOCURIA)
        & (length > 0)
        & (longest >= fixed.NOTICE_MIN_REFERENCE_CHARS)
        & (length < fixed.NOTICE_MAX_RATIO * longest)
    )
    return F.when(notice, F.lit(fixed.SOURCE_NOTICE)).otherwise(source)


def source_rank(source, length) -> Column:
    source, length = as_col(source), as_col(length)
    return first_rule(
        [
            (length == 0, F.lit(4)),
            (source == fixed.SOURCE_CELLAR, F.lit(0)),
            (source == fixed.SOURCE_NOTICE, F.lit(3)),
            (source == fixed.SOURCE_INFOCURIA, F.lit(2)),
        ],
        F.lit(1),
    )


def unconcat(c) -> Column:
    """``XX`` -> ``X`` when the two halves are equal; else null."""
    name = strip(c)
    size = F.length(name)
    half = F.left(name, (size / 2).cast("int"))
    doubled = (
        (size >= 6) & (size % 2 == 0) & (half == F.right(name, (size / 2).cast("int")))
        & (half == strip(half)) & (F.length(half) >= 3)
    )
    return F.when(doubled, half)


def fold(c) -> Column:
    """Accent- and case-insensitive comparison key."""
    return F.collate(as_col(c), "UNICODE_CI_AI")


def merge_aliases(canonical, *aliases) -> Column:
    """Sorted union of alias arrays without blanks and without the canonical name."""
    empty = F.array().cast("array<string>")
    union = F.concat(*[F.coalesce(as_col(a), empty) for a in aliases])
    cleaned = F.transform(union, strip)
    kept = F.filter(cleaned, lambda a: a.isNotNull() & (a != "") & (a != as_col(canonical)))
    return F.array_sort(F.array_distinct(kept))


def agent_label(c) -> Column:
    """Readable name from the last part of an agent URI."""
    c = as_col(c)
    tail = F.regexp_extract(c, r"/resource/agent/(.*)$", 1)
    return blank_to_null(strip(F.translate(F.try_url_decode(tail), "_", " ")))


def to_text_scalar(c) -> Column:
    """JSON value (variant) to text: null, string, sorted-key JSON, or plain text."""
    c = as_col(c)
    kind = F.schema_of_variant(c)
    return first_rule(
        [
            (F.is_variant_null(c) | c.isNull(), F.lit(None).cast("string")),
            (kind == "STRING", F.variant_get(c, "$", "string")),
        ],
        spaced_json(F.to_json(c)),
    )


def spaced_json(c) -> Column:
    """A space after every separator that stands outside quotes."""
    outside = r'(?=(?:[^"]*"(?:[^"\\]|\\.)*")*[^"]*$)'
    return F.regexp_replace(as_col(c), r"([:,])" + outside, "$1 ")


def sorted_json(mapping) -> Column:
    """JSON text of a string map, keys sorted."""
    m = as_col(mapping)
    return spaced_json(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m)))))


#: names of HTML characters, from the standard library's table
_ENTITIES = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}


def unescape_html(c) -> Column:
    """Character references of HTML, by name or number, as characters; unknown ones stay."""
    c = as_col(c)
    shape = r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"

    def one(ref: Column) -> Column:
        body = F.substring(ref, F.lit(2), F.length(ref) - 2)
        number = F.when(F.lower(body).startswith("#x"), F.conv(F.substring(body, 3, 6), 16, 10)).otherwise(F.substring(body, 2, 7)).try_cast("int")
        as_char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.coalesce(F.when(F.startswith(body, F.lit("#")), F.when(valid, as_char)).otherwise(lookup(body, _ENTITIES)), ref)

    found = F.transform(F.regexp_extract_all(c, F.lit(shape), F.lit(0)), one)
    pieces = lambda v: F.transform(v["rest"], lambda text, i: F.concat(text, F.coalesce(F.try_element_at(v["found"], i + 1), F.lit(""))))
    decoded = let(F.struct(F.split(c, shape, -1).alias("rest"), found.alias("found")), lambda v: F.array_join(pieces(v), ""))
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)
