"""Identifier expressions: ECLI, CELEX, case and application numbers, languages, formations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import as_col, blank_to_null, first_rule, first_tok, lookup, strip, toks


def norm_ecli(c) -> Column:
    return blank_to_null(F.upper(strip(c)))


def primary_celex(c) -> Column:
    """First token of the cell, cut at the first underscore; missing gives ''."""
    first = F.substring_index(F.coalesce(as_col(c), F.lit("")), ";", 1)
    return strip(F.substring_index(first, "_", 1))


def preferred_celex(c) -> Column:
    """First token without INF (else the first), suffix cut, ``.NN`` written ``(NN)``."""
    tokens = toks(F.replace(as_col(c), F.lit(" "), F.lit("")))
    plain = F.filter(tokens, lambda t: ~F.contains(t, F.lit("INF")))
    token = F.coalesce(F.try_element_at(plain, F.lit(1)), F.try_element_at(tokens, F.lit(1)))
    return F.regexp_replace(F.substring_index(token, "_", 1), r"\.(\d{2})$", "($1)")


def base_celex(c) -> Column:
    return blank_to_null(F.regexp_replace(as_col(c), fixed.DERIVED_SUFFIX_EXT, ""))


def celex_ok(c) -> Column:
    bare = F.regexp_replace(as_col(c), fixed.DERIVED_SUFFIX, "")
    return F.coalesce(bare.rlike(fixed.CELEX_PATTERN), F.lit(False))


def celex_kind(c) -> Column:
    """Struct of court, document type and opinion flag."""
    c = F.coalesce(as_col(c), F.lit(""))
    shape = r"^[68]\d{4}([A-Z])([A-Z])"
    court, kind = F.regexp_extract(c, shape, 1), F.regexp_extract(c, shape, 2)
    return F.struct(
        lookup(court, fixed.CELEX_COURTS).alias("court"),
        F.coalesce(lookup(kind, fixed.CELEX_DOCTYPES), F.lit("other")).alias("doctype"),
        (kind == "C").alias("is_opinion"),
    )


def case_number(c) -> Column:
    shape = r"^[68](\d{4})([A-Z])[A-Z](\d{4})"
    c = as_col(c)
    letter = F.regexp_extract(c, shape, 2)
    letter = F.when(letter.isin("C", "T", "F"), letter).otherwise("C")
    number = F.regexp_extract(c, shape, 3).try_cast("int").cast("string")
    year = F.right(F.regexp_extract(c, shape, 1), F.lit(2))
    return F.when(c.rlike(shape), F.concat(letter, F.lit("-"), number, F.lit("/"), year))


def celex_year(c) -> Column:
    year = F.regexp_extract(as_col(c), r"^[0-9CE](\d{4})", 1).try_cast("int")
    return F.when(year.between(1950, 2100), year)


def act_type(c) -> Column:
    c = as_col(c)
    return first_rule(
        [
            (F.length(c) < 6, F.lit("eu_act")),
            (c.startswith("1") & F.contains(c, F.lit("/PRO")), F.lit("protocol")),
            (c.startswith("1"), F.lit("treaty")),
        ],
        F.coalesce(lookup(F.upper(F.substring(c, 6, 1)), fixed.ACT_TYPES), F.lit("eu_act")),
    )


def norm_lang(c) -> Column:
    """Language name to two letters; two-letter words pass; anything else is null."""
    word = F.lower(F.coalesce(first_tok(c), F.lit("")))
    return F.coalesce(
        lookup(word, fixed.LANGUAGE_NAMES), F.when(F.length(word) == 2, word)
    )


def norm_hudoc_lang(c) -> Column:
    return F.coalesce(lookup(as_col(c), fixed.HUDOC_LANGUAGES), F.lower(as_col(c)))


def formation_code(c) -> Column:
    words = F.lower(F.coalesce(as_col(c), F.lit("")))
    rules = []
    for code, keywords in fixed.FORMATIONS:
        hit = None
        for keyword in keywords:
            test = F.contains(words, F.lit(keyword))
            hit = test if hit is None else hit | test
        rules.append((hit, F.lit(code)))
    return first_rule(rules)


def importance(c) -> Column:
    """1 grand or full, 2 first to fifth, 3 any other formation, 4 unrecognised text."""
    code = formation_code(c)
    return first_rule(
        [
            (code.isin("GC", "FC"), F.lit(1)),
            (code.isin("1C", "2C", "3C", "4C", "5C"), F.lit(2)),
            (code.isNotNull(), F.lit(3)),
            (F.coalesce(as_col(c), F.lit("")) != "", F.lit(4)),
        ]
    )


def echr_date(judgement, reference, ecli) -> Column:
    ecli = as_col(ecli)
    digits = F.concat(F.split_part(ecli, F.lit(":"), F.lit(4)),
                      F.left(F.split_part(ecli, F.lit(":"), F.lit(5)), F.lit(4)))
    from_ecli = F.when(
        ecli.rlike("^ECLI:CE:ECHR:[0-9]{4}:[0-9]{4}"), F.try_to_date(digits, "yyyyMMdd")
    )
    return F.coalesce(as_col(judgement).cast("date"), as_col(reference).cast("date"), from_ecli)


def norm_appno(c) -> Column:
    """First application number in the text, leading zeros dropped."""
    c = as_col(c)
    number = F.regexp_extract(c, fixed.APPNO, 1).try_cast("int").cast("string")
    return F.when(number.isNotNull(),
                  F.concat(number, F.lit("/"), F.regexp_extract(c, fixed.APPNO, 2)))


def all_appnos(c) -> Column:
    """Every application number of the text, normalised, in order, without repeats."""
    c = as_col(c)
    found = F.regexp_extract_all(c, F.lit(fixed.APPNO), F.lit(0))
    return F.array_distinct(
        F.transform(found, lambda m: F.concat(
            F.substring_index(m, "/", 1).cast("int").cast("string"),
            F.lit("/"), F.substring_index(m, "/", -1)))
    )


def appno_from_ecli(c) -> Column:
    c = strip(c)
    number = F.regexp_extract(c, fixed.ECLI_APPNO, 1).try_cast("int")
    return F.when(number > 0, F.concat(number.cast("string"), F.lit("/"),
                                       F.regexp_extract(c, fixed.ECLI_APPNO, 2)))


def corpus_of(c) -> Column:
    ecli = F.upper(as_col(c))
    rules = [(ecli.startswith(prefix), F.lit(name)) for prefix, name in fixed.ECLI_CORPUS]
    return first_rule(rules + [(ecli.startswith("ECLI:"), F.lit("FOREIGN"))])


def is_cross(source_corpora, target_corpora, target_ecli, dataset) -> Column:
    """Disjoint source sets; else by the target prefix; else the dataset's default."""
    src = F.coalesce(as_col(source_corpora), F.array().cast("array<string>"))
    tgt, target = as_col(target_corpora), corpus_of(target_ecli)
    return first_rule(
        [
            ((F.size(src) > 0) & (F.coalesce(F.size(tgt), F.lit(0)) > 0), ~F.arrays_overlap(src, tgt)),
            ((F.size(src) > 0) & target.isNotNull(), ~F.array_contains(src, target)),
        ],
        as_col(dataset).isin(*fixed.CROSS_DATASETS),
    )


def protocol(c) -> Column:
    c = as_col(c)
    return F.when(c.rlike("^P[0-9]+(-|$)"), F.split_part(c, F.lit("-"), F.lit(1)))


def law_url(resource, version_date, label=None) -> Column:
    """Versioned deep link to an act; with a label, to the provision in the linked-data store."""
    day = F.coalesce(F.date_format(as_col(version_date), "yyyy-MM-dd"), F.lit("1900-01-01"))
    if label is None:
        return F.concat(F.lit("http://wetten.overheid.nl/id/"), as_col(resource), F.lit("/"), day, F.lit("/0"))
    return F.concat(
        F.lit("http://linkeddata.overheid.nl/terms/bwb/id/"), as_col(resource), F.lit("/"),
        as_col(label).cast("string"), F.lit("/"), day, F.lit("/"), day,
    )


def publication_key(journal, year, locator, annotator) -> Column:
    """Struct of kind and locator key; null key when the locator has no recognised shape."""
    journal_code = F.upper(F.regexp_replace(as_col(journal), r"[\s.]+", ""))
    number = F.upper(F.ltrim(F.regexp_replace(as_col(locator), r"\s+", ""), F.lit("/,")))
    note = F.regexp_replace(F.coalesce(as_col(annotator), F.lit("")), fixed.ANNOTATOR_TITLES, "")
    note = blank_to_null(F.btrim(F.regexp_replace(note, r"\s+", " "), F.lit(" ,;.:")))
    usable = (
        number.rlike(fixed.LOCATOR_PATTERN) & (journal_code != "")
        & ~journal_code.isin(*fixed.NOT_JOURNALS) & as_col(year).isNotNull()
    )
    key = F.concat(
        journal_code, F.lit(" "), as_col(year).cast("string"), F.lit("/"), number,
        F.coalesce(F.concat(F.lit(" m.nt. "), note), F.lit("")),
    )
    return F.struct(
        F.when(note.isNotNull(), "annotation").otherwise("literature").alias("kind"),
        F.when(usable, key).alias("key"),
        journal_code.alias("journal"),
    )
