"""Corpus quality jobs: ambiguous identities, wrong bodies, classification, clean-up plans, gates."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, ids
from ..functions import text as X
from . import aggregates as A
from . import joins as J
from .dedup import best_text, dedup_cases, joined_set, rank_targets, top_per_key
from .lineage import cut


# --- build of the two corpus tables ------------------------------------------

def ambiguous_eclis(cases: DataFrame) -> DataFrame:
    """ECLIs known to one catalogue only whose CELEX another row also carries."""
    rows = cases.select("ecli", ids.primary_celex("celex").alias("__celex"),
                        (F.coalesce("identity_source", F.lit("")) == "infocuria").alias("single"))
    rows = rows.where("__celex <> ''")
    shared = rows.groupBy("__celex").agg(F.count("*").alias("n")).where("n > 1").select("__celex")
    return rows.where(F.col("single") & F.col("ecli").isNotNull()).join(shared, "__celex", "left_semi").select("ecli").distinct()


def blank_celex(df: DataFrame, eclis: DataFrame) -> DataFrame:
    """Null CELEX on the rows of the given ECLIs."""
    marked = eclis.select(ids.norm_ecli("ecli").alias("__ecli"), F.lit(True).alias("__blank")).distinct()
    joined = df.join(marked, ids.norm_ecli("ecli") == F.col("__ecli"), "left")
    return joined.withColumn("celex", F.when(F.col("__blank").isNull(), F.col("celex"))).drop("__ecli", "__blank")


def drop_misattached(chosen: DataFrame) -> DataFrame:
    """Drop untrusted copies of a body that several ECLIs share in a language.

    A trusted copy proves who owns the body; with no owner every untrusted copy goes. Group
    facts are a small table (only bodies with several ECLIs), so a body copied a million times
    is never gathered.
    """
    bodies = chosen.where(F.col("digest").isNotNull())
    trusted = F.col("text_source") == fixed.SOURCE_CELLAR
    per_ecli = bodies.groupBy("language", "digest", "ecli").agg(F.bool_or(trusted).alias("owner"))
    shared = per_ecli.groupBy("language", "digest").agg(F.count("*").alias("eclis")).where("eclis > 1")
    owners = per_ecli.where("owner").select("language", "digest", "ecli", F.lit(True).alias("owner"))
    wrong = (
        bodies.where(~F.coalesce(trusted, F.lit(False)))
        .join(shared, ["language", "digest"], "left_semi")
        .join(owners, ["language", "digest", "ecli"], "left_anti")
        .select("text_id")
    )
    return chosen.join(wrong, "text_id", "left_anti")


def consolidate_cases(rows: DataFrame, position: Sequence[str]) -> DataFrame:
    """One row per ECLI, provenance merged, ambiguous CELEX blanked."""
    cases = dedup_cases(rows, position)
    return blank_celex(cases, ambiguous_eclis(cases))


def consolidate_texts(texts: DataFrame, cases: DataFrame, position: Sequence[str] = ("text_id",)) -> DataFrame:
    """One text per (ECLI, language): best rendition, misattached copies gone, windows merged.

    Ranking, dropping, windows and blanked CELEX numbers are settled on narrow rows; the bodies are
    joined once, at the end, to the surviving ids.
    """
    keyed = texts.where(~X.is_blank("ecli"))
    loose = texts.where(X.is_blank("ecli"))
    chosen = cut(best_text(keyed, position))
    kept = drop_misattached(chosen).select("text_id", "ecli", "language", "effective_source")
    windows = joined_set(
        keyed.select(ids.norm_ecli("ecli").alias("ecli"), F.upper(X.strip("language")).alias("language"), "source_window"),
        ["ecli", "language"], "source_window").withColumnRenamed("source_window", "__windows")
    blank = ambiguous_eclis(cases).select(ids.norm_ecli("ecli").alias("ecli"), F.lit(True).alias("__blank")).distinct()
    facts = kept.join(windows, ["ecli", "language"], "left").join(blank, "ecli", "left").select(
        "text_id", F.col("effective_source").alias("__source"), "__windows", "__blank")
    rows = (
        keyed.join(facts, "text_id")
        .withColumn("text_source", F.col("__source"))
        .withColumn("source_window", F.coalesce("__windows", "source_window"))
        .withColumn("celex", F.when(F.col("__blank").isNull(), F.col("celex")))
    )
    return rows.select(*texts.columns).unionByName(loose)


def coverage_report(cases: DataFrame, texts: DataFrame) -> dict[str, DataFrame]:
    """Every table of the coverage section."""
    from .topk import top_cited

    return {
        "decades": A.coverage_by_decade(cases, texts),
        "sectors": A.atom_share(cases, "sector"),
        "languages": A.top_atoms(texts, "language", 10),
        "missing_reasons": A.top_atoms(texts, "missing_reasons", 5),
        "subjects": A.top_atoms(cases, "subject_matter", 15),
        "procedures": A.top_atoms(cases, "type_procedure", 10),
        "countries": A.top_atoms(cases, "origin_country", 15),
        "duplicates": A.dup_count(cases, "ecli"),
        "topology": A.citation_topology(cases),
        "top_cited": top_cited(cases, 10),
        "texts": A.metrics(texts, {"fulltext_total": F.count("*"),
                                   "fulltext_with_text": F.count_if(F.length("text") >= fixed.TEXT_MIN_CHARS)}),
    }


# --- what a stored text really is ---------------------------------------------

def corpus_index(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(own digest per ECLI and language, two lowest owner ECLIs per language and digest)."""
    rows = corpus.where(~X.is_blank("text")).select(
        ids.norm_ecli("ecli").alias("ecli"), F.lower(X.strip("language")).alias("language"), "text_id",
        F.coalesce("text_source", F.lit("")).alias("own_source"), F.md5(F.col("text").cast("binary")).alias("own_digest"))
    rows = cut(rows)
    own = top_per_key(rows, ["ecli", "language"], [F.col("text_id").desc()]).drop("text_id")
    users = rows.select("language", F.col("own_digest").alias("digest"), "ecli").distinct()
    two = Window.partitionBy("language", "digest").orderBy("ecli")
    ranked = users.withColumn("r", F.row_number().over(two)).where("r <= 2")
    owners = ranked.groupBy("language", "digest").agg(
        F.min("ecli").alias("owner1"), F.max(F.when(F.col("r") == 2, F.col("ecli"))).alias("owner2"))
    return own, owners


def classify_texts(stored: DataFrame, stored_cases: DataFrame, corpus: DataFrame, corpus_cases: DataFrame) -> DataFrame:
    """Kind, document CELEX and rule per stored text; rows no rule decides stay null."""
    own, owners = corpus_index(corpus)
    celex_of = corpus_cases.groupBy(ids.norm_ecli("ecli").alias("owner")).agg(
        F.min(ids.primary_celex("celex")).alias("owner_celex"))
    facts = stored_cases.select("case_id", ids.norm_ecli("ecli").alias("ecli"), F.col("celex_id").alias("case_celex"),
                                "date_decision", F.when(F.col("doctype").isin(*fixed.DECISION_KINDS), F.col("doctype"))
                                .otherwise("other").alias("case_kind"))
    rows = stored.select("text_id", "case_id", F.lower("language").alias("language"), "text_source",
                         F.md5(F.col("text").cast("binary")).alias("digest"), X.head("text").alias("head"))
    rows = rows.join(facts, "case_id").join(own, ["ecli", "language"], "left").join(owners, ["language", "digest"], "left")
    owner = F.when(F.col("owner1") == F.col("ecli"), F.col("owner2")).otherwise(F.col("owner1"))
    # most rows have no owner; each is dealt by its own hash then
    rows = rows.withColumn("owner", owner).withColumn("__owner", J.spread_key("owner", "text_id"))
    rows = rows.join(celex_of.withColumnRenamed("owner", "__owner"), "__owner", "left").drop("__owner")
    label = F.regexp_extract("head", fixed.CELEX_LABEL, 1)
    suffix = F.regexp_extract("head", fixed.CELEX_LABEL, 2)
    rows = rows.withColumn("label", X.blank_to_null(label)).withColumn("suffix", X.blank_to_null(suffix))
    dated, caps = X.carries_date("head", "date_decision"), X.caps_heading("head")
    portal = F.col("text_source") == fixed.SOURCE_INFOCURIA
    store = (F.col("text_source") == fixed.SOURCE_CELLAR) & F.col("date_decision").isNotNull()
    none = F.lit(None).cast("string")
    case_kind, case_celex, base = F.col("case_kind"), F.col("case_celex"), F.col("label")

    def verdict(kind, celex, rule):
        return F.struct(X.as_col(kind).alias("kind"), X.as_col(celex).alias("celex"), F.lit(rule).alias("rule"))

    undecided = F.lit(None).cast("struct<kind:string,celex:string,rule:string>")
    same = F.col("own_digest") == F.col("digest")
    decided = X.first_rule([
        (F.col("text_source").isin(fixed.SOURCE_RS, fixed.SOURCE_HUDOC) | F.col("digest").isNull(), undecided),
        (same & (F.col("own_source") == fixed.SOURCE_NOTICE), verdict(F.lit("oj_notice"), case_celex, "corpus")),
        (same, verdict(case_kind, case_celex, "corpus")),
        (F.col("owner").isNotNull(), verdict(F.lit("misfiled"), "owner_celex", "corpus-other-ecli")),
        (F.col("head").rlike(fixed.NOTICE_LABEL), verdict(F.lit("oj_notice"), case_celex, "label-dr")),
        (F.col("suffix").isin("SUM", "RES"), verdict(F.lit("summary"), base, "label")),
        (F.col("suffix") == "INF", verdict(F.lit("information"), base, "label")),
        (F.col("suffix") == "EXT", verdict(F.lit("extract"), base, "label")),
        (base == case_celex, verdict(case_kind, base, "label")),
        (base.isNotNull(), verdict(F.lit("misfiled"), base, "label-other-celex")),
        (portal & F.col("date_decision").isNull(), undecided),
        (portal & ~dated, verdict(F.lit("misfiled"), none, "infocuria-other-date")),
        (portal & caps, verdict(case_kind, case_celex, "infocuria-dated-decision")),
        (portal, verdict(F.lit("oj_notice"), case_celex, "infocuria-dated-notice")),
        (store & dated & caps, verdict(case_kind, case_celex, "cellar-dated-decision")),
        (store & dated, verdict(F.lit("information"), case_celex, "cellar-dated-information")),
    ], undecided)
    return rows.withColumn("v", decided).where("v IS NOT NULL").select(
        "text_id", "case_id", "language", "text_source", "digest", "head", "v.kind", "v.celex", "v.rule")


def dated_owner(misfiled: DataFrame, cases: DataFrame) -> DataFrame:
    """The one other case with the same number whose decision date the opening carries.

    Years and days of the opening become join keys, and cases are counted per (number, year,
    day) first, so a number shared by many cases costs one row per date.
    """
    digits = F.left("head", F.lit(300))
    spots = F.transform(F.sequence(F.lit(1), F.greatest(F.length(digits) - 3, F.lit(1))), lambda i: F.substring(digits, i, F.lit(4)))
    years = F.array_distinct(F.filter(spots, lambda y: y.rlike(r"^\d{4}$")))
    days = F.array_distinct(F.filter(F.regexp_extract_all(digits, F.lit(r"\d+"), F.lit(0)), lambda d: d.rlike(r"^[1-9]\d?$")))
    home = cases.select("case_id", "case_number")
    keys = (
        misfiled.select("text_id", "case_id", years.alias("years"), days.alias("days")).join(home, "case_id")
        .where("case_number IS NOT NULL")
        .withColumn("year", F.explode("years")).withColumn("day", F.explode("days")).drop("years", "days")
    )
    groups = cases.where("case_number IS NOT NULL AND date_decision IS NOT NULL").groupBy(
        "case_number", F.year("date_decision").cast("string").alias("year"), F.dayofmonth("date_decision").cast("string").alias("day")
    ).agg(F.count("*").alias("n"), F.min("case_id").alias("lo"), F.max("case_id").alias("hi"),)
    own = cases.select("case_id", F.year("date_decision").cast("string").alias("own_year"), F.dayofmonth("date_decision").cast("string").alias("own_day"))
    hits = keys.join(groups, ["case_number", "year", "day"]).join(own, "case_id")
    is_home = F.coalesce((F.col("own_year") == F.col("year")) & (F.col("own_day") == F.col("day")), F.lit(False)).cast("long")
    hits = hits.withColumn("others", F.col("n") - is_home).where("others > 0")
    other = F.when(F.col("lo") == F.col("case_id"), F.col("hi")).otherwise(F.col("lo"))
    return hits.groupBy("text_id").agg(F.sum("others").alias("n"), F.min(other).alias("owner_id")).where("n = 1").select("text_id", "owner_id")


def cleanup_plan(classified: DataFrame, cases: DataFrame, texts: DataFrame) -> DataFrame:
    """Action per misfiled text: drop (owner holds it), move to the owner, or keep with a reason.

    The first text by id claims a slot of the owner; later ones stay.
    """
    misfiled = cut(classified.where("kind = 'misfiled'"))
    bases = cases.where("celex_id IS NOT NULL").groupBy(ids.base_celex("celex_id").alias("base")).agg(F.max("case_id").alias("owner_id"))
    via_corpus = misfiled.where("rule = 'corpus-other-ecli'").select("text_id", ids.base_celex("celex").alias("base")).join(bases, "base").select("text_id", "owner_id")
    via_date = dated_owner(misfiled.where("rule <> 'corpus-other-ecli'"), cases)
    # rows without an owner need none of the joins by owner, where they would all meet in one task
    owners = cut(via_corpus.unionByName(via_date).where("owner_id IS NOT NULL"))
    owned, unknown = misfiled.join(owners, "text_id"), misfiled.join(owners, "text_id", "left_anti")
    slots = texts.select(F.col("case_id").alias("owner_id"), F.lower("language").alias("language"), "text_source",
                         F.md5(F.col("text").cast("binary")).alias("digest"))
    same_body = slots.select("owner_id", "language", "digest").distinct().withColumn("same_body", F.lit(True))
    same_source = slots.select("owner_id", "language", "text_source").distinct().withColumn("same_source", F.lit(True))
    owner_facts = cases.select(F.col("case_id").alias("owner_id"), F.col("doctype").alias("owner_doctype"), ids.base_celex("celex_id").alias("owner_celex"))
    rows = (
        owned.join(same_body, ["owner_id", "language", "digest"], "left")
        .join(same_source, ["owner_id", "language", "text_source"], "left")
        .join(owner_facts, "owner_id", "left")
    )
    claims = rows.where("same_body IS NULL AND same_source IS NULL").groupBy(
        "owner_id", "language", "text_source").agg(F.min("text_id").alias("claimant"))
    rows = rows.join(claims, ["owner_id", "language", "text_source"], "left")
    action = X.first_rule([
        (F.col("same_body"), F.lit("drop")),
        (F.col("same_source") | (F.col("claimant") != F.col("text_id")), F.lit("keep: owner has another text from this source")),
    ], F.lit("move"))
    kind = F.when(X.caps_heading("head"), F.when(F.col("owner_doctype").isin(*fixed.DECISION_KINDS), F.col("owner_doctype")).otherwise("other")).otherwise("oj_notice")
    moving = F.col("action") == "move"
    planned = rows.withColumn("action", action).select(
        "text_id", "case_id", "language", "action", "owner_id",
        F.when(moving, kind).alias("new_kind"), F.when(moving, F.col("owner_celex")).alias("new_celex"))
    return planned.unionByName(unknown.select("text_id", "case_id", "language", F.lit("keep: owner unknown").alias("action")), allowMissingColumns=True)


def carry_summaries(plan: DataFrame, texts: DataFrame) -> DataFrame:
    """What happens to the summary of every text that leaves its slot.

    texts: text_id, case_id, language, has_summary, has_text, misfiled. The first leaving text
    of a slot hands its summary to the best remaining row that lacks one.
    """
    leaving = cut(plan.where("action IN ('drop', 'move')").select("text_id", "action"))
    rows = texts.join(leaving, "text_id", "left")
    remaining = rows.where("action IS NULL").groupBy("case_id", "language").agg(
        F.min(F.struct("misfiled", (~F.col("has_text")).alias("no_text"), "text_id", "has_summary")).alias("t"))
    going = rows.where("action IS NOT NULL AND has_summary")
    firsts = going.groupBy("case_id", "language").agg(F.min("text_id").alias("first_id"))
    joined = going.join(remaining, ["case_id", "language"], "left").join(firsts, ["case_id", "language"])
    step = X.first_rule([
        (F.col("t").isNotNull() & ~F.col("t.has_summary") & (F.col("first_id") == F.col("text_id")), F.lit("copy")),
        (F.col("t").isNotNull(), F.lit("none")),
        (F.col("action") == "drop", F.lit("convert")),
    ], F.lit("recreate"))
    return joined.withColumn("step", step).select("text_id", "step", F.when(F.col("step") == "copy", F.col("t.text_id")).alias("target_id"))


def repair_celex(cases: DataFrame) -> DataFrame:
    """Derived CELEX to its base where no case holds the base; the lowest id claims it."""
    wanted = cases.select("case_id", F.col("celex_id").alias("old"), ids.base_celex("celex_id").alias("new")).where("old IS NOT NULL AND new <> old")
    free = wanted.join(cases.select(F.col("celex_id").alias("new")), "new", "left_anti")
    return top_per_key(free, ["new"], [F.col("case_id").asc()])


# --- finding texts to fetch or replace -----------------------------------------

def sparse_cases(cases: DataFrame, texts: DataFrame, min_langs: int, since: int) -> DataFrame:
    """Cases since a year with fewer than ``min_langs`` languages."""
    pairs = texts.select("ecli", F.upper("language").alias("l")).where("l IS NOT NULL AND l <> ''").distinct()
    counts = pairs.groupBy("ecli").agg(F.count("*").alias("langs"))
    year = F.year(X.parse_date(X.min_tok("date_publication")))
    tokens = X.toks("celex")
    plain = F.filter(tokens, lambda t: ~F.contains(t, F.lit("INF")))
    celex = F.substring_index(F.coalesce(F.try_element_at(plain, F.lit(1)), F.try_element_at(tokens, F.lit(1))), "_", 1)
    rows = cases.select("ecli", celex.alias("celex"), year.alias("year")).where("ecli IS NOT NULL AND celex <> ''")
    return rows.where(F.col("year") >= since).join(counts, "ecli", "left").where(
        F.coalesce("langs", F.lit(0)) < min_langs).select("ecli", "celex", F.coalesce("langs", F.lit(0)).alias("langs"))


def source_index(texts: DataFrame, source: str = fixed.SOURCE_INFOCURIA) -> DataFrame:
    rows = texts.where((F.col("text_source") == source) & ~X.is_blank("ecli") & ~X.is_blank("language"))
    return rows.select("text_id", "ecli", F.upper("language").alias("language"), F.length(F.coalesce("text", F.lit(""))).alias("length"))


def nonjudgment_index(texts: DataFrame) -> DataFrame:
    """Trusted rows taken from a summary, résumé or information work."""
    derived = F.exists(X.toks("celex"), lambda t: F.upper(t).rlike(fixed.DERIVED_SUFFIX))
    return source_index(texts.where(derived), fixed.SOURCE_CELLAR)


def accept_replacements(stored: DataFrame, fetched: DataFrame, ratio: float = fixed.REPLACE_RATIO) -> DataFrame:
    """Fetched texts longer than ratio times the stored length; ratio 0 takes any non-empty text."""
    old = stored.select("ecli", F.upper("language").alias("language"), F.length("text").alias("stored_length")).groupBy(
        "ecli", "language").agg(F.max("stored_length").alias("stored_length"))
    new = fetched.withColumn("language", F.upper("language")).where(F.length("text") > 0)
    joined = new.join(old, ["ecli", "language"])
    # in decimals: 1.005 times 200 is 201 and no less
    least = F.lit(Decimal(str(ratio))) * F.col("stored_length")
    return joined.where(F.length("text") > least) if ratio else joined


def expected_targets(texts: DataFrame) -> DataFrame:
    """Expected (ECLI, CELEX) of the texts view: the base CELEX of the case."""
    year = F.lit(1995) + F.col("case_id") % 7
    number = F.lpad((F.col("case_id") % 10000).cast("string"), 4, "0")
    return texts.select("ecli", F.concat(F.lit("6"), year.cast("string"), F.lit("CJ"), number).alias("celex")).distinct()


def verify_targets(expected: DataFrame, texts: DataFrame, languages: Sequence[str] = ("EN", "ENG", "ENGLISH")) -> DataFrame:
    """Status per expected (ECLI, CELEX): pass, missing, empty, other manifestation, or suspect."""
    rows = texts.where(F.upper("language").isin(*languages))
    best = rank_targets(expected, rows)
    wanted = expected.select(ids.norm_ecli("ecli").alias("ecli"), F.upper(X.strip("celex")).alias("expected_celex"))
    any_match = rows.select(ids.norm_ecli("ecli").alias("ecli"), F.explode(F.transform(X.toks("celex"), F.upper)).alias("expected_celex")).distinct().withColumn("any_match", F.lit(True))
    keys = ["ecli", "expected_celex"]
    joined = wanted.join(best, keys, "left").join(any_match, keys, "left")
    status = X.first_rule([
        (F.col("text_id").isNull(), F.lit("missing")),
        (F.col("blank"), F.lit("empty")),
        (F.col("any_match").isNull(), F.lit("non_judgment_manifestation")),
        (~F.col("judgment"), F.lit("suspect_not_judgment")),
    ], F.lit("pass"))
    return joined.select(*keys, status.alias("status"), "text_id", F.coalesce("length", F.lit(0)).alias("length"))


def compare_bodies(a: DataFrame, b: DataFrame) -> DataFrame:
    """Exact, mismatch or missing per (ECLI, language) by whitespace-normalised digest."""
    side = lambda df, name: df.select(ids.norm_ecli("ecli").alias("ecli"), F.lower("language").alias("language"),
                                      X.body_sha256("text").alias(name))
    joined = side(a, "left_sha").join(side(b, "right_sha"), ["ecli", "language"], "full_outer")
    status = X.first_rule([
        (F.col("left_sha").isNull(), F.lit("missing_left")), (F.col("right_sha").isNull(), F.lit("missing_right")),
        (F.col("left_sha") == F.col("right_sha"), F.lit("exact_match"))], F.lit("mismatch"))
    return joined.select("ecli", "language", status.alias("status"))


def preflight_errors(expected: DataFrame, texts: DataFrame, language: str = "en") -> DataFrame:
    """Targets without a valid full judgment in the language, with the reason."""
    rows = texts.where(F.lower("language") == language)
    best = rank_targets(expected, rows, fixed.JUDGMENT_MARKERS)
    wanted = expected.select(ids.norm_ecli("ecli").alias("ecli"), F.upper(X.strip("celex")).alias("expected_celex"))
    joined = wanted.join(best, ["ecli", "expected_celex"], "left")
    error = X.first_rule([
        (F.col("text_id").isNull(), F.lit("missing row")), (~F.col("celex_match"), F.lit("other CELEX")),
        (~F.col("judgment"), F.lit("not a full judgment"))])
    return joined.withColumn("error", error).where("error IS NOT NULL").select("ecli", "expected_celex", "error")


def preflight(expected: DataFrame, texts: DataFrame, language: str = "en") -> None:
    """Stop before any write if a target fails; the message shows the first twenty."""
    bad = preflight_errors(expected, texts, language).orderBy("ecli").limit(20).collect()
    if bad:
        raise RuntimeError(f"target preflight failed: {[(r.ecli, r.error) for r in bad]}")


# --- gates ----------------------------------------------------------------------

def identity_gate(cases: DataFrame, required: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Violations of required ECLI-CELEX pairs, forbidden ECLIs, and one CELEX per ECLI."""
    pairs = cases.select(X.strip("ecli").alias("ecli"), ids.preferred_celex("celex").alias("celex")).where(
        "ecli <> '' AND celex <> ''").distinct()
    held = pairs.groupBy("ecli").agg(F.count("*").alias("n"), F.min("celex").alias("celex"))
    conflicts = held.where("n > 1").select("ecli", F.lit("identity_conflict").alias("violation"))
    wanted = required.select("ecli", F.col("celex").alias("expected"))
    missing = wanted.join(held, "ecli", "left_anti").select("ecli", F.lit("missing_required").alias("violation"))
    exact = pairs.select("ecli", F.col("celex").alias("expected"))
    mismatched = wanted.join(exact, ["ecli", "expected"], "left_anti").join(held, "ecli", "left_semi").select(
        "ecli", F.lit("mismatched_required").alias("violation"))
    stale = held.join(forbidden, "ecli", "left_semi").select("ecli", F.lit("stale_present").alias("violation"))
    return A.union_all([conflicts, missing, mismatched, stale])


def gate_rules(spark, min_cases: int = fixed.MIN_CASE_ROWS, min_texts: int = fixed.MIN_FULLTEXT_ROWS) -> DataFrame:
    rows = [(m, "equals", 0) for m in fixed.ZERO_GATES + fixed.BASELINE_GATES]
    rows += [("cases_rows", "at_least", min_cases), ("fulltexts_rows", "at_least", min_texts)]
    return spark.createDataFrame(rows, "metric string, rule string, bound long")


def publish_gates(report: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules the report breaks; a metric that is absent breaks its rule."""
    joined = rules.join(report.select("metric", "value"), "metric", "left")
    holds = X.first_rule([
        (F.col("rule") == "equals", F.col("value").eqNullSafe(F.col("bound"))),
    ], F.coalesce(F.col("value") >= F.col("bound"), F.lit(False)))
    return joined.where(~holds)


def missing_texts(cases: DataFrame, texts: DataFrame, position: str = "text_id") -> DataFrame:
    """Documents without usable text from the source they need; the legacy fallback is no text."""
    filled = ~X.is_blank("text")
    per_ecli = texts.where(~X.is_blank("ecli")).groupBy("ecli").agg(
        F.bool_or(filled & (F.col("text_source") != fixed.SOURCE_LEGACY)).alias("has_text"),
        F.bool_or(filled & (F.col("text_source") == fixed.SOURCE_CELLAR)).alias("has_cellar"),
        F.min_by("celex", position).alias("celex"))
    identity = cases.groupBy("ecli").agg(F.max("identity_source").alias("identity_source"))
    rows = per_ecli.join(identity, "ecli", "left")
    sector = F.left(X.strip("celex"), F.lit(1))
    need = X.first_rule([
        ((F.col("identity_source") == "infocuria") & ~F.col("has_text"), F.lit("portal_text")),
        (F.col("identity_source") == "infocuria", F.lit(None).cast("string")),
        ((sector == "6") & ~F.col("has_cellar"), F.lit("store_text")),
        ((sector == "8") & ~F.col("has_cellar") & ~F.col("has_text"), F.lit("any_text")),
    ])
    return rows.withColumn("need", need).where("need IS NOT NULL").select("ecli", "celex", "need")


def validate_new(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Verdict per new row: error text, warning text, or valid."""
    owners = existing.where("celex_id IS NOT NULL").groupBy(F.col("celex_id").alias("celex")).agg(F.min("ecli").alias("owner"))
    attached = existing.select("ecli", F.lit(True).alias("held"), F.col("celex_id").alias("held_celex"))
    per_celex = new.where("celex IS NOT NULL").groupBy("celex").agg(F.count("*").alias("sharers"))
    rows = new.join(owners, "celex", "left").join(per_celex, "celex", "left").join(attached, "ecli", "left")
    error = X.first_rule([
        (F.col("celex").isNull(), F.lit(None).cast("string")),
        (~ids.celex_ok("celex"), F.lit("malformed")),
        (F.col("owner") != F.col("ecli"), F.lit("owned by another case")),
        (F.col("sharers") > 1, F.lit("shared by new rows")),
    ])
    checked = F.col("error").isNull() & F.col("celex").isNotNull()
    warning = F.concat_ws(
        ";",
        F.when(checked & ~F.col("ecli").startswith("ECLI:"), "non-standard ECLI"),
        F.when(checked & F.col("date_decision").isNull(), "no date"),
        F.when(checked & F.col("held") & (F.col("held_celex") != F.col("celex")), "other CELEX held"),
    )
    return rows.withColumn("error", error).select("ecli", "celex", "error", warning.alias("warnings"), F.col("error").isNull().alias("valid"))


def count_drift(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Cases whose stored counts differ from the recomputed ones."""
    new = recomputed.select("case_id", F.col("cites_count").alias("new_cites"), F.col("cited_by_count").alias("new_cited_by"))
    joined = stored.join(new, "case_id", "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    drift = joined.select("case_id", (zero("cites_count") - zero("new_cites")).alias("cites_drift"),
                          (zero("cited_by_count") - zero("new_cited_by")).alias("cited_by_drift"))
    return drift.where("cites_drift <> 0 OR cited_by_drift <> 0")
