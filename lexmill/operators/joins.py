"""Key resolution and lookup joins.

Join strategy is left to adaptive execution; a side is broadcast by hint only after
``small_side`` has counted it. Lookup sides are reduced to one row per key before the join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, ids
from ..functions import text as X
from .dedup import top_per_key
from .lineage import cut

BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint if the table has at most ``limit`` rows (counted with an early stop)."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def one_per_key(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """Lowest id per key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(id_col).alias(id_col))


def spread_key(key, *by) -> Column:
    """Key of the left side of a left join: rows without one get a key that no table has, by the columns ``by``.

    Null keys match nothing, but all of them would be dealt to one task.
    """
    return F.coalesce(X.as_col(key).cast("string"), F.concat(F.lit("\0"), F.xxhash64(*by).cast("string")))


def resolve_targets(edges: DataFrame, cases: DataFrame, raw: str, key: str, keep_raw: bool) -> DataFrame:
    """Target id by natural key; the raw value stays always, or only while unresolved."""
    table = one_per_key(cases, key, "case_id").select(F.col(key).alias("__key"), F.col("case_id").alias("target_case_id"))
    joined = edges.join(table, F.col(raw) == F.col("__key"), "left").drop("__key")
    return joined if keep_raw else joined.withColumn(raw, F.when(F.col("target_case_id").isNull(), F.col(raw)))


def resolve_by_item(edges: DataFrame, docs: DataFrame) -> DataFrame:
    """Source must be a held document, target may be; any variant's item id counts."""
    table = docs.select("item_id", "case_id")
    src = table.select(F.col("item_id").alias("source_item"), F.col("case_id").alias("source_case_id"))
    tgt = table.select(F.col("item_id").alias("target_item"), F.col("case_id").alias("target_case_id"))
    return edges.join(src, "source_item").join(tgt, "target_item", "left")


def resolve_case_key(refs: DataFrame, cases: DataFrame, id_col: str = "ref_id") -> DataFrame:
    """ECLI, else CELEX, else item id; hits on the source itself are dropped."""
    keys = (("ecli", "target_ecli"), ("celex_id", "target_celex"), ("item_id", "target_item"))
    wanted = refs.select(id_col, "source_case_id", F.inline(F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(case_col).alias("scheme"), F.col(ref_col).alias("value"))
        for i, (case_col, ref_col) in enumerate(keys)]))).where("value IS NOT NULL")
    held = cases.select("case_id", F.inline(F.array(*[
        F.struct(F.lit(case_col).alias("scheme"), F.col(case_col).alias("value")) for case_col, _ in keys
    ]))).where("value IS NOT NULL").groupBy("scheme", "value").agg(F.min("case_id").alias("case_id"))
    hits = wanted.join(held, ["scheme", "value"]).groupBy(id_col, "source_case_id").agg(
        F.min(F.struct("rank", "case_id", "scheme")).alias("best"))
    return hits.select(id_col, "source_case_id", F.col("best.case_id").alias("target_case_id"),
                       F.col("best.scheme").alias("scheme")).where("target_case_id <> source_case_id")


def resolve_alias(values: DataFrame, cases: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Case of an ECLI: its own first, then an alias identifier; lowest id each."""
    own = cases.select(F.col("ecli").alias("value"), F.lit(0).alias("via"), "case_id")
    alias = identifiers.where("scheme = 'ecli'").select(F.col("value_normalized").alias("value"), F.lit(1).alias("via"), "case_id")
    best = own.unionByName(alias).where("value IS NOT NULL").groupBy("value").agg(F.min(F.struct("via", "case_id")).alias("b"))
    return values.join(best.select("value", F.col("b.case_id").alias("case_id"), F.col("b.via").alias("via")), "value", "left")


def latest_provision(refs: DataFrame, provisions: DataFrame) -> DataFrame:
    """Newest provision of the reference's label; undated snapshots last."""
    newest = top_per_key(provisions.where("bwb_label_id IS NOT NULL"), ["bwb_label_id"],
                         [F.col("snapshot_date").desc_nulls_last(), F.col("element_id").asc()])
    table = newest.select(F.col("bwb_label_id").alias("raw_label_id"), F.col("element_id").alias("latest_provision_id"))
    return refs.join(table, "raw_label_id", "left")


def not_yet_loaded(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not loaded yet; null equals null."""
    known = old.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same: Column = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return new.join(known, same, "left_anti")


def absent(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    return new.join(old.select(key), key, "left_anti")


def having(df: DataFrame, other: DataFrame, key: str = "case_id") -> DataFrame:
    return df.join(other.select(key), key, "left_semi")


def join_either(staged: DataFrame, cases: DataFrame, ecli: str, item: str, out: str) -> DataFrame:
    """By ECLI, or by item id where the ECLI is missing: two equi joins, no nested loop."""
    by_ecli = one_per_key(cases, "ecli", "case_id").select(F.col("ecli").alias("__k"), F.col("case_id").alias(out))
    by_item = one_per_key(cases, "item_id", "case_id").select(F.col("item_id").alias("__k"), F.col("case_id").alias(out))
    first = staged.where(F.col(ecli).isNotNull()).join(by_ecli, F.col(ecli) == F.col("__k")).drop("__k")
    second = staged.where(F.col(ecli).isNull() & F.col(item).isNotNull()).join(by_item, F.col(item) == F.col("__k")).drop("__k")
    return first.unionByName(second)


def link_values(df: DataFrame, key: str, values: Column, dim: DataFrame, name: str, dim_id: str) -> DataFrame:
    """Distinct (key, dimension id) pairs of an array of names."""
    exploded = df.select(key, F.explode(values).alias(name)).distinct()
    return exploded.join(dim.select(name, dim_id), name).select(key, dim_id).distinct()


def assign_by_era(rows: DataFrame, rules: DataFrame, row_id: Sequence[str]) -> DataFrame:
    """Rule whose name, court and year range fit; rows that fit several rules stay unassigned.

    Court: equal, or when the row has none, the ECLI prefix. Name is the equi key.
    """
    year = F.coalesce(F.year("date_decision"), F.split_part("ecli", F.lit(":"), F.lit(4)).try_cast("int"))
    court = F.upper(F.coalesce(X.strip("court_code"), F.lit("")))
    prepared = rows.withColumn("__year", year).withColumn("__court", court)
    fits = (
        (F.col("full_name") == F.col("source_name"))
        & ((F.col("__court") == F.col("rule_court"))
           | ((F.col("__court") == "") & F.upper("ecli").startswith(F.col("ecli_prefix"))))
        & F.col("__year").between(F.col("min_year"), F.col("max_year"))
    )
    hits = prepared.join(small_side(rules), fits)
    return hits.groupBy(*row_id).agg(F.count("*").alias("n"), F.min("target_name").alias("target_name")).where(
        "n = 1").drop("n")


#: pieces of a docket number by which tokens are looked up: as long as the shortest token; counters of how common they are
PIECE, COUNTERS = 4, 1 << 14


def match_by_date_and_token(entries: DataFrame, docs: DataFrame) -> DataFrame:
    """Same decision date, and the token, of four characters or more, occurs in the docket number.

    A date can hold very many decisions, so the date alone is a poor key. All pieces of four
    characters of a token occur in a number that holds it: its rarest one is the join key, and the
    containment test runs only on rows that share it. Entries are distinct before the join, and a
    decision has one row a piece, so pairs come out of the join once: they are never shuffled, sorted or held.
    """
    compact = F.regexp_replace(F.lower(F.coalesce("zaaknummer", F.lit(""))), r"(?U)\s", "")
    pieces = lambda c: F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(c) - PIECE + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(PIECE))))
    # numbers are without blanks, so a token with one occurs in none
    asked = cut(entries.where((F.length("token") >= PIECE) & ~F.col("token").rlike(r"(?U)\s")).distinct())
    # only numbers of dates that are asked for are taken apart
    dated = docs.select("doc_id", "date_decision", "instance", compact.alias("__number")).where(F.length("__number") >= PIECE).join(
        small_side(asked.select("date_decision").distinct()), "date_decision", "left_semi")
    rare = _rarity(dated.select(F.explode(pieces("__number")).alias("piece")))
    key = F.array_min(F.transform(pieces(F.col("token")), lambda p: F.struct(rare(p).alias("rare"), p.alias("piece"))))["piece"]
    by_piece = lambda df: df.withColumn("__key", F.explode(pieces("__number")))
    own = ["date_decision", "doc_id", "instance"]
    numbers = dated.repartition(*own).distinct().withColumn("__n", F.count("*").over(Window.partitionBy(*own)))
    single = by_piece(numbers.where("__n = 1")).select(*own, "__key", "__number")
    # numbers of one decision that share a piece become one, with blanks between, which no token has
    several = by_piece(numbers.where("__n > 1")).groupBy(*own, "__key").agg(F.concat_ws(" ", F.collect_set("__number")).alias("__number"))
    # one row a piece: far more than the size of the documents lets expect, so the join goes by shuffle
    held = single.unionByName(several).hint("merge")
    hits = asked.withColumn("__key", key).hint("merge").join(held, ["date_decision", "__key"])
    return hits.where(F.contains("__number", "token")).select(*entries.columns, "doc_id", "instance")


def _rarity(pieces: DataFrame):
    """Function that gives a piece a byte, the higher the more common it is.

    Pieces are counted by hash into ``COUNTERS`` counters, whose logarithms are all that the plan carries. Pieces that
    share a counter seem more common than they are: this costs work, no match.
    """
    counter = lambda p: F.pmod(F.xxhash64(p), F.lit(COUNTERS)).cast("int")
    table = bytearray(COUNTERS)
    for place, n in pieces.groupBy(counter("piece")).count().collect():
        table[place] = min(255, round(8 * math.log2(1 + n)))
    return lambda p: F.substring(F.lit(bytes(table)), counter(p) + 1, F.lit(1))


def court_type(c) -> Column:
    name = F.lower(X.as_col(c))
    return X.first_rule([(F.contains(name, F.lit(word)), F.lit(kind)) for word, kind in fixed.COURT_TYPES])


def court_compatible(court, instance) -> Column:
    """Whether a court named in a referral can be the court of a decision."""
    kind, inst = court_type(court), F.lower(X.as_col(instance))
    unify = lambda c: F.replace(F.replace(F.lower(X.as_col(c)), F.lit("den haag"), F.lit("'s-gravenhage")),
                                F.lit("den bosch"), F.lit("'s-hertogenbosch"))
    there, here = unify(court), unify(instance)
    places = F.filter(F.array(*[F.lit(p) for p in fixed.COURT_PLACES]), lambda p: F.contains(there, p))
    place_ok = (F.size(places) == 0) | F.exists(places, lambda p: F.contains(here, p))
    named = F.contains(inst, F.lower(kind)) | ((kind == "Rechtbank") & F.contains(inst, F.lit("kantongerecht")))
    return X.first_rule(
        [
            (kind.isNull(), F.lit(True)),
            (kind == "Hoge Raad", inst == "hoge raad"),
            (kind.isin("Gerechtshof", "Rechtbank"), named & place_ok),
        ],
        F.contains(inst, F.lower(kind)),
    )


def match_by_court_date(entries: DataFrame, docs: DataFrame) -> DataFrame:
    """Entries whose court type and date have exactly one compatible decision.

    Decisions are first counted per (date, court): a unique answer needs no pair list.
    """
    courts = docs.where("instance <> 'Parket bij de Hoge Raad'").groupBy("date_decision", "instance").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    e = entries.where(court_type("court").isNotNull())
    hits = e.join(courts, "date_decision").where(
        F.contains(F.lower("instance"), F.lower(court_type("court"))) & court_compatible("court", "instance"))
    grouped = hits.groupBy("entry_id").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))
    return grouped.where("n = 1").select("entry_id", "doc_id")


def not_future(candidates: DataFrame, source_date: str, target_date: str) -> DataFrame:
    """Candidates not later than the citing decision; unknown dates pass."""
    later = F.col(target_date) > F.col(source_date)
    return candidates.where(~F.coalesce(later, F.lit(False)))


def shared_number_pairs(numbers: DataFrame, leads: DataFrame) -> DataFrame:
    """(lead item, other item) that share a number; only lead documents open a pair."""
    own = numbers.join(leads.select("item_id"), "item_id", "left_semi").select(F.col("item_id").alias("lead_item"), "appno")
    others = numbers.select(F.col("item_id").alias("other_item"), "appno")
    return own.join(others, "appno").where("lead_item <> other_item").select("lead_item", "other_item").distinct()


def lookup_act(refs: DataFrame, acts: DataFrame, provisions: DataFrame, ref_id: str = "ref_id") -> DataFrame:
    """Act by identifier, else by the first alternative found; then the article of that act."""
    options = refs.select(ref_id, F.posexplode(F.concat(
        F.array("identifier"), F.coalesce("alternatives", F.array().cast("array<string>")))).alias("pos", "identifier"))
    table = one_per_key(acts, "identifier", "act_id")
    best = options.join(table, "identifier").groupBy(ref_id).agg(F.min_by("act_id", "pos").alias("act_id"))
    articles = provisions.groupBy("act_id", F.lower("article_label").alias("article")).agg(F.min("provision_id").alias("provision_id"))
    return (
        refs.join(best, ref_id, "left")
        .withColumn("article", F.lower("article"))
        .join(articles, ["act_id", "article"], "left")
    )


def opinion_parent(opinions: DataFrame, cases: DataFrame) -> DataFrame:
    """Parent case by the case number inside a URI; lowest id."""
    number = F.regexp_extract("parent_raw", r"case/([CTF]-[0-9]+%2F[0-9]+|[CTF]-[0-9]+/[0-9]+)", 1)
    parents = one_per_key(cases, "case_number", "case_id").select("case_number", F.col("case_id").alias("parent_case_id"))
    return opinions.withColumn("case_number", X.blank_to_null(F.replace(number, F.lit("%2F"), F.lit("/")))).join(
        parents, "case_number", "left")


def opinion_links(docs: DataFrame) -> DataFrame:
    """Opinion to its judgment: CELEX letters swapped to CJ, else to CO."""
    opinions = docs.where(F.col("celex_id").rlike(r"^6\d{4}CC\d{4}$"))
    swapped = opinions.select(F.col("case_id").alias("source_case_id"), F.col("celex_id").alias("opinion"),
                              F.posexplode(F.array(F.lit("CJ"), F.lit("CO"))).alias("pos", "letters"))
    wanted = swapped.withColumn("celex_id", F.concat(F.left("opinion", F.lit(5)), "letters", F.right("opinion", F.lit(4))))
    targets = one_per_key(docs, "celex_id", "case_id").withColumnRenamed("case_id", "target_case_id")
    return wanted.join(targets, "celex_id").groupBy("source_case_id").agg(
        F.min_by(F.struct("target_case_id", "letters"), "pos").alias("b")).select("source_case_id", "b.*")


def cases_with_texts(cases: DataFrame, texts: DataFrame) -> DataFrame:
    """Cases left-joined to texts on ECLI; repeated column names get a suffix on the text side."""
    shared = [c for c in texts.columns if c in cases.columns and c != "ecli"]
    return cases.join(texts.withColumnsRenamed({c: f"{c}_text" for c in shared}), "ecli", "left")


def merge_conflicts(links: DataFrame, merges: DataFrame) -> DataFrame:
    """Per (old, new) person: links that would collide after the merge."""
    mine = links.join(small_side(merges), F.col("person_id") == F.col("old_id")).select("old_id", "new_id", "case_id", "role")
    kept = links.select(F.col("person_id").alias("new_id"), "case_id", "role").distinct()
    return mine.join(kept, ["new_id", "case_id", "role"]).groupBy("old_id", "new_id").agg(F.count("*").alias("conflicts"))


def documents_with_text(docs: DataFrame, canonical: DataFrame) -> DataFrame:
    return docs.join(canonical, ["case_id", "language"], "left")
