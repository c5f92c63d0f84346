"""Incremental maintenance: table in, new table (or change set) out.

There is no MERGE here: every job is a dedup, an anti or semi join and a union, and running it
twice gives the same table. Callers publish the result by swapping a folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, ids
from ..functions import text as X
from .dedup import dedup_edges, top_per_key
from .joins import assign_by_era, not_yet_loaded, spread_key
from .sets import conform


# --- inserts, replacements, updates ------------------------------------------------

def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column], where: str | None = None) -> DataFrame:
    """Rows to insert: new keys only, one per key; rows outside ``where`` are not keyed and stay out."""
    keyed, held = (new.where(where), old.where(where)) if where else (new, old)
    return not_yet_loaded(top_per_key(keyed, list(keys), order), held, keys)


def _text_key(df: DataFrame) -> DataFrame:
    return df.withColumn("__e", F.coalesce("ecli", F.lit(""))).withColumn("__l", F.coalesce(F.upper("language"), F.lit("")))


def new_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """New rows whose (ECLI, language) pair is not held; of the old table only the keys are read."""
    known = _text_key(old).select("__e", "__l").distinct()
    return _text_key(new).join(known, ["__e", "__l"], "left_anti").drop("__e", "__l")


def append_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows plus new (ECLI, language) pairs; columns are united, old types win."""
    return conform(old, new_rows(old, new))


def replace_rows(old: DataFrame, new: DataFrame, position: str) -> tuple[DataFrame, DataFrame]:
    """(new table, dropped rows): replacements supersede stored keys, the last one in wins."""
    last = top_per_key(_text_key(new), ["__e", "__l"], [F.col(position).desc()])
    keys = last.select("__e", "__l")
    keyed = _text_key(old)
    kept = keyed.join(keys, ["__e", "__l"], "left_anti").drop("__e", "__l")
    dropped = keyed.join(keys, ["__e", "__l"], "left_semi").drop("__e", "__l")
    return conform(kept, last.drop("__e", "__l", position)), dropped


def sync_texts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Action per incoming text: unchanged, update, upgrade a stale source in place, or insert.

    A slot (case, language) holds one row per source, so its state is a short array; incoming
    rows are folded over it in position order because an upgrade changes what the next one sees.
    stored: text_id, case_id, language, text_source, text. incoming: position and the same.
    """
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    row = "struct<id:bigint,source:string,md5:string>"
    slots = stored.select("case_id", F.lower("language").alias("language"), F.struct(
        F.col("text_id").cast("long").alias("id"), F.col("text_source").alias("source"), digest.alias("md5")).alias("r"))
    slots = top_per_key(slots.withColumn("s", F.col("r.source")), ["case_id", "language", "s"], [F.col("r.id").asc()])
    slots = slots.groupBy("case_id", "language").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    named = incoming.select("case_id", F.lower("language").alias("language"), F.coalesce("text_source", F.lit("UNKNOWN")).alias("source"),
                            digest.alias("md5"), F.col("position").cast("long").alias("position")).where("case_id IS NOT NULL AND language <> ''")
    named = top_per_key(named, ["case_id", "language", "source"], [F.col("position").asc()])
    arriving = named.groupBy("case_id", "language").agg(F.array_sort(F.collect_list(F.struct("position", "source", "md5"))).alias("incoming"))
    slot = arriving.join(slots, ["case_id", "language"], "left").withColumn("rows", F.coalesce("rows", F.array().cast(f"array<{row}>")))
    act = "struct<position:bigint,action:string,target_id:bigint>"
    start = F.struct(F.col("rows").alias("rows"), F.array().cast(f"array<{act}>").alias("acts"))

    def step(state: Column, inc: Column) -> Column:
        same = F.filter(state["rows"], lambda r: r["source"] == inc["source"])
        stale = F.filter(state["rows"], lambda r: (r["source"] != fixed.SOURCE_RS) & (r["source"] != inc["source"]))
        hit = F.coalesce(F.get(same, 0), F.get(stale, 0))
        action = X.first_rule([
            ((F.size(same) > 0) & (F.get(same, 0)["md5"] == inc["md5"]), F.lit("unchanged")),
            (F.size(same) > 0, F.lit("update")), (F.size(stale) > 0, F.lit("upgrade"))], F.lit("insert"))
        fresh = lambda i: F.struct(i.alias("id"), inc["source"].alias("source"), inc["md5"].alias("md5")).cast(row)
        changed = F.when(
            hit.isNotNull(), F.transform(state["rows"], lambda r: F.when(r["source"] == hit["source"], fresh(r["id"])).otherwise(r))
        ).otherwise(F.concat(state["rows"], F.array(fresh(F.lit(None).cast("long")))))
        record = F.struct(inc["position"].alias("position"), action.alias("action"), hit["id"].alias("target_id")).cast(act)
        return F.struct(changed.cast(f"array<{row}>").alias("rows"), F.concat(state["acts"], F.array(record)).alias("acts"))

    folded = slot.select("case_id", "language", F.aggregate("incoming", start, step)["acts"].alias("acts"))
    return folded.select("case_id", "language", F.inline("acts"))


def fill_empty(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Upsert that fills only empty columns of stored rows."""
    incoming = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = old.join(incoming, list(keys), "full_outer")
    return joined.select(*keys, *[F.when(X.is_blank(c), F.coalesce(f"__{c}", c)).otherwise(F.col(c)).alias(c) for c in columns])


def plan_new(corpus: DataFrame, held: DataFrame, cases: DataFrame) -> DataFrame:
    """Per corpus row: already there, attach to an existing case, or new."""
    known = held.select("ecli", F.lit(True).alias("__held"))
    existing = cases.select("ecli", "case_id")
    verdict = X.first_rule([(F.col("__held"), F.lit("already")), (F.col("case_id").isNotNull(), F.lit("attach"))], F.lit("new"))
    return corpus.select("ecli").distinct().join(known, "ecli", "left").join(existing, "ecli", "left").select("ecli", verdict.alias("plan"), "case_id")


def maintain_sources(cases: DataFrame, satellites: DataFrame) -> DataFrame:
    """Membership arrays from satellites: kept corpora in their order, newly attached ones behind."""
    current = satellites.select("case_id", "corpus").distinct().groupBy("case_id").agg(F.array_sort(F.collect_list("corpus")).alias("now"))
    joined = cases.join(current, "case_id", "left").withColumn("now", F.coalesce("now", F.array().cast("array<string>")))
    kept = F.filter("sources", lambda s: F.array_contains("now", s))
    return joined.select("case_id", F.concat(kept, F.array_except("now", "sources")).alias("sources"))


def apply_count_deltas(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """New counts after edge changes, floored at zero.

    changes: old_source, old_target, new_source, new_target (null sides for inserts and deletes).
    """
    side = lambda c, o, i: F.struct(F.col(c).alias("case_id"), F.lit(o).alias("o"), F.lit(i).alias("i"))
    sides = changes.select(F.inline(F.array(side("old_source", -1, 0), side("old_target", 0, -1), side("new_source", 1, 0), side("new_target", 0, 1)))).where("case_id IS NOT NULL")
    delta = sides.groupBy("case_id").agg(F.sum("o").alias("d_cites"), F.sum("i").alias("d_cited_by"))
    joined = counts.join(delta, "case_id", "full_outer")
    value = lambda c, d: F.greatest(F.coalesce(c, F.lit(0)) + F.coalesce(d, F.lit(0)), F.lit(0)).alias(c)
    return joined.select("case_id", value("cites_count", "d_cites"), value("cited_by_count", "d_cited_by"))


def delete_cases(edges: DataFrame, cases: DataFrame, doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges after the delete, twin collisions): incoming links fall back to raw identifiers."""
    gone = cases.join(doomed, "case_id", "left_semi").select(F.col("case_id").cast("string").alias("__id"), F.col("ecli").alias("__ecli"), F.col("celex_id").alias("__celex"), F.lit(True).alias("__gone"))
    left = edges.join(doomed.select(F.col("case_id").alias("source_case_id")), "source_case_id", "left_anti")
    # open links have no target; they are dealt by their own hash
    hit = left.join(gone, spread_key("target_case_id", *edges.columns) == F.col("__id"), "left").withColumn("__gone", F.coalesce("__gone", F.lit(False)))
    after = hit.withColumn("target_ecli_raw", F.coalesce("target_ecli_raw", "__ecli")).withColumn(
        "target_celex_raw", F.coalesce("target_celex_raw", "__celex")).withColumn(
        "target_case_id", F.when(~F.col("__gone"), F.col("target_case_id")))
    keys = ["source_case_id", "relation_type", "source_dataset", "target_ecli_raw", "target_celex_raw"]
    fallen = after.where("__gone").select(*keys).distinct()
    old_open = edges.where("target_case_id IS NULL").select(*keys)
    collisions = fallen.join(old_open, [fallen[k].eqNullSafe(old_open[k]) for k in keys], "left_semi")
    return after.select(*edges.columns), collisions


def swap_dataset(edges: DataFrame, staged: DataFrame, sources: DataFrame, old_dataset: str, new_dataset: str) -> tuple[DataFrame, DataFrame]:
    """(live edges, archive): old rows of the given sources are archived and the staged rows go live."""
    mine = edges.where(F.col("source_dataset") == old_dataset)
    archive = mine.join(sources.select("source_case_id"), "source_case_id", "left_semi")
    kept = edges.join(archive.select("edge_id"), "edge_id", "left_anti")
    live = staged.withColumn("source_dataset", F.lit(new_dataset))
    return kept.unionByName(dedup_edges(live).select(*edges.columns)), archive


def rollback_swap(live: DataFrame, archive: DataFrame, new_dataset: str) -> DataFrame:
    """The table before the swap, from the archive."""
    return live.where(~F.col("source_dataset").eqNullSafe(new_dataset)).unionByName(archive.select(*live.columns))


def rekey_language(texts: DataFrame, names=fixed.LANGUAGE_NAMES) -> DataFrame:
    """Language words become codes; a summary moves to the coded sibling, then the word row goes."""
    coded = texts.withColumn("__iso", X.lookup("language", names))
    word = coded.where("__iso IS NOT NULL")
    rest = texts.where(X.lookup("language", names).isNull())
    key = ["case_id", "text_source", "language"]
    carried = word.where("summary IS NOT NULL").groupBy("case_id", "text_source", F.col("__iso").alias("language")).agg(F.min_by("summary", "text_id").alias("__carried"))
    siblings = rest.select(*key).distinct()
    kept = rest.join(carried, key, "left").withColumn("summary", F.coalesce("summary", "__carried")).drop("__carried")
    renamed = word.withColumn("language", F.col("__iso")).drop("__iso").join(siblings, key, "left_anti")
    renamed = top_per_key(renamed, key, [F.col("text_id").asc()]).join(carried, key, "left").withColumn("summary", F.coalesce("summary", "__carried")).drop("__carried")
    return kept.select(*texts.columns).unionByName(renamed.select(*texts.columns))


# --- people --------------------------------------------------------------------------

def merge_people(people: DataFrame, links: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(people, links) after merging duplicates; aliases move along, colliding links collapse.

    merges: old_name, new_name. People of a listed name join the first holder of the new name; one
    that nobody holds is taken by renaming. Namesakes that are not listed stay apart.
    """
    spec = merges.groupBy("old_name").agg(F.min("new_name").alias("new_name"))
    named = people.join(spec, F.col("full_name") == F.col("old_name"), "left").withColumn("final_name", F.coalesce("new_name", "full_name"))
    first = named.groupBy("final_name").agg(
        F.min(F.struct(F.col("new_name").isNotNull().alias("moved"), "person_id")).alias("h"), F.bool_or(F.col("new_name").isNotNull()).alias("listed"))
    taker = first.where("listed").select(F.col("final_name").alias("new_name"), F.col("h.person_id").alias("taker"))
    mapped = named.join(taker, "new_name", "left").withColumn("keep_id", F.coalesce("taker", "person_id"))
    holder = mapped.select("keep_id", "final_name").distinct()
    empty = F.array().cast("array<string>")
    own = F.filter(F.concat(F.coalesce("aliases", empty), F.when(F.col("old_name").isNotNull(), F.array("old_name")).otherwise(empty)), lambda a: a.isNotNull())
    alias_rows = mapped.select("keep_id", "final_name", F.explode(own).alias("a")).distinct()
    gathered = alias_rows.groupBy("keep_id", "final_name").agg(F.collect_list("a").alias("all"))
    merged = holder.join(gathered, ["keep_id", "final_name"], "left").select(
        F.col("keep_id").alias("person_id"), F.col("final_name").alias("full_name"), X.merge_aliases("final_name", F.coalesce("all", empty)).alias("aliases"))
    moved = links.join(mapped.select("person_id", "keep_id"), "person_id").select("case_id", F.col("keep_id").alias("person_id"), "role").distinct()
    return merged, moved


def split_homonyms(links: DataFrame, rules: DataFrame) -> DataFrame:
    """Links of shared names go to the one person whose court and years fit; others stay."""
    row_id = ["case_id", "person_id", "role"]
    assigned = assign_by_era(links, rules, row_id)
    return links.join(assigned, row_id, "left").select(*row_id, F.coalesce("target_name", "full_name").alias("full_name"), F.col("target_name").isNotNull().alias("moved"))


def fix_names(rows: DataFrame, accents: DataFrame, verified: DataFrame, candidates: DataFrame) -> DataFrame:
    """Corrected name, category and basis: accent map, doubled name, two-person fusion.

    rows: row_id, name, ecli, header. verified: fused, ecli, target. candidates: fused,
    candidate; a header that names exactly one candidate decides.
    """
    accent = accents.select(F.col("wrong").alias("name"), F.col("right").alias("__accent"))
    half = X.unconcat("name")
    base = rows.withColumn("__half", half).join(accent, "name", "left").join(
        accents.select(F.col("wrong").alias("__half"), F.col("right").alias("__half_accent")), "__half", "left")
    sure = verified.select(F.col("fused").alias("name"), F.col("ecli").alias("__ecli"), F.col("target").alias("__sure"))
    base = base.withColumn("__ecli", ids.norm_ecli("ecli")).join(sure, ["name", "__ecli"], "left")
    folded = lambda c: F.translate(F.lower(c), "áàâäãéèêëíìîïóòôöõúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
    header = F.concat(F.lit(" "), F.regexp_replace(folded(F.left(F.coalesce("header", F.lit("")), F.lit(260))), r"[^\p{L}\p{N}' -]", " "))
    pairs = base.select("row_id", "name", header.alias("h")).join(candidates.withColumnRenamed("fused", "name"), "name")
    # the candidate must start at a word boundary
    hits = pairs.where(F.contains("h", F.concat(F.lit(" "), folded(F.col("candidate")))))
    single = hits.groupBy("row_id").agg(F.count_distinct("candidate").alias("n"), F.min("candidate").alias("__by_header")).where("n = 1").select("row_id", "__by_header")
    fused = candidates.select(F.col("fused").alias("name")).distinct().withColumn("__fused", F.lit(True))
    base = base.join(single, "row_id", "left").join(fused, "name", "left")
    category = X.first_rule([
        (F.col("__accent").isNotNull(), F.lit("diacritic")), (F.col("__half").isNotNull(), F.lit("self_concatenation")),
        (F.col("__sure").isNotNull() | (F.col("__fused") & F.col("__by_header").isNotNull()), F.lit("two_person_fusion")),
        (F.col("__fused"), F.lit("unresolved_fusion"))])
    target = X.first_rule([
        (F.col("__accent").isNotNull(), F.col("__accent")), (F.col("__half").isNotNull(), F.coalesce("__half_accent", "__half")),
        (F.col("__sure").isNotNull(), F.col("__sure")), (F.col("__fused"), F.col("__by_header"))])
    return base.select("row_id", "name", target.alias("target"), category.alias("category")).where("category IS NOT NULL")


def resolve_uri_people(people: DataFrame, links: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decision per URI person, new links): rename, merge into a namesake, split, or unresolved.

    names: uri, name (``;`` joins several persons). Lowest id is the namesake; the first of
    several URIs with one new name is renamed, the others merge into it.
    """
    is_uri = F.lower("full_name").rlike("^https?://")
    held = people.where(~is_uri & ~X.is_blank("full_name")).groupBy(F.lower(X.strip("full_name")).alias("k")).agg(F.min("person_id").alias("held_id"))
    rows = people.where(is_uri).join(names, F.col("full_name") == F.col("uri"), "left").withColumn(
        "parts", F.transform(X.toks("name"), X.collapse)).withColumn("k", F.lower(F.get("parts", 0)))
    single = rows.where(F.size("parts") == 1).join(held, "k", "left")
    firsts = single.where("held_id IS NULL").groupBy("k").agg(F.min("person_id").alias("first_id"))
    single = single.join(firsts, "k", "left").withColumn("into", F.coalesce("held_id", "first_id"))
    single = single.select("person_id", F.when(F.col("into") == F.col("person_id"), "rename").otherwise("merge").alias("action"), F.col("into").alias("into_id"), F.get("parts", 0).alias("name"))
    other = rows.where(F.size("parts") != 1).select("person_id", F.when(F.size("parts") > 1, "split").otherwise("unresolved").alias("action"),
                                                    F.lit(None).cast("long").alias("into_id"), F.array_join("parts", ";").alias("name"))
    decisions = single.unionByName(other)
    every = held.unionByName(firsts.select("k", F.col("first_id").alias("held_id"))).groupBy("k").agg(F.min("held_id").alias("held_id"))
    split = rows.where(F.size("parts") > 1).select("person_id", F.explode("parts").alias("part")).withColumn("k", F.lower("part")).join(every, "k", "left")
    moves = decisions.where("action = 'merge'").select("person_id", F.col("into_id").cast("string").alias("new_key")).unionByName(
        split.select("person_id", F.coalesce(F.col("held_id").cast("string"), F.concat(F.lit("new:"), "k")).alias("new_key")))
    moved = links.join(moves, "person_id", "left").select("case_id", F.coalesce("new_key", F.col("person_id").cast("string")).alias("person_key"), "role").distinct()
    return decisions, moved


# --- windows --------------------------------------------------------------------------

def windows(spans: DataFrame, kind: str) -> DataFrame:
    """Calendar windows over each (start, end) row, clipped and inclusive."""
    unit = {"month": "MONTH", "quarter": "QUARTER", "year": "YEAR"}[kind]
    months = {"month": 1, "quarter": 3, "year": 12}[kind]
    first = F.trunc("start", unit)
    step = F.make_ym_interval(F.lit(0), F.lit(months))
    cursor = spans.where("end >= start").withColumn("cursor", F.explode(F.sequence(first, F.col("end"), step)))
    year = F.date_format("cursor", "yyyy")
    name = {"month": F.date_format("cursor", "yyyy-MM"), "quarter": F.concat(year, F.lit("-Q"), F.quarter("cursor").cast("string")), "year": year}[kind]
    return cursor.select(name.alias("window_id"), F.greatest("cursor", "start").alias("sd"),
                         F.least(F.date_sub(F.add_months("cursor", months), 1), F.col("end")).alias("ed"))


def window_state(events: DataFrame) -> DataFrame:
    """Latest state per window."""
    return events.groupBy("window_id").agg(F.max_by(F.struct("status", "attempts"), F.col("event_id")).alias("s")).select("window_id", "s.status", "s.attempts")


def status_summary(state: DataFrame) -> DataFrame:
    """Windows per status; every status has a row."""
    row = state.agg(*[F.count_if(F.col("status") == s).alias(s) for s in fixed.WINDOW_STATES])
    return row.select(F.inline(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in fixed.WINDOW_STATES])))


def windows_to_process(wanted: DataFrame, state: DataFrame, max_retries: int) -> DataFrame:
    """Windows to run now: unknown and pending always, crashed or failed below the retry cap."""
    joined = wanted.select("window_id").distinct().join(state, "window_id", "left")
    run = X.first_rule([
        (F.col("status").isNull(), F.lit(True)), (F.col("status").isin("completed", "exhausted"), F.lit(False)),
        ((F.col("attempts") >= max_retries) & (F.col("status") != "pending"), F.lit(False))], F.lit(True))
    return joined.where(run).select("window_id", "status", "attempts")


def fill_act_ids(refs: DataFrame, acts: DataFrame) -> DataFrame:
    """Exact-id resolution of open references; a reference with a resolved twin stays open."""
    table = acts.groupBy("identifier").agg(F.min("act_id").alias("act_id"))
    key = ["case_id", "raw_scheme", "raw_resource", "sub", "role", "source_dataset"]
    rows = refs.withColumn("sub", F.coalesce("raw_subdivision", F.lit("")))
    twins = rows.where("legislation_id IS NOT NULL OR provision_id IS NOT NULL").select(*key).distinct().withColumn("__twin", F.lit(True))
    joined = rows.join(table, F.col("raw_resource") == F.col("identifier"), "left").join(twins, key, "left")
    fill = F.when(F.col("legislation_id").isNull() & F.col("__twin").isNull(), F.col("act_id"))
    return joined.select("ref_id", F.coalesce("legislation_id", fill).alias("legislation_id"), (F.col("legislation_id").isNull() & fill.isNotNull()).alias("filled"))
