"""Mass triage, backfill and work-list resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ironsift.operators.dedup import latest_per_key, rank_order
from ironsift.operators.worklist import restrict, skip_done


def triage_status(candidates: DataFrame, index: DataFrame) -> DataFrame:
    done = index.select("item", "scope", F.lit(True).alias("done")).distinct()
    status = F.when(F.coalesce("done", F.lit(False)), "already_analyzed_deep").otherwise("needs_deep_rerun")
    return candidates.join(done, ["item", "scope"], "left").withColumn("status", status).drop("done")


def triage(ranks: DataFrame, symbols: DataFrame, index: DataFrame, scope: str, wanted: list[str], clones: DataFrame | None = None) -> DataFrame:
    """Candidates of a scope, with a wanted symbol, or with a clone (item): rank, the symbols hit, and whether they were studied."""
    own = ranks.filter((F.col("scope") == scope) & F.col("qualifies")).select("item", "rank")
    hit = symbols.filter(F.col("symbol").isin(*wanted)).groupBy("item").agg(F.array_sort(F.collect_set("symbol")).alias("symbols_hit"))
    both = own.join(hit, "item", "full_outer")
    if clones is not None:
        both = both.join(clones.select("item").distinct(), "item", "full_outer")
    both = both.select("item", F.lit(scope).alias("scope"), F.coalesce("rank", F.lit(0)).alias("rank"), F.coalesce("symbols_hit", F.array().cast("array<string>")).alias("symbols_hit"))
    return triage_status(both, index)


_SCOPES, _CLONES = "array<struct<scope: string, rank: long>>", "array<struct<ref_id: string, cve: string, similarity: double>>"


def mass_triage(fingerprints: DataFrame, index: DataFrame, scope: str, symbols: list[str]) -> DataFrame:
    """The candidates of a question over the raw tables, ranked: item, scope, rank, scope_hits, symbols_hit, clone_hits, status, run_id, bundle_path
    and place.

    fingerprints: item, detected_at, seq, scope_matches, dangerous_imports and clone_hits; index: item, scope, generated_at, seq, run_id and
    bundle_path. Both are append-only: the latest row of an item, and of an item and scope, counts. A candidate has a match of the scope, one of the symbols, or a
    clone; its rank is that of the scope's first match, or 0. It is already_analyzed_deep where the index has the scope, with the run to open, and
    needs_deep_rerun where it has none, with the latest run of another scope if there is one. Null arrays count as empty.
    """
    latest = latest_per_key(fingerprints, ["item"], "detected_at", "seq")
    hits = F.filter(F.coalesce(F.col("scope_matches"), F.array().cast(_SCOPES)), lambda m: m["scope"] == scope)
    wanted = F.array(*map(F.lit, symbols)).cast("array<string>")
    hit = F.array_sort(F.array_intersect(F.coalesce("dangerous_imports", F.array().cast("array<string>")), wanted))
    clones = F.coalesce(F.col("clone_hits"), F.array().cast(_CLONES))
    found = latest.select("item", hits.alias("scope_hits"), hit.alias("symbols_hit"), clones.alias("clone_hits"))
    found = found.filter((F.size("scope_hits") > 0) | (F.size("symbols_hit") > 0) | (F.size("clone_hits") > 0))
    runs = latest_per_key(index, ["item", "scope"], "generated_at", "seq")
    own = F.col("scope") == scope
    told = F.struct(own.alias("own"), "generated_at", "seq", "run_id", "bundle_path")
    best = runs.groupBy("item").agg(F.max(told).alias("run"))  # the scope's own run before any other
    out = found.join(best, "item", "left").select(
        "item",
        F.lit(scope).alias("scope"),
        F.coalesce(F.get("scope_hits", F.lit(0))["rank"], F.lit(0).cast("long")).alias("rank"),
        "scope_hits",
        "symbols_hit",
        "clone_hits",
        F.when(F.coalesce("run.own", F.lit(False)), "already_analyzed_deep").otherwise("needs_deep_rerun").alias("status"),
        "run.run_id",
        "run.bundle_path",
    )
    return rank_order(out)


def scan_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: rows scanned, and what is left with one row for each key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows_scanned"), F.count(key).alias("rows_after_dedup"))


def near_misses(ranks: DataFrame, candidates: DataFrame, related: list[str]) -> DataFrame:
    return ranks.filter(F.col("scope").isin(*related) & F.col("qualifies")).join(candidates, "item", "left_anti")


def stale_rows(df: DataFrame, version: str) -> DataFrame:
    return df.filter(F.coalesce(F.col("catalog_version") != version, F.lit(True)))


def recompute(df: DataFrame, existing: DataFrame, rebuild: bool, key: str = "item") -> DataFrame:
    return df if rebuild else skip_done(df, existing, key)


def work_list(items: DataFrame, key: str, keys: DataFrame | None = None, short: DataFrame | None = None, done: DataFrame | None = None) -> DataFrame:
    for t in (keys, short):
        items = restrict(items, t, key) if t is not None else items
    return skip_done(items, done, key) if done is not None else items


def work_list_counts(items: DataFrame, key: str, keys: DataFrame | None = None, short: DataFrame | None = None, done: DataFrame | None = None) -> DataFrame:
    """step, n_before and n_after of every filter of a work list, in order, from one pass over the items."""
    steps = [(name, t) for name, t in (("keys", keys), ("shortlist", short), ("done", done)) if t is not None]
    for name, t in steps:
        items = items.join(t.select(key, F.lit(True).alias(f"_{name}")).distinct(), key, "left")
    passed, counts = F.lit(True), []
    for name, _ in steps:
        hit = F.coalesce(F.col(f"_{name}"), F.lit(False))
        before, passed = passed, passed & (~hit if name == "done" else hit)
        counts.append(F.struct(F.lit(name).alias("step"), F.count_if(before).alias("n_before"), F.count_if(passed).alias("n_after")))
    return items.agg(F.array(*counts).alias("s")).select(F.inline("s"))


def counted_work_list(items: DataFrame, key: str, observation: Observation, keys: DataFrame | None = None, short: DataFrame | None = None, done: DataFrame | None = None) -> DataFrame:
    """The work list, whose counts come with the pass that writes it: observation.get has total and, for each filter, how many passed it and
    all before (keys, shortlist, done)."""
    passed, metrics = F.lit(True), [F.count(F.lit(1)).alias("total")]
    columns = items.columns
    for name, t in (("keys", keys), ("shortlist", short), ("done", done)):
        if t is not None:
            items = items.join(t.select(key, F.lit(True).alias(f"_{name}")).distinct(), key, "left")
            hit = F.coalesce(F.col(f"_{name}"), F.lit(False))
            passed = passed & (~hit if name == "done" else hit)
            metrics.append(F.count_if(passed).alias(name))
    return items.withColumn("_passed", passed).observe(observation, *metrics).filter("_passed").select(*columns)


def resolve_scopes(terms: DataFrame, profiles: DataFrame) -> DataFrame:
    """term, queries, categories, label and source of each term.

    profiles: file, stem, name, short_name, search (queries, categories) and classes, as `read_scopes` gives them. A term names the first profile
    by file whose stem, name or short name it is, exactly; a profile without a search block is searched by its classes and its name. Any other
    term is its own query. Terms are trimmed; a null term is dropped.
    """
    search = F.coalesce(F.col("search.queries").isNotNull() | F.col("search.categories").isNotNull(), F.lit(False))
    named = F.nullif("name", F.lit(""))
    none = F.array().cast("array<string>")
    derived = F.array_compact(F.concat(F.coalesce("classes", none), F.array(F.replace(named, F.lit("-"), F.lit(" ")))))
    queries = F.when(search, F.coalesce("search.queries", none)).otherwise(derived)
    told = F.struct(
        F.when(F.size(queries) > 0, queries).alias("queries"),
        F.when(search, F.coalesce("search.categories", none)).otherwise(none).alias("categories"),
        F.coalesce(named, "stem").alias("label"),
    )
    aliases = profiles.select("file", told.alias("told"), F.explode(F.array_distinct(F.array_compact(F.array("stem", "name", "short_name")))).alias("alias"))
    first = aliases.groupBy("alias").agg(F.min_by("told", "file").alias("told"))
    own = terms.select(F.trim("term").alias("term")).filter("term IS NOT NULL")
    known = own.join(first, F.col("term") == F.col("alias"), "left")
    hit = F.col("told").isNotNull()
    return known.select(
        "term",
        F.when(hit, F.col("told.queries")).otherwise(F.array("term")).alias("queries"),
        F.when(hit, F.col("told.categories")).otherwise(none).alias("categories"),
        F.when(hit, F.col("told.label")).otherwise(F.col("term")).alias("label"),
        F.when(hit, "profile").otherwise("adhoc").alias("source"),
    )


def attribute(items: DataFrame, manifests: DataFrame) -> DataFrame:
    """Provenance of each item: the highest manifest path, and in it the first record."""
    best = manifests.groupBy("item").agg(F.max_by(F.struct("path", "source"), F.struct("path", -F.col("pos"))).alias("m"))
    return items.join(best, "item", "left").select("item", F.col("m.path").alias("path"), F.col("m.source").alias("source"))
