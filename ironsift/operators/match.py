"""Matching items with catalogs and profiles, and the additive rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ironsift.operators.dedup import rank_order
from ironsift.operators.dims import local_table, small
from ironsift.operators.patterns import find_patterns

def symbol_dim(spark: SparkSession, rows: list[tuple[str, str, str | None]]) -> DataFrame:
    """symbol_lower, category, severity of a catalog (a list in the program); the later entry wins, severity defaults to medium."""
    last = {s.lower(): (s.lower(), c, v or "medium") for s, c, v in rows}
    return local_table(spark, last.values(), "symbol_lower string, category string, severity string")


def profile_dims(spark: SparkSession, docs: dict[str, dict]) -> dict[str, DataFrame]:
    """Long tables of hunt profiles by scope name: symbols by role, patterns by kind, weights by term."""
    symbols = [(s, r, x) for s, d in docs.items() for r in ("must_have_one", "weight_each", "taint_sink") for x in d.get(r, [])]
    patterns = [(s, k, x) for s, d in docs.items() for k in ("device_name", "ioctl", "string") for x in d.get(k, [])]
    weights = [(s, t, int(w)) for s, d in docs.items() for t, w in d.get("weights", {}).items()]
    return {
        "symbols": local_table(spark, symbols, "scope string, role string, symbol string"),
        "patterns": local_table(spark, patterns, "scope string, kind string, pattern string"),
        "weights": local_table(spark, weights, "scope string, term string, weight long"),
    }


def _known(imports: DataFrame, dim: DataFrame) -> DataFrame:
    """item, symbol, category and severity of catalogued imports, as often as they occur: the catalog filters before anything is shuffled."""
    return imports.select("item", "symbol").join(small(dim), F.lower("symbol") == F.col("symbol_lower")).drop("symbol_lower")


def match_symbols(imports: DataFrame, dim: DataFrame) -> DataFrame:
    """item, symbol, category and severity of catalogued imports, in the item's casing, each symbol once."""
    return _known(imports, dim).distinct()


def _hits(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The number of distinct values of a group; there are no more than the profiles have."""
    return df.groupBy(*by).agg(F.size(F.collect_set(value)).cast("long").alias("hits"))


def match_profiles(symbols: DataFrame, profile_symbol: DataFrame) -> DataFrame:
    """item, scope, role and hits: distinct symbols in a profile's list, casing respected."""
    return _hits(symbols.select("item", "symbol").join(small(profile_symbol), "symbol"), ["item", "scope", "role"], "symbol")


def match_patterns(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """item, scope and hits: patterns that find any name of the item."""
    return _hits(find_patterns(names.select("item", "name"), patterns.select("scope", "pattern")), ["item", "scope"], "pattern")


#: The weight that counts for each role of a symbol.
_TERM = {"must_have_one": "must_have_one", "weight_each": "dangerous_imports"}


def _term(role: Column) -> Column:
    return F.when(role == "must_have_one", _TERM["must_have_one"]).when(role == "weight_each", _TERM["weight_each"])


def rank(by_role: DataFrame, by_pattern: DataFrame, weights: DataFrame) -> DataFrame:
    """item, scope, rank and qualifies of every item that hits anything of a profile."""
    terms = by_role.select("item", "scope", _term(F.col("role")).alias("term"), "hits").filter("term IS NOT NULL").unionByName(by_pattern.select("item", "scope", F.lit("device_match").alias("term"), "hits"))
    scored = terms.join(small(weights), ["scope", "term"], "left")
    must = F.col("term") == "must_have_one"
    return scored.groupBy("item", "scope").agg(F.sum(F.col("hits") * F.coalesce("weight", F.lit(0))).alias("rank"), F.coalesce(F.max(must & (F.col("hits") > 0)), F.lit(False)).alias("qualifies"))


def rank_items(imports: DataFrame, names: DataFrame, dim: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The same ranks from imports (item, symbol), names (item, name), the catalog and the profiles, with one shuffle: what is hit is
    gathered by item and scope once, as sets that are no larger than the profiles."""
    symbols = _known(imports, dim).select("item", "symbol").join(small(dims["symbols"]), "symbol")
    hit = lambda term, value: F.struct(term.alias("term"), F.col(value).alias("value")).alias("hit")
    by_symbol = symbols.select("item", "scope", hit(_term(F.col("role")), "symbol")).filter("hit.term IS NOT NULL")
    devices = find_patterns(names.select("item", "name"), dims["patterns"].filter("kind = 'device_name'").select("scope", "pattern"))
    gathered = by_symbol.unionByName(devices.select("item", "scope", hit(F.lit("device_match"), "pattern"))).groupBy("item", "scope").agg(F.collect_set("hit").alias("hits"))
    table = small(dims["weights"].groupBy("scope").agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("weights")))
    weight = lambda h: F.coalesce(F.element_at("weights", h["term"]), F.lit(0).cast("long"))
    total = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + weight(h))
    must = F.exists("hits", lambda h: h["term"] == "must_have_one")
    return gathered.join(table, "scope", "left").select("item", "scope", total.alias("rank"), must.alias("qualifies"))


def scope_matches(ranks: DataFrame) -> DataFrame:
    """item and its qualifying scopes, by falling rank and then name."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("minus"), "scope")))
    return ranks.filter("qualifies").groupBy("item").agg(F.transform(ordered, lambda x: F.struct(x["scope"].alias("scope"), (-x["minus"]).alias("rank"))).alias("matches"))


def verdict(items: DataFrame, matches: DataFrame, clones: DataFrame | None = None) -> DataFrame:
    """item, qualifies, best_scope and best_rank; an item with a clone qualifies without a scope too."""
    out = items.join(matches, "item", "left")
    best = F.get("matches", F.lit(0))
    cloned = F.lit(False)
    if clones is not None:
        out = out.join(clones.select("item", F.lit(True).alias("cloned")).distinct(), "item", "left")
        cloned = F.coalesce("cloned", F.lit(False))
    return out.select("item", ((F.coalesce(F.size("matches"), F.lit(0)) > 0) | cloned).alias("qualifies"), best["scope"].alias("best_scope"), F.coalesce(best["rank"], F.lit(0)).alias("best_rank"))


def shortlist(matches: DataFrame, scope: str, min_rank: int = 1) -> DataFrame:
    """item, rank and place where the scope's first entry reaches the least rank, by falling rank and then by item."""
    own = F.get(F.filter("matches", lambda x: x["scope"] == scope), F.lit(0))
    return rank_order(matches.select("item", own["rank"].alias("rank")).filter(F.col("rank") >= min_rank))


def match_categories(terms: DataFrame, cats: DataFrame) -> DataFrame:
    """term and category pairs that are equal or contain each other (the categories are few)."""
    t, c = F.lower("term"), F.lower("category")
    return terms.join(small(cats), F.contains(t, c) | F.contains(c, t))


def elect_classes(imports: DataFrame, rules: DataFrame) -> DataFrame:
    """item and class: a rule fires when all its conditions do, a condition on any of its values; generic else."""
    sized = rules.join(rules.groupBy("class", "rule").agg(F.count_distinct("cond").alias("n_conds")), ["class", "rule"])
    met = F.struct("class", "rule", "n_conds", "cond")
    hits = imports.select("item", "symbol").join(small(sized), F.col("symbol") == F.col("value"), "left").groupBy("item").agg(F.collect_set(F.when(F.col("value").isNotNull(), met)).alias("met"))
    complete = F.filter("met", lambda m: F.size(F.filter("met", lambda o: (o["class"] == m["class"]) & (o["rule"] == m["rule"]))) == m["n_conds"])
    classes = F.array_distinct(F.transform(complete, lambda m: m["class"]))
    return hits.select("item", F.explode(F.when(F.size(classes) > 0, classes).otherwise(F.array(F.lit("generic")))).alias("class"))


def scan_strings(texts: DataFrame, strings: list[tuple[str, str, str]]) -> DataFrame:
    """item and sorted distinct category:pattern hits; modes are substring, regex and whole, casing ignored."""
    low = F.lower("text")
    test = {"substring": lambda p: F.contains(low, F.lit(p.lower())), "regex": lambda p: F.col("text").rlike("(?i)" + p), "whole": lambda p: low == p.lower()}
    hits = F.array_compact(F.array(*(F.when(test[mode](p), F.lit(f"{c}:{p}")) for c, p, mode in strings)))
    return texts.select("item", F.array_sort(F.array_distinct(hits)).alias("hits")).filter(F.size("hits") > 0)


def fingerprint(items: DataFrame, catalog: list[str], profiles: dict[str, dict]) -> DataFrame:
    """scope_matches of rows with an array of symbols and one of names, without a shuffle: the same in batch and stream."""
    known = F.array(*(F.lit(x.lower()) for x in catalog))
    items = items.withColumn("known", F.array_distinct(F.filter("symbols", lambda s: F.array_contains(known, F.lower(s)))))
    scored = []
    for scope, p in profiles.items():
        w = p.get("weights", {})
        part = lambda xs: F.size(F.array_intersect("known", F.array(*map(F.lit, xs)))).cast("long") if xs else F.lit(0)
        device = sum(_found(q) for q in p.get("device_name", [])) if p.get("device_name") else F.lit(0)
        must = part(p.get("must_have_one", []))
        total = must * w.get("must_have_one", 0) + part(p.get("weight_each", [])) * w.get("dangerous_imports", 0) + device * w.get("device_match", 0)
        scored.append(F.when(must > 0, F.struct((-total).cast("long").alias("minus"), F.lit(scope).alias("scope"))))
    ordered = F.array_sort(F.array_compact(F.array(*scored)))
    return items.withColumn("matches", F.transform(ordered, lambda x: F.struct(x["scope"].alias("scope"), (-x["minus"]).alias("rank")))).drop("known")


def _found(pattern: str):  # noqa: ANN202
    return F.exists("names", lambda n: n.rlike(pattern)).cast("long")
