"""Hints and rows derived from engine reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ironsift.functions.columns import gaps, present_checks, source_text
from ironsift.operators.dims import small
from ironsift.sources.shared import new_folder

_NONE = "array<string>"


def classified(ioctls: DataFrame, dim: DataFrame) -> DataFrame:
    """Requests (item, pos, method, api_calls and more) with sinks: name, category and severity of their catalogued calls in order."""
    calls = ioctls.select("item", "pos", F.posexplode("api_calls").alias("at", "name"))
    known = calls.join(small(dim), F.lower("name") == F.col("symbol_lower"))
    sinks = F.array_sort(F.collect_list(F.struct("at", "name", "category", "severity")))
    known = known.groupBy("item", "pos").agg(F.transform(sinks, lambda s: F.struct(s["name"].alias("name"), s["category"].alias("category"), s["severity"].alias("severity"))).alias("sinks"))
    none = F.array().cast("array<struct<name: string, category: string, severity: string>>")
    return ioctls.join(known, ["item", "pos"], "left").withColumn("sinks", F.coalesce("sinks", none))


def sink_hints(ioctls: DataFrame, dim: DataFrame) -> DataFrame:
    """Requests with sinks, risk factors, primitives or bug classes: where their input comes from, the sinks and their categories."""
    out = classified(ioctls, dim)
    for c in ("risk_factors", "primitives", "bug_classes"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.array().cast(_NONE)) if c in out.columns else F.array().cast(_NONE))
    out = out.filter((F.size("sinks") > 0) | (F.size("risk_factors") > 0) | (F.size("primitives") > 0) | (F.size("bug_classes") > 0))
    return out.withColumns({"source": source_text(F.col("method")), "sink_categories": F.array_sort(F.array_distinct(F.col("sinks.category")))})


# How findings of the engine are titled.
IMPORT_TITLE, HIDDEN_TITLE = "Dangerous import:", "hidden function"


def unresolved_hints(findings: DataFrame, ioctls: DataFrame, dim: DataFrame) -> DataFrame:
    """For items without any ioctl: item, pos, sink, category and severity of each catalogued import finding, and the item's candidates (addr and
    purpose of its hidden functions, in order). findings: item, pos, title, function, finding_severity, location, purpose; the name stands in the
    title where function is null or empty."""
    rest = findings.join(ioctls.select("item").distinct(), "item", "left_anti")
    place = F.struct("pos", F.struct(F.col("location").alias("addr"), "purpose").alias("c"))
    hidden = rest.filter(F.startswith(F.lower("title"), F.lit(HIDDEN_TITLE))).groupBy("item").agg(F.array_sort(F.collect_list(place))["c"].alias("candidates"))
    name = F.coalesce(F.nullif("function", F.lit("")), F.trim(F.substring("title", len(IMPORT_TITLE) + 1, 1 << 20)))
    named = rest.filter(F.startswith("title", F.lit(IMPORT_TITLE))).withColumn("sink", name).join(small(dim), F.lower("sink") == F.col("symbol_lower"))
    severity = F.coalesce(F.nullif("finding_severity", F.lit("")), F.col("severity"))
    none = F.array().cast("array<struct<addr: string, purpose: string>>")
    return named.join(hidden, "item", "left").select("item", "pos", "sink", "category", severity.alias("severity"), F.coalesce("candidates", none).alias("candidates"))


def gap_rows(ioctls: DataFrame) -> DataFrame:
    """Classified requests that miss checks they ought to make: missing, and reason (what is missing on the way to which sinks)."""
    missing = gaps(present_checks(F.col("security_checks")), F.col("method"), F.size("sinks") > 0)
    out = ioctls.withColumn("missing", missing).filter(F.size("missing") > 0)
    names = F.array_join("missing", ", ")
    reaches = F.concat(F.coalesce(F.nullif("method", F.lit("")), F.lit("handler")), F.lit(" reaches "), F.array_join(F.col("sinks.name"), ", "), F.lit(" without "), names)
    return out.withColumn("reason", F.when(F.size("sinks") > 0, reaches).otherwise(F.concat("method", F.lit(" takes raw user pointers without "), names)))


def hint_counts(items: DataFrame, **tables: DataFrame) -> DataFrame:
    """item and the number of rows that each table has of it."""
    for name, t in tables.items():
        items = items.join(t.groupBy("item").agg(F.count("*").alias(name)), "item", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return items


def dangerous_from_findings(df: DataFrame) -> DataFrame:
    """item and the sorted distinct symbols of its findings titled "Dangerous import: X"."""
    name = F.nullif(F.trim(F.regexp_extract("title", r"^Dangerous import:\s*(.*)$", 1)), F.lit(""))
    return df.select("item", name.alias("symbol")).filter("symbol IS NOT NULL").groupBy("item").agg(F.array_sort(F.collect_set("symbol")).alias("symbols"))


def index_rows(identity: DataFrame, run: dict[str, str], signals: DataFrame) -> DataFrame:
    """Nested index rows: identity, run, signals and pointers."""
    out = identity.join(signals, "item", "left")
    bundle = F.format_string("%s/%s/%s", F.lit("bundles"), F.col("item").cast("string"), F.lit(run["run_id"]))
    return out.select(
        F.struct(*identity.columns).alias("identity"),
        F.struct(*(F.lit(v).alias(k) for k, v in run.items()), bundle.alias("bundle_path")).alias("run"),
        F.struct(*(c for c in signals.columns if c != "item")).alias("signals"),
    )


def one_liners(df: DataFrame) -> DataFrame:
    """One line for each candidate of a scope (item, scope, rank), 300 characters at most."""
    return df.withColumn("one_liner", F.left(F.format_string("%s: rank %d in %s", F.col("item").cast("string"), "rank", "scope"), F.lit(300)))


def item_summaries(items: DataFrame) -> DataFrame:
    """item and a summary text: its scopes with ranks (matches), its catalogued symbols, and (none) where it has none."""
    listed = lambda c: F.coalesce(F.nullif(F.array_join(c, "\n"), F.lit("")), F.lit("_(none)_"))
    scopes = F.transform("matches", lambda m: F.format_string("- %s: %d", m["scope"], m["rank"]))
    symbols = F.transform("symbols", lambda s: F.concat(F.lit("- "), s))
    return items.select("item", F.concat(F.lit("# "), F.col("item").cast("string"), F.lit("\n\n## Scopes\n"), listed(scopes), F.lit("\n\n## Symbols\n"), listed(symbols)).alias("summary"))


# Names of the selectors that promote functions.
BY_IOCTL, BY_CALL = "handlers_dispatched_from_matching_ioctl", "functions_calling_any_of_must_have_one"


def select_functions(handlers: DataFrame, patterns: list[str], must_have: list[str]) -> DataFrame:
    """item, fn and selector of functions that a profile asks for: handlers whose code fits a pattern of the profile, and
    functions that call a symbol that it must have. handlers: item, fn, code, symbol (called, one row each)."""
    coded = handlers.filter(F.exists(F.array(*map(F.lit, patterns)), lambda p: F.regexp_like("code", p))) if patterns else handlers.limit(0)
    called = handlers.filter(F.col("symbol").isin(*must_have))
    pick = lambda df, name: df.select("item", "fn").distinct().withColumn("selector", F.lit(name))
    return pick(coded, BY_IOCTL).unionByName(pick(called, BY_CALL))


def promote_functions(functions: DataFrame, calls: DataFrame, seeds: DataFrame, depth: int | None = None) -> DataFrame:
    """Functions that reach a seed function, in at most depth calls if that is given.

    Each round takes one step from what the last one reached first and goes on with the calls of functions that aren't reached yet, which
    are written for the next round; so cycles end, no round is computed twice, and a round costs no more than the calls that are left.
    Without a depth, a call of a function that has a single call left goes on to what that one calls, so a chain halves in each round.
    The last round is the one that reaches nothing new.
    """
    spark, folder = functions.sparkSession, new_folder(functions.sparkSession, "reached")
    kinds = "item " + dict(seeds.dtypes)["item"] + ", fn " + dict(seeds.dtypes)["fn"]
    rounds, left = f"{folder}/rounds", f"{folder}/left"
    seeds.select("item", "fn").distinct().write.parquet(f"{rounds}/0")
    front = spark.read.schema(kinds).parquet(f"{rounds}/0")
    edges = calls.select("item", F.col("caller").alias("fn"), "callee").filter("item IS NOT NULL AND fn IS NOT NULL AND callee IS NOT NULL AND fn <> callee")
    edges.distinct().join(front, ["item", "fn"], "left_anti").write.parquet(f"{left}/0")
    k = 0
    while depth is None or k < depth:
        edges = spark.read.parquet(f"{left}/{k}")
        edges.join(front.withColumnRenamed("fn", "callee"), ["item", "callee"], "left_semi").select("item", "fn").distinct().write.parquet(f"{rounds}/{k + 1}")
        k += 1
        front = spark.read.schema(kinds).parquet(f"{rounds}/{k}")
        if front.isEmpty():
            break
        rest = edges.join(front, ["item", "fn"], "left_anti")
        (rest if depth is not None else _shortened(rest)).write.parquet(f"{left}/{k}")
    reached = spark.read.schema(kinds).parquet(*(f"{rounds}/{i}" for i in range(k + 1)))
    return functions.join(reached, ["item", "fn"], "left_semi")


def _shortened(edges: DataFrame) -> DataFrame:
    """Calls (item, fn, callee) among functions that aren't reached yet: where the callee has a single call, what it calls takes its place. As the
    callee reaches a seed just where that does, nothing changes for the caller; what ends at the caller itself is left out."""
    single = edges.groupBy("item", F.col("fn").alias("callee")).agg(F.min("callee").alias("next"), F.count("*").alias("n")).filter("n = 1").drop("n")
    onward = edges.join(single, ["item", "callee"], "left").select("item", "fn", F.coalesce("next", "callee").alias("callee"))
    return onward.filter("fn <> callee").distinct()
