"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METHODS = ("METHOD_BUFFERED", "METHOD_IN_DIRECT", "METHOD_OUT_DIRECT", "METHOD_NEITHER")


def value_counts(df: DataFrame, key: str, col: str, values: tuple[str, ...] = METHODS) -> DataFrame:
    """key and one count for each listed value, zero where none; others are ignored."""
    return df.groupBy(key).agg(*(F.count_if(F.col(col) == v).alias(v.lower()) for v in values))


def distinct_categories(df: DataFrame, key: str, col: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_set(col)).alias("categories"))


def run_counters(df: DataFrame, col: str, values: tuple[str, ...]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *(F.count_if(F.col(col) == v).alias(f"n_{v}") for v in values))


def corpus_totals(df: DataFrame, source: str, is_new: str) -> DataFrame:
    """Baseline and new rows of every source; the row with a null source is the whole."""
    return df.rollup(source).agg(F.count_if(~F.col(is_new)).alias("baseline"), F.count_if(is_new).alias("new"), F.count("*").alias("total"))


def backfill_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: items in all, with any match, and changed, between two tables of items (item, matches)."""
    both = after.select("item", F.coalesce("matches", F.array().cast(after.schema["matches"].dataType)).alias("now"))
    both = both.join(before.select("item", F.col("matches").alias("then")), "item", "left").withColumn("then", F.coalesce("then", F.array().cast(after.schema["matches"].dataType)))
    return both.agg(F.count("*").alias("total"), F.count_if(F.size("now") > 0).alias("with_any_match"), F.count_if(F.col("now") != F.col("then")).alias("changed"))


def rank_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """scope and newly added matches between two rank tables (item, scope), most first."""
    return after.join(before, ["item", "scope"], "left_anti").groupBy("scope").agg(F.count("*").alias("added")).orderBy(F.desc("added"), "scope")


PREFIX = "IRP_MJ_"  # fixed value: what the names of dispatch slots begin with


def merge_names(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """keys and name: the distinct slot names of a handler in order. A single one stays as it is; several are joined by +
    without their prefix, after one prefix."""
    ordered = F.array_distinct(F.array_sort(F.collect_list(F.struct(*order, name)))[name])
    short = F.transform(ordered, lambda x: F.regexp_replace(x, f"^{PREFIX}", ""))
    joined = F.when(F.size(ordered) == 1, F.get(ordered, F.lit(0))).otherwise(F.concat(F.lit(PREFIX), F.array_join(short, "+")))
    return df.groupBy(*keys).agg(joined.alias("name"))


def signed_yield(df: DataFrame, source: str, accepted: str) -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("recovered"), F.count_if(accepted).alias("signed"))


def unique_counts(df: DataFrame, source: str, key: str) -> DataFrame:
    """Distinct keys by source, and over all (null source). Keys are deduplicated before they are counted."""
    pairs = df.select(source, key).distinct()
    return pairs.groupBy(source).agg(F.count("*").alias("n_unique")).unionByName(pairs.select(key).distinct().agg(F.count("*").alias("n_unique")).select(F.lit(None).cast("string").alias(source), "n_unique"))


def run_status(n_items: str, error: str | None = None):  # noqa: ANN201
    failed = F.col(error).isNotNull() if error else F.lit(False)
    return F.when(failed, "failed").when(F.coalesce(n_items, F.lit(0)) > 0, "success").otherwise("no_driver_extracted")


def entropy(df: DataFrame, key: str, text: str) -> DataFrame:
    """Shannon entropy (bits) of the characters of each text, from counts by character."""
    chars = df.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit("(?s)."), F.lit(0))).alias("c")).groupBy(key, "c").agg(F.count("*").alias("n"))
    return chars.groupBy(key).agg((F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("entropy"))


def top_handler(df: DataFrame, key: str, handler: str, by: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(handler, F.struct(by, handler)).alias("handler"))
