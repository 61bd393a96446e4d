"""Data-quality rules over rows: each broken rule is a row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """kind: required, const, enum, pattern, minimum, maximum, min_length, max_length, min_items, max_items, unique, utc."""

    path: str
    kind: str
    arg: object = None
    severity: str = "error"


def broken(rule: Rule) -> Column:
    c, a = F.col(rule.path), rule.arg
    test = {
        "required": lambda: c.isNull(),
        "const": lambda: c != F.lit(a),
        "enum": lambda: ~c.isin(*a),
        "pattern": lambda: ~c.rlike(a),
        "minimum": lambda: c < F.lit(a),
        "maximum": lambda: c > F.lit(a),
        "min_length": lambda: F.char_length(c) < a,
        "max_length": lambda: F.char_length(c) > a,
        "min_items": lambda: F.size(c) < a,
        "max_items": lambda: F.size(c) > a,
        "unique": lambda: F.size(F.array_distinct(c)) < F.size(c),
        "utc": lambda: ~c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"),
    }[rule.kind]()
    return F.coalesce(test, F.lit(False))


def violations(df: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """key, path, rule, value and severity of every broken rule."""
    entries = [F.when(broken(r), F.struct(F.lit(r.path).alias("path"), F.lit(r.kind).alias("rule"), F.col(r.path).cast("string").alias("value"), F.lit(r.severity).alias("severity"))) for r in rules]
    return df.select(F.col(key).alias("key"), F.explode(F.array_compact(F.array(*entries))).alias("v")).select("key", "v.*")


# The weights that every profile has.
WEIGHTS = ("must_have_one", "dangerous_imports", "ioctl_match", "device_match", "string_match", "method_match", "clone_hit")


def weight_rules() -> list[Rule]:
    """All weights are there, and none is negative."""
    return [Rule(w, kind, arg) for w in WEIGHTS for kind, arg in (("required", None), ("minimum", 0))]


def name_mismatches(df: DataFrame, path: str, name: str) -> DataFrame:
    """Profiles whose name isn't the stem of their file: path, name, stem, with severity warn."""
    stem = F.regexp_extract(F.col(path), r"([^/\\\\]*?)(\.[^./\\\\]*)?$", 1)
    return df.select(F.col(path).alias("path"), F.col(name).alias("name"), stem.alias("stem"), F.lit("warn").alias("severity")).filter("name <> '' AND name <> stem")


def unknown_columns(df: DataFrame, allowed: list[str]) -> list[str]:
    return sorted(set(df.columns) - set(allowed))


def quality_summary(v: DataFrame) -> DataFrame:
    return v.groupBy("path", "rule").agg(F.count("*").alias("n"), (F.count_if(F.col("severity") == "error") == 0).alias("passed"))


def catalog_problems(doc: dict, top_key: str) -> list[str]:
    return [k for k in ("version", top_key) if k not in doc]


def rank_regressions(first: DataFrame, deep: DataFrame) -> DataFrame:
    """Where a deep rank is under the first one."""
    return first.join(deep.withColumnRenamed("rank", "deep_rank"), ["item", "scope"]).filter("deep_rank < rank")
