"""Filters that make and cut work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ironsift.functions.columns import extension, host

# Leading bytes (hex) of file types.
MAGIC = {"zip": "504B0304", "cab": "4D534346", "exe": "4D5A", "sys": "4D5A", "7z": "377ABCAF271C", "html": "3C21444F43"}
TERMINAL = ("ok", "no_sys", "bundle_only", "dns_dead", "discovered")


def filter_hosts(df: DataFrame, url_col: str, allowed: list[str]) -> DataFrame:
    """Rows whose host is an allowed one or below it."""
    h = host(F.col(url_col))
    return df.filter(F.exists(F.array(*map(F.lit, allowed)), lambda a: (h == a) | h.endswith(F.concat(F.lit("."), a))))


def same_site(df: DataFrame, url_col: str, site: str | Column) -> DataFrame:
    """Rows whose host is the site's, exactly; the site may be a column."""
    return df.filter(host(F.col(url_col)) == site)


def valid_magic(df: DataFrame, name_col: str, content_col: str, magic: dict[str, str] | None = None) -> DataFrame:
    """Rows whose first bytes fit their suffix; an unknown suffix passes."""
    known = F.create_map(*(F.lit(x) for pair in (magic or MAGIC).items() for x in pair))
    want = F.element_at(known, extension(F.col(name_col)))
    start = F.hex(F.substring(F.col(content_col).cast("binary"), 1, 8))
    return df.filter(want.isNull() | start.startswith(want))


def any_token(df: DataFrame, cols: list[str], tokens: list[str]) -> DataFrame:
    if not tokens:
        return df
    text = F.lower(F.concat_ws(" ", *cols))
    return df.filter(F.exists(F.array(*(F.lit(t.lower()) for t in tokens)), lambda t: F.contains(text, t)))


def name_rules(df: DataFrame, col: str, good: str | None = None, bad: str | None = None, junk: str | None = None) -> DataFrame:
    for pattern, keep in ((good, True), (bad, False), (junk, False)):
        if pattern:
            hit = F.col(col).rlike("(?i)" + pattern)
            df = df.filter(hit if keep else ~hit)
    return df


def size_cap(df: DataFrame, col: str, cap: int) -> DataFrame:
    return df.filter((F.col(col) == 0) | (F.col(col) <= cap))


def restrict(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def skip_done(df: DataFrame, done: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(done, on, "left_anti")


def resume(units: DataFrame, ledger: DataFrame, key: str, terminal: tuple[str, ...] = TERMINAL, refresh: bool = False) -> DataFrame:
    """Units without a terminal outcome in the ledger; all of them on refresh."""
    return units if refresh else skip_done(units, ledger.filter(F.col("status").isin(*terminal)), key)


def new_content(df: DataFrame, store: DataFrame, key: str) -> DataFrame:
    return skip_done(df, store, key)


def native_only(df: DataFrame) -> DataFrame:
    return df.filter((F.lower("suffix") == "sys") | (F.col("subsystem") == 1))


def stale_runs(df: DataFrame, current: object, cutoff: Column, run: str = "run_id", ts: str = "ts") -> DataFrame:
    return df.filter((F.col(run) != current) & (F.col(ts) <= cutoff))


def fresh_snapshot(df: DataFrame, min_bytes: float, now: Column, max_days: int = 7, size: str = "size", ts: str = "ts") -> DataFrame:
    return df.filter((F.col(size) > min_bytes) & (F.col(ts) > now - F.expr(f"INTERVAL {max_days} DAYS")))


def scope_partition(findings: DataFrame, names: DataFrame, symbols: list[str], patterns: list[str], strings: list[str]) -> DataFrame:
    """Adds in_scope: by function, by device name (for device findings), or by a string of the scope in the title or in the description
    (own casing)."""
    device = names.groupBy("item").agg(F.max(F.exists(F.array(*map(F.lit, patterns)), lambda p: F.regexp_like("name", p))).alias("device_hit"))
    by_device = F.coalesce("device_hit", F.lit(False)) & F.coalesce(F.col("title").rlike("Device|SDDL"), F.lit(False))
    has = lambda c, s: F.contains(F.coalesce(c, F.lit("")), s)
    by_string = F.exists(F.array(*map(F.lit, strings)), lambda s: has("title", s) | has("description", s)) if strings else F.lit(False)
    return findings.join(device, "item", "left").withColumn("in_scope", F.coalesce(F.col("function").isin(*symbols), F.lit(False)) | by_device | by_string).drop("device_hit")
