"""Points in ranges, gaps to the next row, streaks and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STEP, TOP = 3, 60  # blocks hold 2^level numbers, for levels 0, 3, ... 60
KEYS, SPREAD = 4096, 256  # a level of few blocks has its blocks in as many parts as make KEYS of them, SPREAD at most
KEY = ["level", "node", "part"]


def dyadic_keys(lo: str, hi: str) -> Column:
    """The whole blocks of 2^level numbers, at the place node * 2^level, that make up the half-open range [lo, hi) together: at most
    14 of each level, so a range of any length has no more than 5 log2 of its length. Empty where the range is or a bound is null."""
    first, end = F.col(lo).cast("long"), F.col(hi).cast("long")
    none = F.array().cast("array<struct<level: int, node: long>>")
    blocks = F.flatten(F.array(*(_at(first, end, level) for level in range(0, TOP + 1, STEP))))
    return F.when(first < end, blocks).otherwise(none)


def _at(lo: Column, hi: Column, level: int) -> Column:
    """The blocks of one level that are in no larger block of the range."""
    first, end = _up(lo, level), _shifted(hi, level)
    left, right = end, end
    if level < TOP:
        outer, last = _up(lo, level + STEP), _shifted(hi, level + STEP)
        left, right = (F.when(outer < last, x * (1 << STEP)).otherwise(end) for x in (outer, last))
    nodes = F.concat(_run(first, left), _run(right, end))
    return F.transform(nodes, lambda node: F.struct(F.lit(level).alias("level"), node.alias("node")))


def _run(first: Column, end: Column) -> Column:
    return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<long>"))


def _shifted(x: Column, level: int) -> Column:
    return F.call_function("shiftright", x, F.lit(level))


def _up(x: Column, level: int) -> Column:
    """The first block that begins at x or after it."""
    return _shifted(x, level) + F.when(x.bitwiseAND((1 << level) - 1) != 0, 1).otherwise(0)


def _blocks(ranges: DataFrame, lo: str, hi: str) -> tuple[DataFrame, dict[int, int]]:
    """A row for each part of each block of each range, and the levels that occur (21 at most) with their number of parts. Levels of few
    blocks, which may hold most of the points each, are dealt out in parts."""
    blocks = ranges.withColumn("_key", F.explode(dyadic_keys(lo, hi))).select("*", "_key.*").drop("_key")
    parts = {level: min(SPREAD, max(1, KEYS // n)) for level, n in blocks.groupBy("level").count().collect()}
    of = F.coalesce(*(F.when(F.col("level") == k, n) for k, n in parts.items()), F.lit(1))
    return blocks.withColumn("part", F.explode(F.sequence(F.lit(0), of - 1))), parts


def _placed(points: DataFrame, x: str, parts: dict[int, int]) -> DataFrame:
    """A row for each point and level, with the block that holds it and its part."""
    at = F.col(x).cast("long")
    key = [F.struct(F.lit(k).alias("level"), _shifted(at, k).alias("node"), F.pmod(F.xxhash64(at), F.lit(n)).cast("int").alias("part")) for k, n in parts.items()]
    return points.withColumn("_key", F.explode(F.array(*key))).select("*", "_key.*").drop("_key") if key else points.limit(0).withColumns({"level": F.lit(0), "node": F.lit(0).cast("long"), "part": F.lit(0)})


def assign_interval(points: DataFrame, ranges: DataFrame, x: str = "x", lo: str = "lo", hi: str = "hi", on: tuple[str, ...] = ()) -> DataFrame:
    """Each point with every half-open range [lo, hi) that holds it (and agrees in the columns `on`). Ranges are cut into dyadic blocks, of which
    one holds the point, so the join has equal keys whatever the ranges' lengths; overlapping ranges give a row each. Neither side is
    broadcast: Spark's estimate of the sizes leaves out that both are multiplied."""
    blocks, parts = _blocks(ranges, lo, hi)
    return _placed(points, x, parts).join(blocks.hint("merge"), [*on, *KEY]).drop(*KEY)


def in_any_interval(points: DataFrame, ranges: DataFrame, x: str = "x", lo: str = "lo", hi: str = "hi", on: tuple[str, ...] = ()) -> DataFrame:
    """The distinct points that any half-open range holds: a semi join."""
    blocks, parts = _blocks(ranges.select(*on, lo, hi), lo, hi)
    return _placed(points, x, parts).join(blocks.select(*on, *KEY).distinct().hint("merge"), [*on, *KEY], "left_semi").drop(*KEY).distinct()


def valid_targets(calls: DataFrame, addresses: DataFrame, known: DataFrame, sections: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """The distinct call targets (addr) that are an address, not known already, and inside a section [lo, hi), all of the same item if `on`
    names it."""
    keys = [*on, "addr"]
    found = calls.select(*keys).distinct().join(addresses, keys, "left_semi").join(known, keys, "left_anti")
    return in_any_interval(found, sections, "addr", on=on)


def unresolved_citations(cited: DataFrame, files: DataFrame) -> DataFrame:
    """Citations (doc, file, line) without such a file, or beyond its lines."""
    return cited.join(files, "file", "left").filter("n_lines IS NULL OR line > n_lines").drop("n_lines")


def orphans(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    return df.join(dim, on, "left_anti")


def span_to_next(df: DataFrame, item: str, section: str, addr: str, end: str) -> DataFrame:
    """Adds span: to the next row of the item if it is of the same section, else to the section's end."""
    w = Window.partitionBy(item).orderBy(addr)
    following, same = F.lead(addr).over(w), F.lead(section).over(w) == F.col(section)
    return df.withColumn("span", F.when(same, following - F.col(addr)).otherwise(F.col(end) - F.col(addr)))


def running_total(df: DataFrame, group: str, order: list[str], width: int) -> DataFrame:
    """Adds running: the place of each row in its group. The first column of the order is a number; rows are numbered within
    blocks of that width and offset by the blocks before, so that a large group is no single task."""
    df = df.withColumn("_block", F.floor(F.col(order[0]) / width))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(group, "_block").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy(group, "_block").orderBy(*order))
    return df.withColumn("_at", within).join(offsets, [group, "_block"]).withColumn("running", F.col("_before") + F.col("_at")).drop("_block", "_at", "_before")


def streaks(df: DataFrame, key: str, order: str, hit: str, reset: str, threshold: int) -> DataFrame:
    """Adds streak (hits since the last reset, on hits alone) and stopped (it has reached the threshold)."""
    w = Window.partitionBy(key).orderBy(order)
    df = df.withColumn("island", F.sum(F.when(F.col("status") == reset, 1).otherwise(0)).over(w))
    w = Window.partitionBy(key, "island").orderBy(order)
    streak = F.when(F.col("status") == hit, F.sum(F.when(F.col("status") == hit, 1).otherwise(0)).over(w)).otherwise(0)
    return df.withColumn("streak", streak).withColumn("stopped", F.col("streak") >= threshold).drop("island")


def first_line(df: DataFrame, group: str, order: list[str], within: str) -> DataFrame:
    """The 1-based place of the first row of each value of within, in the order of its group."""
    at = df.withColumn("line", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))
    return at.groupBy(group, within).agg(F.min("line").alias("first_line"))
