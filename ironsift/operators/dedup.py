"""Latest, first and smallest rows of a key; ordering, caps, interleaving and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ironsift.sources.shared import new_folder


def _first(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, seq: str) -> DataFrame:
    """The latest row of each key: a missing time counts as the earliest, ties go to the later row, rows without a key go."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    newest = F.max_by(F.struct(*df.columns), F.struct(F.coalesce(F.col(ts).cast("string"), F.lit("")), F.col(seq)))
    return df.groupBy(*keys).agg(newest.alias("_r")).select("_r.*")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def smallest_per_key(df: DataFrame, key: str, size: str, seq: str) -> DataFrame:
    return first_per_key(df, [key], [size, seq])


def distinct_in_order(array: Column) -> Column:
    return F.array_distinct(array)


def size_order(size: str) -> Column:
    """Small sizes first, unknown (0) last."""
    return F.when(F.col(size) == 0, F.lit((1 << 63) - 1)).otherwise(F.col(size))


def top_sorted(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows with their place; 0 means all."""
    if not n:
        return placed(df, *order)
    return df.orderBy(*order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))  # n rows


def cap_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return _first(df, [group], order, n)


def interleave(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Adds turn: the n-th rows of all groups come before the (n+1)-th of any."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))


def priority_order(df: DataFrame, col: str, priority: list[str]) -> DataFrame:
    """Adds priority: the place in the list, others after it."""
    at = F.array_position(F.array(*map(F.lit, priority)), F.col(col))
    return df.withColumn("priority", F.when(at == 0, F.lit(len(priority) + 1)).otherwise(at).cast("long"))


def shard(df: DataFrame, key: str, n: int, seed: int | None = None) -> DataFrame:
    """Adds shard: by a seeded hash of the key, so that no row waits for the others; a plain remainder without a seed."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary"))
    value = F.col(key) if seed is None else F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long")
    return df.withColumn("shard", F.pmod(value, F.lit(n)).cast("long"))


def preview(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return cap_per_group(df, group, order, n)


def placed(df: DataFrame, *order: Column) -> DataFrame:
    """Adds place, from 1, in the order of the whole table. Rows are dealt out by ranges and sorted once, into a table of their own; each part's
    places begin after the rows of the parts before it, so no task sees more than its part."""
    spark, folder = df.sparkSession, new_folder(df.sparkSession, "placed")
    at = F.monotonically_increasing_id()
    df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND((1 << 33) - 1).alias("_at")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    offsets = rows.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "_part").withColumn("place", F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def rank_order(df: DataFrame) -> DataFrame:
    """Adds place: by falling rank, then by item."""
    return placed(df, F.desc("rank"), F.asc("item"))


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
