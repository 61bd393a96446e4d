"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ironsift.llm.shared import Kept, hinted


def _step(links: DataFrame, large: bool, tables: Kept, n: int) -> DataFrame:
    """Every node hands its least neighbour to its larger (large) or smaller (small) neighbours. n: the number of links.

    The least neighbour is a grouped minimum, kept as a table and joined back to the links: a node with very many links
    is aggregated before the shuffle, and as nothing stands between the shuffles and the join, Spark may split it; a small table of minima is
    broadcast.
    """
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = tables.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least", 2 * n)
    out = both.join(hinted(least, 2 * n), "u")
    if large:
        out = out.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return row[0], row[1]


def components(links: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """node and root (the least node it is connected with) of every node with a link to another one. rows: the number of links at most, if
    known."""
    tables = Kept(links.sparkSession)
    links = tables.keep(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links", rows)
    state = _state(links)
    while state[0]:
        middle = tables.keep(_step(links, True, tables, state[0]), "links", 2 * state[0])
        now = _state(middle)
        if now == state and middle.groupBy("u").count().filter("count > 1").isEmpty():  # every node is linked to its root alone
            break
        after = tables.keep(_step(middle, False, tables, now[0]), "links", 2 * now[0])
        tables.drop(links, middle)
        links, state = after, _state(after)
    root = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.union(root.select("root", "root").distinct())
