"""Points in ranges, of any length and without a broadcast of either side."""

import random

import pytest

from ironsift.operators import ranges

WIDE = 1 << 62


def _tables(spark):
    draw = random.Random(3)
    spans = [(lo, lo + draw.choice([0, 1, 7, 8, 9, 63, 500, 5000])) for lo in (draw.randrange(-3000, 3000) for _ in range(120))]
    spans += [(-5, 4_000_000_000), (-WIDE, WIDE), (5, 5), (9, 2), (-8, 8), (64, 512), (-(1 << 63), -WIDE), (WIDE, (1 << 63) - 1)]
    xs = [draw.randrange(-3500, 3500) for _ in range(150)] + [-WIDE - 1, -WIDE, WIDE - 1, WIDE, 64, 511, 512, -1, 0]
    points, spans = list(enumerate(xs)), list(enumerate(spans))
    return points, spans, spark.createDataFrame(points, "p long, x long"), spark.createDataFrame([(k, lo, hi) for k, (lo, hi) in spans] + [(-1, None, 5)], "r long, lo long, hi long")


def test_assign_by_brute_force(spark):
    points, spans, p, r = _tables(spark)
    got = sorted((row.p, row.r) for row in ranges.assign_interval(p, r).collect())
    assert got == sorted((k, n) for k, x in points for n, (lo, hi) in spans if lo <= x < hi)
    assert sorted(row.p for row in ranges.in_any_interval(p, r.filter("r > 40 AND r < 100")).collect()) == sorted(k for k, x in points if any(lo <= x < hi for n, (lo, hi) in spans if 40 < n < 100))
    assert ranges.assign_interval(p, r.filter("hi <= lo")).collect() == []


def test_keys_agree(spark):
    p = spark.createDataFrame([("a", 5), ("b", 5), (None, 5)], "item string, x long")
    r = spark.createDataFrame([("a", 0, 10), ("b", 6, 10)], "item string, lo long, hi long")
    assert [(x.item, x.x) for x in ranges.assign_interval(p, r, on=("item",)).collect()] == [("a", 5)]


@pytest.mark.parametrize("join", [ranges.assign_interval, ranges.in_any_interval])
def test_no_side_goes_through_the_driver(spark, join):
    _, _, p, r = _tables(spark)
    out = join(p, r)
    out.collect()
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_few_long_blocks_are_dealt_out(spark):
    points = spark.range(20000).selectExpr("id + 1700000000 AS x")
    r = spark.createDataFrame([(-5, 4_000_000_000)], "lo long, hi long")
    blocks, parts = ranges._blocks(r, "lo", "hi")
    placed = ranges._placed(points, "x", parts).join(blocks, ranges.KEY).groupBy(*ranges.KEY).count().toPandas()
    assert placed["count"].sum() == 20000 and placed["count"].max() < 400
