"""The index of patterns against every pattern with every name, and the plans of what is built on it."""

import random

import pytest
from pyspark.sql import functions as F

from ironsift.operators import match, patterns
from ironsift.operators.dims import local_table
from ironsift.operators.patterns import find_patterns, required_literal
from ironsift.plans.queries import QUERIES
from tests.conftest import DATA


@pytest.mark.parametrize(("pattern", "literal"), [
    ("abc", "abc"), ("^Abc$", "abc"), ("ab.cde", "cde"), ("a|bcd", ""), ("x(abc|d)yz1", "yz1"), ("(abc)+d", "abc"), ("(abc)*d", "d"), ("ab?cde", "cde"), ("a{2}bcd", "bcd"), (r"\bword\b", "word"), ("(?i)ÄBC", ""), ("(?i)ABC", "abc"),
    ("[a-z]+", ""), ("[[a]b]", ""), (r"\p{L}abc", ""), ("a++b(", ""), (r"\Qa.b\E", ""), (r"a\.sys", "a.sys"), ("(?=abc)x", "x"), ("(?iu:é)xyz", ""), ("", ""),
])
def test_required_literals(pattern, literal):
    assert required_literal(pattern) == literal


@pytest.mark.parametrize("loose", [256, 3])
def test_same_as_all_pairs(spark, monkeypatch, loose):
    monkeypatch.setattr(patterns, "LOOSE", loose)
    pick = random.Random(loose)
    names = [(k, "".join(pick.choice("abAB.É1 ") for _ in range(pick.randrange(12)))) for k in range(200)] + [(900, None), (901, "")]
    parts = ["a", "b", "ab", "abA", "ba.", r"\.", "É", "[ab]", "a+", "b*", "(ab)?", "(?:a|b)", ".", "^", "$", "bab", "1"]
    texts = sorted({pick.choice(["", "(?i)"]) + "".join(pick.choice(parts) for _ in range(pick.randint(1, 5))) for _ in range(150)}) + ["^", "x{0}"]
    items = spark.createDataFrame(names, "item long, name string")
    known = local_table(spark, [(k % 7, x) for k, x in enumerate(texts)] + [(1, None)], "scope int, pattern string")
    expected = items.crossJoin(known).filter(F.regexp_like("name", F.col("pattern")))
    got = find_patterns(items, known)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert got.count() > 500


def test_empty_tables(spark):
    items, known = spark.createDataFrame([(1, "abc")], "item long, name string"), local_table(spark, [("s", "abc")], "scope string, pattern string")
    assert find_patterns(items.limit(0), known).collect() == [] and find_patterns(items, known.limit(0)).collect() == []
    assert match.match_patterns(items, known).collect() == [(1, "s", 1)]


def plan(spark, name):
    text = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    return {x: text.count(x) for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin", "Exchange hashpartitioning", "Scan parquet")}


@pytest.mark.parametrize("name", ["jn1_match_symbols", "jn2_match_profiles", "jn3_match_patterns", "jn3_many_patterns", "jn9_match_categories", "jn14_elect_classes", "agg1_rank", "agg3_verdict", "tri1_triage", "rpt1_sink_hints", "rpt2_unresolved_hints"])
def test_no_product(spark, name):
    assert plan(spark, name)["CartesianProduct"] == 0


# One shuffle of the items each; agg1 has another of the weights, jn14 two of the rules, which are a few rows.
@pytest.mark.parametrize(("name", "shuffles"), [("jn1_match_symbols", 1), ("jn2_match_profiles", 1), ("jn14_elect_classes", 3), ("agg1_rank", 2)])
def test_few_shuffles(spark, name, shuffles):
    found = plan(spark, name)
    assert found["SortMergeJoin"] == 0 and found["Exchange hashpartitioning"] == shuffles
