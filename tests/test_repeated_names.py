"""Many rows with few names meet patterns by name."""

from ironsift.operators.dims import local_table
from ironsift.operators.patterns import find_patterns


def test_each_distinct_name_meets_a_pattern_once(spark):
    """2000 rows of 5 names: only the parts of 5 names are made for the index."""
    names = spark.range(2000).selectExpr("id AS item", "concat('part ', id % 5) AS name")
    texts = [f"part {k % 7}|zz{k}" for k in range(20)] + [f"(?i)PART {k}" for k in range(20)]
    known = local_table(spark, [(k % 3, x) for k, x in enumerate([*texts, texts[0]])], "scope int, pattern string")
    out = find_patterns(names, known)
    expected = names.crossJoin(known).filter("regexp_like(name, pattern)")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected.collect()))
    todo, most = [out._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "Generate":
            most.append(node.metrics().apply("numOutputRows").value())
        inner = node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan() if name.endswith("QueryStage") else None
        todo += [inner] if inner is not None else [node.children().apply(k) for k in range(node.children().size())]
    assert most and max(most) <= 5 * 4
