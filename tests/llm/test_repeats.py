"""Byte repeats do not depend on where a text stands in its batch or partition."""

import random

import numpy as np
import pytest

from ironsift.llm import repeats
from ironsift.llm.suffix_dedup import _anchors, _refined, dedup_bytes
from tests.conftest import DATA
from tests.llm.test_operators import brute_bytes

RNG = random.Random(11)
LETTERS = "abcdefgh "


def words(n):
    return "".join(RNG.choice(LETTERS) for _ in range(n))


def anchors(texts):
    return _anchors(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


@pytest.mark.parametrize("shift", [0, 1, 99, 65_500, 65_536, 70_001])
def test_anchors_are_of_the_text_alone(shift):
    text, before = words(140_000).encode(), words(shift).encode()
    alone, moved = anchors([text]), anchors([before, text, b"end"])
    own = moved.lo >= shift
    for x, y in ((moved.lo[own] - shift, alone.lo), (moved.hi[own] - shift, alone.hi), (moved.bucket[own], alone.bucket), (moved.context[own], alone.context)):
        assert x.tolist() == y.tolist()
    finer, same = _refined(moved, own), _refined(alone, np.ones(len(alone.lo), bool))
    assert (finer[0] - shift).tolist() == same[0].tolist() and finer[2].tolist() == same[2].tolist() and finer[3].tolist() == same[3].tolist()
    assert sum(finer[1] - finer[0]) == len(text) - 99


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("parts", [1, 4, 61])
def test_any_partitioning(spark, parts, adaptive):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    want = {i: x for i, *x in brute_bytes(sorted((r.doc_id, r.text, None) for r in table.collect()))}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = {r.doc_id: [r.n_bytes, r.n_removed, bytes(r.kept)] for r in dedup_bytes(table.repartition(parts)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == want


@pytest.mark.parametrize("together", [1, 64])
def test_one_bucket_with_many_contexts(spark, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    shared = words(64)
    texts = [f"{words(90)}{shared}{words(90)}" for _ in range(60)]
    texts += [x[k : k + 190] for k, x in enumerate(texts[:40])] + [words(70_000) + texts[0][10:150] + words(300)]
    rows = [(k, x, None) for k, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(5)
    got = [(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in dedup_bytes(docs).collect()]
    assert sorted(got) == sorted(brute_bytes(rows))
