"""Functions that reach a seed, by brute force and over long chains."""

import glob
import random

import pytest

from ironsift.operators import reports


def _reaching(calls, seeds, depth=None):
    found, k = set(seeds), 0
    while depth is None or k < depth:
        new = {(i, a) for i, a, b in calls if (i, b) in found} - found
        if not new:
            break
        found, k = found | new, k + 1
    return found


def _run(spark, fns, calls, seeds, depth=None):
    kind = "item long, fn long"
    out = reports.promote_functions(spark.createDataFrame(fns, kind), spark.createDataFrame(calls, "item long, caller long, callee long"), spark.createDataFrame(seeds, kind), depth)
    return {(r.item, r.fn) for r in out.collect()}


@pytest.mark.parametrize("depth", [None, 0, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_by_brute_force(spark, depth, seed):
    draw = random.Random(seed)
    fns = [(i, n) for i in range(4) for n in range(40)]
    calls = [(i, draw.randrange(40), draw.randrange(44)) for i in range(4) for _ in range(12 + 16 * i)] + [(0, 1, None), (1, 3, 3)]
    seeds = [(0, 5), (1, 7), (2, 9), (3, 41), (3, 1)]
    assert _run(spark, fns, calls, seeds, depth) == _reaching(calls, seeds, depth) & set(fns)


def test_chains_and_rings_end_in_few_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "new_folder", lambda s, name: f"{tmp_path}/{name}")
    fns = [(i, n) for i in range(3) for n in range(200)]
    calls = [(i, n, (n + 1) % 200) for i, n in fns if (i, n) != (2, 50)]
    got = _run(spark, fns, calls, [(0, 0), (2, 120)])
    assert got == _reaching(calls, [(0, 0), (2, 120)])
    assert len(glob.glob(f"{tmp_path}/reached/rounds/*")) <= 11
