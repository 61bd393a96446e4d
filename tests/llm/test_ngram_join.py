"""The Jaccard join against all pairs, with regions small enough that every branch of the recursion runs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ironsift.llm import ngram_join
from ironsift.llm.ngram_join import shingle_sets, set_ids, similar_documents, window_size
from ironsift.llm.shared import Kept, shared_dir
from tests.llm.test_operators import WORD


def brute(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def corpus():
    """Chains of near copies, a passage that many documents share, and documents that mostly consist of it."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(8):
        text = [word() for _ in range(80)]
        for _ in range(rng.randrange(2, 9)):
            text = list(text)
            for _ in range(rng.randrange(1, 4)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
    rows += [" ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)]) for _ in range(25)]
    rows += [" ".join(passage[k % 3 :] + [word() for _ in range(rng.randrange(3, 16))]) for k in range(40)]
    rows += [rows[3], rows[3].upper(), rows[-1], "", None, "one two", "one two", " ".join(passage)]
    out = list(enumerate(rows))
    return out + [(4, rows[40]), (None, rows[3])]


@pytest.mark.parametrize("few", [1, 4, 32])
def test_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join, "TEXTS", 3)
    rows = corpus()
    if few != 32:
        rows = [r for r in rows if r[0] != 4]  # one id for two texts is for the last case
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS node", "1 AS region", "2 AS label").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(docs, few=few)[0].collect()), key=repr)
    want = brute(rows)
    if few == 32:  # rows that share an id are one document
        assert {r[2] for r in got if r[0] == 4} == {min(r[2] for r in want if r[0] in (4, 40))}
        assert len(got) == len(want)
    else:
        assert got == want


def test_links_come_from_voronoi_regions(spark, monkeypatch):
    """Copies of one text with a tenth of the words changed, too far from one another for one pivot: links are found through pivots and windows."""
    found, whole = [], ngram_join._Join.by_distance
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join._Join, "by_distance", lambda *x: found.append(whole(*x)) or found[-1])
    rng = random.Random(8)
    base = [f"b{k}" for k in range(120)]
    groups = [[w if rng.random() > 0.02 else f"g{g}x{k}" for k, w in enumerate(base)] for g in range(6)]
    rows = [(len(groups) * c + g, " ".join(w if rng.random() > 0.012 else f"c{c}y{g}z{k}" for k, w in enumerate(text))) for c in range(7) for g, text in enumerate(groups)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(docs, few=2)[0].collect()), key=repr)
    assert got == brute(rows)
    assert sum(x.count() for links, _ in found for x in links) > 0


def test_far_copies_meet_no_near_ones(spark, monkeypatch):
    """Near copies of one text, others with just too many words changed for a link, and parts of it that open the regions of both: pairs of the
    first two kinds aren't made, however wide the window of the triangle inequality."""
    made, whole = [], ngram_join._Join.plausible
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join._Join, "plausible", lambda self, pairs, *x, **y: made.append(pairs.distinct().count()) or whole(self, pairs, *x, **y))
    rng = random.Random(3)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for i, (n, length) in enumerate([(0, 200)] + [(1, 200)] * 60 + [(5, 200)] * 60 + [(1, 130)] * 3):
        at = set(range(15, length, 30)[:n]) if n > 1 else set(rng.sample(range(length), n))
        rows.append((i, " ".join(f"d{i}w{k}" if k in at else w for k, w in enumerate(base[:length]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(docs, few=2)[0].collect()), key=repr)
    assert got == brute(rows)
    assert len({r[2] for r in got}) > 30
    assert sum(made) < 15 * len(rows)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_steps_of_size_lose_no_pair(spark, percent, monkeypatch):
    monkeypatch.setattr(ngram_join, "PERCENT", percent)
    rng = random.Random(7)
    sizes = [*range(1, 40), *(rng.randrange(40, 3000) for _ in range(120))]
    rows = [(1, k, n, rng.randrange(0, 1 + n // 5), k) for k, n in enumerate(sizes)] + [(1, 1000 + n, n, 0, 1000 + n) for n in (4, 5, 8, 10, 64, 80, 100, 125)]
    x = spark.createDataFrame(rows, "region long, node long, size int, place int, component long")
    plain = ngram_join._apart(x, x, ngram_join._places()).distinct().collect()
    stepped = ngram_join._apart(ngram_join._of_size(x), ngram_join._by_partner(x), ngram_join._places(), on=["region", "step"])
    assert sorted(plain) == sorted(stepped.distinct().collect())
    assert plain


def test_sets_and_windows():
    texts = pa.array(["a b c d e f", "A b c d e f", "a b", "", "b c d e f a b c d e f"])
    data, offs = np.frombuffer(b"".join(x.as_py().encode() for x in texts), np.uint8), np.cumsum([0, *(len(x.as_py()) for x in texts)])
    _, h, n = shingle_sets(data, offs)
    assert n.tolist() == [2, 2, 1, 0, 6]
    ids = set_ids(h, n)
    assert ids[0] == ids[1] and len(set(ids.tolist())) == 4
    assert window_size(np.array([1, 4, 5, 10, 100])).tolist() == [1, 1, 2, 3, 21]


def test_kept_tables_leave_nothing_behind(spark):
    tables = Kept(spark)
    one = tables.keep(spark.range(100), "one")
    two = tables.keep(one.filter("id < 5"), "two")
    tables.drop(one)
    assert two.count() == 5
    assert shared_dir(spark) in tables.folder
