"""Periodic runs against a search of all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ironsift.llm import periodic_runs
from ironsift.llm.periodic_runs import agree_ahead, agree_behind, compress, find_runs, runs_of
from ironsift.llm.registry import QUERIES
from tests.conftest import DATA

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def brute(w, times=3, least=24):
    n, out = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                out.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def text(pick, n, k):
    w = []
    while len(w) < n:
        r = pick.random()
        if r < 0.4:
            w += [pick.randrange(k) for _ in range(pick.randint(1, 20))]
        else:
            w += ([pick.randrange(k) for _ in range(pick.randint(1, 12))] * pick.randint(2, 12))[: pick.randint(4, 120)]
        if r > 0.9:
            w = w * pick.randint(2, 4)
    return w[:n]


def numbered(texts):
    return np.array([x for w in texts for x in w], np.int64), np.concatenate(([0], np.cumsum([len(w) for w in texts])))


@pytest.mark.parametrize(("times", "least", "chunk"), [(3, 24, 1 << 18), (3, 24, 5), (2, 2, 50), (2, 5, 1 << 18), (3, 3, 1), (4, 10, 100)])
def test_random_texts(monkeypatch, times, least, chunk):
    monkeypatch.setattr(periodic_runs, "CHUNK", chunk)
    monkeypatch.setattr(periodic_runs, "TOGETHER", 10 * chunk)
    pick = random.Random(times * least + chunk)
    for _ in range(25):
        texts = [text(pick, pick.randint(0, 200), pick.choice([1, 2, 3, 50])) for _ in range(5)] + [[], [7]]
        got = [[] for _ in texts]
        for t, *run in zip(*(x.tolist() for x in runs_of(*numbered(texts), times, least)), strict=True):
            got[t].append(tuple(run))
        assert got == [brute(w, times, least) for w in texts]


def test_grammar_queries():
    pick = random.Random(9)
    texts = [text(pick, 150, 3), [], [1] * 200, text(pick, 90, 2)]
    grammar = compress(*numbered(texts))
    for k, w in enumerate(texts):
        if not w:
            continue
        pairs = sorted((pick.randrange(len(w)), pick.randrange(len(w))) for _ in range(200))
        pairs = [(min(x), max(x)) for x in pairs if x[0] != x[1]]
        a, b = (np.array(x) + grammar.base[k] for x in zip(*pairs, strict=True))
        ahead = [next((n for n in range(len(w)) if j + n >= len(w) or w[i + n] != w[j + n]), 0) for i, j in pairs]
        behind = [next((n for n in range(len(w) + 1) if n > i or w[i - n] != w[j - n]), 0) for i, j in pairs]
        assert agree_ahead(grammar, a, b).tolist() == ahead
        assert agree_behind(grammar, a, b).tolist() == behind


def test_grammar_is_small_for_one_repeated_word():
    grammar = compress(np.zeros(100_000, np.int64), np.array([0, 100_000]))
    assert len(grammar.symbol) < 100_010


def test_odd_rows(spark):
    rows = [(1, "x " + "a b c " * 9 + "y", 1), (None, " a" * 30, 2), (1, "a b", 3), (2, None, 4), (3, "", 5), (4, " \n", 6), (5, "ä\tä\n" * 15 + "z z", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(docs).collect()), key=repr)
    assert got == sorted([(0, 30, [(0, 30, 1)], "a"), (1, 2, [], "a b"), (1, 29, [(1, 27, 3)], "x a b c y"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 32, [(0, 30, 1)], "ä z z")], key=repr)
    assert find_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        find_runs(docs, times=1)


def expected(doc_id, body):
    words = WORD.findall(body or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)]
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digest)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, DATA).collect()}
    assert got.keys() == texts.keys()
    short = [i for i in texts if len(texts[i] or "") < 15_000]
    assert len(short) > 150
    assert {i: got[i] for i in short} == {i: expected(i, texts[i]) for i in short}
    assert sum(got[i][0] > 0 for i in short) > 10
