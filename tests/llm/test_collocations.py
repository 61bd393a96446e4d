"""Collocations against plain counts, with roomy and with tight tries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ironsift.llm import collocations as own
from ironsift.llm.arrowtext import U
from ironsift.llm.collocations import HatTrie, Memory, bit_filter, collocations
from ironsift.llm.registry import ORACLES, QUERIES
from tests.conftest import DATA
from tests.oracle import spark_rows, sql_rows

TIGHT = Memory(container=4, entries=40, words=12)


def brute(rows, least=30, cover=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        longer, found = Counter(), []
        for p, a in counts.items():
            if a >= least:
                for k in range(2, len(p)):
                    for i in range(len(p) - k + 1):
                        longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        for p, a in counts.items():
            if len(p) > 1 and a >= least and 100 * longer[p] < cover * a:
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows(seed, n):
    pick = random.Random(seed)
    words = ["a", "B", "É", "é", "the", "The", "x\x0by", "1", "a b", "new york city hall", "New  York", "\t", ".", "a, b", " ", "z�z"]
    return [(pick.choice(["en", "de", None]), " ".join(pick.choice(words) for _ in range(pick.randrange(40)))) for _ in range(n)]


@pytest.mark.parametrize(("least", "cover", "top", "memory"), [(30, 80, 2000, None), (3, 80, 2000, TIGHT), (2, 50, 5, TIGHT), (5, 101, 7, None)])
def test_random_texts(spark, least, cover, top, memory):
    data = [*rows(least, 150), ("en", None), ("en", ""), (None, "?!"), ("fr", "once")]
    docs = spark.createDataFrame(data, "lang string, text string").withColumns({"phrase": F.lit("clash"), "f": F.lit(1), "part": F.lit(2)}).repartition(5)
    got = sorted(tuple(r) for r in collocations(docs, least, cover, top, memory=memory).collect())
    assert got == brute(data, least, cover, top)
    assert got


def test_very_frequent_word_and_long_text(spark):
    data = [("en", "hot word " * 3000 + "x" * 300_000), *[("en", "hot word")] * 50, *[("en", "hot cup")] * 40]
    docs = spark.createDataFrame(data, "lang string, text string").repartition(4)
    assert sorted(tuple(r) for r in collocations(docs, memory=TIGHT).collect()) == brute(data)


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert collocations(spark.createDataFrame([(None, None), ("en", " ")], "lang string, text string")).collect() == []


def test_trie_bursts_and_spills():
    trie = HatTrie(Memory(container=20, entries=300, words=1000))
    pick, counts, merged = random.Random(2), Counter(), Counter()

    def collect(runs):
        for head, tail, n in runs:
            keys = list(zip(head.tolist(), tail.tolist(), strict=True))
            assert keys == sorted(set(keys))
            merged.update(dict(zip(keys, n.tolist(), strict=True)))

    for _ in range(40):
        phrases = [tuple(pick.randrange(1, 7) if j < size else 0 for j in range(4)) for size in (pick.randint(1, 4) for _ in range(100))]
        keys = [(a << 32 | b, c << 32 | d) for a, b, c, d in phrases]
        counts.update(keys)
        trie.add(*np.array(keys, U).T)
        assert trie.firsts == sorted(trie.firsts) and len(trie.firsts) == len(trie.containers)
        if trie.full():
            collect(trie.spill())
            assert sum(x.held() for x in trie.containers) <= 150
    assert len(trie.containers) > 5
    collect(trie.all_runs())
    assert merged == counts and len(trie.containers) == 1


def test_filter_stops_nothing_frequent(spark, monkeypatch):
    monkeypatch.setattr(own, "MAX_BITS", 1 << 15)
    phrases = spark.createDataFrame([("en", f"w{k}" if k % 2 else f"w{k} v{k % 7}") for k in range(3000)], "lang string, phrase string")
    kept = bit_filter(phrases)
    hashed = phrases.mapInArrow(own._hashes, "h long").collect()
    assert kept(np.array([r.h for r in hashed]).view(U)).all()
    assert kept(np.arange(1, 2000, dtype=U) * U(0x9E3779B97F4A7C15)).mean() < 0.5


def test_query(spark):
    got = spark_rows(QUERIES["op13_collocations"](spark, DATA))
    assert got == sql_rows(ORACLES["op13_collocations"], DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("lang", "text").collect()
    assert len(got[1]) == len(brute([tuple(r) for r in docs]))
