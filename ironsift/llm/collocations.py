"""Phrases whose words occur together more often than apart, counted by HAT-tries.

Each task counts the phrases of its texts in a trie of word numbers, a batch of texts at a time. It begins as one container,
a table of phrases and counts in the order of their numbers. A container that grows too large bursts in two: between two first
words, and where all its phrases have the same first word, between two second words below that, and so on; so it always covers neighbouring
subtrees of one node. A task that holds too many entries spills its largest containers whole, each as a run in order.
Runs are dealt out by prefix (language and first word) and merged by summing; prefixes of very frequent words, at most 4096,
are dealt out by whole phrase, since one of them may have a large part of all runs.

Counting goes from short to long phrases, since no phrase is more frequent than its parts: first words, then pairs of
frequent words, then phrases of three and four words whose pairs are all frequent. What is frequent so far comes to the
tasks as a bit filter of two hashes with a fixed greatest size. It lets through some infrequent phrases, and more where there are
more phrases than it is made for, but never stops a frequent one; exact counts decide.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ironsift.llm.arrowtext import GOLD, LOWER, LOWER_IDS, U, mix, pieces, rows_of, text_buffers, tokens
from ironsift.llm.bit_filter import BitFilter, filter_of
from ironsift.llm.shared import Kept

MAX_BITS = 1 << 27
HOT_SHARE = 4096
BATCH = 1 << 16
TOGETHER = 1 << 22
GAP = pa.scalar(b" ", pa.large_binary())
NAMES = ["part", "lang", "phrase", "f"]
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
NO_LANG = "und"
Run = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Memory:
    """Bounds of a task's trie: entries of one container, entries of all, and numbered words."""

    container: int = 1 << 16
    entries: int = 2_000_000
    words: int = 500_000


def _merged(head: np.ndarray, tail: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases in order, each once, with the sum of its counts."""
    order = np.lexsort((tail, head)) if tail.any() else np.argsort(head, kind="stable")
    head, tail, n = head[order], tail[order], n[order]
    new = np.ones(len(head), bool)
    new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    at = np.flatnonzero(new)
    return head[at], tail[at], np.add.reduceat(n, at) if len(at) else n


class Container:
    """Phrases from one key up to the next container's first: the numbers of two words in head, of two more in tail (0 for
    none). What was added last waits until it is as much as the rest."""

    __slots__ = ("head", "n", "tail", "waiting")

    def __init__(self, head: np.ndarray, tail: np.ndarray, n: np.ndarray) -> None:
        self.head, self.tail, self.n = head, tail, n
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def held(self) -> int:
        return len(self.head) + sum(len(x[0]) for x in self.waiting)

    def add(self, head: np.ndarray, tail: np.ndarray, n: np.ndarray, most: int) -> bool:
        """Whether the container is too large now."""
        self.waiting.append((head, tail, n))
        if self.held() - len(self.head) >= max(len(self.head), most // 4):
            self.settle()
        return len(self.head) > most

    def settle(self) -> None:
        if self.waiting:
            parts = [(self.head, self.tail, self.n), *self.waiting]
            self.head, self.tail, self.n = _merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            self.waiting = []

    def burst(self) -> Container:
        """Takes out the upper part: the cut is between two first words if it can be, else one word further down."""
        words = (self.head >> U(32), self.head, self.tail >> U(32), self.tail)
        for key in words:
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            if len(cuts):
                break
        at = int(cuts[np.argmin(np.abs(cuts - len(self.head) // 2))])
        upper = Container(self.head[at:], self.tail[at:], self.n[at:])
        self.head, self.tail, self.n = self.head[:at], self.tail[:at], self.n[:at]
        return upper


class HatTrie:
    """Counts of phrases of word numbers, which begin at 1."""

    def __init__(self, memory: Memory) -> None:
        self.memory = memory
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, U)
        self.containers = [Container(none, none, np.zeros(0, np.int64))]
        self.firsts = [(0, 0)]  # the least phrase that each container may hold
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]
        self.hashes: list[np.ndarray] = [np.zeros(1, U)]

    def number(self, lang: str, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The numbers of distinct words of a language."""
        known = self.numbers.setdefault(lang, {})
        new = [k for k, x in enumerate(words) if x not in known]
        known.update(zip([words[k] for k in new], range(len(self.words), len(self.words) + len(new)), strict=True))
        self.words += [words[k] for k in new]
        self.langs += [lang] * len(new)
        self.hashes.append(hashes[new])
        return np.array([known[x] for x in words], np.int64)

    def add(self, head: np.ndarray, tail: np.ndarray) -> None:
        """Counts phrases, given as often as they occur."""
        head, tail, n = _merged(head, tail, np.ones(len(head), np.int64))
        lo = 0
        while lo < len(head):
            k = bisect_right(self.firsts, (int(head[lo]), int(tail[lo]))) - 1
            hi = len(head)
            if k + 1 < len(self.firsts):
                first, second = self.firsts[k + 1]
                a, b = np.searchsorted(head, [U(first)], "left")[0], np.searchsorted(head, [U(first)], "right")[0]
                hi = int(a + np.searchsorted(tail[a:b], U(second), "left"))
            own = self.containers[k]
            too_large = own.add(head[lo:hi], tail[lo:hi], n[lo:hi], self.memory.container)
            while too_large:
                upper = own.burst()
                self.containers.insert(k + 1, upper)
                self.firsts.insert(k + 1, (int(upper.head[0]), int(upper.tail[0])))
                own = max(own, upper, key=lambda x: len(x.head))
                k = self.containers.index(own)
                too_large = len(own.head) > self.memory.container
            lo = hi

    def full(self) -> bool:
        return sum(x.held() for x in self.containers) > self.memory.entries or len(self.words) > self.memory.words

    def spill(self) -> Iterator[Run]:
        """The largest containers, until half of the memory is free; all, where there are too many words."""
        if len(self.words) > self.memory.words:
            yield from self.all_runs()
            return
        left = sum(x.held() for x in self.containers)
        none = np.zeros(0, U)
        for own in sorted(self.containers, key=Container.held, reverse=True):
            if 2 * left <= self.memory.entries:
                return
            left -= own.held()
            own.settle()
            yield own.head, own.tail, own.n
            own.head, own.tail, own.n = none, none, none.astype(np.int64)

    def all_runs(self) -> Iterator[Run]:
        for own in self.containers:
            own.settle()
            yield own.head, own.tail, own.n
        self.clear()


def _salt(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


def _pairs(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the one after it; the last has none."""
    return mix(words[:-1] * GOLD + words[1:])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash for each phrase of one or two words."""
    for batch in batches:
        data, offs = text_buffers(batch.column("phrase"))
        words, start, _ = tokens(data, offs, BLANK, LOWER_IDS)
        _, first = rows_of(start, offs)
        langs = batch.column("lang").dictionary_encode()
        salts = np.array([_salt(x) for x in langs.dictionary.to_pylist()], U)[langs.indices.to_numpy()]
        words = mix(words ^ np.repeat(salts, np.diff(first)))
        two = np.diff(first) == 2
        out = words[first[:-1]]
        out[two] = mix(words[first[:-1][two]] * GOLD + words[first[:-1][two] + 1])
        yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["h"])


def bit_filter(phrases: DataFrame) -> BitFilter:
    """The filter of phrases of one word, or of two. Its size follows their number up to MAX_BITS (16 MB)."""
    size = min(MAX_BITS, 1 << max(15, (16 * phrases.count()).bit_length()))
    return filter_of(phrases.select("lang", "phrase").mapInArrow(_hashes, "h long"), size)


def _count(data: np.ndarray, offs: np.ndarray, langs: list[str], trie: HatTrie, lengths: tuple[int, ...], words_kept: BitFilter | None, pairs_kept: BitFilter | None) -> dict[str, int]:
    """Counts the phrases of some texts; returns the number of all words by language."""
    hashes, start, end = tokens(data, offs, BLANK | BREAK, LOWER_IDS)
    row, first = rows_of(start, offs)
    totals: dict[str, int] = {}
    for lang, n in zip(langs, np.diff(first).tolist(), strict=True):
        totals[lang] = totals.get(lang, 0) + n
    breaks = np.cumsum(BREAK[data], dtype=np.int32)[start] if len(start) else start
    same = (row[1:] == row[:-1]) & (breaks[1:] == breaks[:-1])  # whether the next word is of the same piece
    codes = {x: k for k, x in enumerate(totals)}
    code = np.array([codes[x] for x in langs], np.int64)[row]
    keyed = mix(hashes ^ np.array([_salt(x) for x in totals], U)[code])
    if words_kept is not None:
        ok = words_kept(keyed)
        same &= ok[1:] & ok[:-1]
    if pairs_kept is not None:
        at = np.flatnonzero(same)
        same[at] = pairs_kept(_pairs(keyed)[at])
    follow = np.zeros(len(start), np.int8)  # words that may follow
    for _ in range(max(lengths) - 1):
        follow[:-1] = np.where(same, np.minimum(follow[1:] + 1, max(lengths) - 1), 0)
    starts = {k: np.flatnonzero(follow >= k - 1) for k in lengths}
    used = np.zeros(len(start), bool)
    for k, at in starts.items():
        for j in range(k):
            used[at + j] = True
    numbers = _numbers(data, start, end, code, list(totals), keyed, np.flatnonzero(used), trie)
    heads, tails = [], []
    for k, at in starts.items():
        word = [numbers[at + j] if j < k else U(0) for j in range(4)]
        heads.append(word[0] << U(32) | word[1])
        tails.append(np.zeros(len(at), U) | word[2] << U(32) | word[3])
    trie.add(np.concatenate(heads), np.concatenate(tails))
    return totals


def _numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray, code: np.ndarray, langs: list[str], keyed: np.ndarray, used: np.ndarray, trie: HatTrie) -> np.ndarray:
    """The trie's numbers of the used words, by their exact lower-cased bytes and language; 0 for others."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start[used]] = 1
    inside[end[used]] -= 1
    ends = np.concatenate(([0], np.cumsum(end[used] - start[used])))
    packed = pa.Array.from_buffers(pa.large_binary(), len(used), [None, pa.py_buffer(ends), pa.py_buffer(LOWER[data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]])])
    coded = packed.dictionary_encode()
    words, which = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    keys, at, back = np.unique(code[used] * max(1, len(words)) + which, return_index=True, return_inverse=True)
    found = np.zeros(len(keys), np.int64)
    cuts = np.searchsorted(keys, np.arange(len(langs) + 1) * max(1, len(words)))
    for lang, a, b in zip(langs, cuts[:-1], cuts[1:], strict=True):
        if b > a:
            found[a:b] = trie.number(lang, words.take(pa.array(keys[a:b] % len(words))).to_pylist(), keyed[used[at[a:b]]])
    out = np.zeros(len(start), U)
    out[used] = found.astype(U)[back]
    return out


def _batches(trie: HatTrie, runs: Callable[[], Iterator[Run]], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs as rows. A phrase is dealt out by the hash of its first word, or of all words where the first is a hot one."""
    words, langs, hashes = pa.array(trie.words, pa.large_binary()), pa.array(trie.langs).dictionary_encode(), np.concatenate(trie.hashes)
    for head, tail, n in runs():
        for a in range(0, len(n), BATCH):
            parts = head[a : a + BATCH], tail[a : a + BATCH]
            number = [(x >> U(s) & U(0xFFFFFFFF)).astype(np.int64) for x in parts for s in (32, 0)]
            size = np.sum([x > 0 for x in number], 0)
            part = hashes[number[0]]
            whole = part
            for x in number[1:]:
                whole = np.where(x > 0, mix(whole * GOLD + hashes[x]), whole)
            part = np.where(np.isin(part, hot), whole, part)
            phrases = np.empty(len(part), object)
            for k in range(1, 5):
                own = np.flatnonzero(size == k)
                if len(own):
                    text = [words.take(pa.array(x[own])) for x in number[:k]]
                    phrases[own] = pc.binary_join_element_wise(*text, GAP).to_pylist()
            lang = langs.take(pa.array(number[0])).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), lang, pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n[a : a + BATCH])], NAMES)


def _counted(lengths: tuple[int, ...], words_kept: BitFilter | None, pairs_kept: BitFilter | None, hot: np.ndarray, memory: Memory) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, totals = HatTrie(memory), Counter()
        for batch in batches:
            data, offs = text_buffers(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for a, b in pieces(offs, TOGETHER):
                totals.update(_count(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], langs[a:b], trie, lengths, words_kept, pairs_kept))
                if trie.full():
                    yield from _batches(trie, trie.spill, hot)
        yield from _batches(trie, trie.all_runs, hot)
        if 1 in lengths:  # an empty phrase stands for all words of a language
            names = list(totals)
            yield pa.RecordBatch.from_arrays([pa.array([zlib.crc32(x.encode()) for x in names], pa.int64()), pa.array(names, pa.string()), pa.array([""] * len(names), pa.string()), pa.array([totals[x] for x in names], pa.int64())], NAMES)

    return run


def count_phrases(docs: DataFrame, lengths: tuple[int, ...], words_kept: BitFilter | None = None, pairs_kept: BitFilter | None = None, hot: np.ndarray | None = None, memory: Memory | None = None) -> DataFrame:
    """lang, phrase and f of the phrases of the given lengths whose words and pairs the filters let through. With length 1, the empty
    phrase stands for all words of a language."""
    counted = docs.select("lang", "text").mapInArrow(_counted(lengths, words_kept, pairs_kept, np.zeros(0, U) if hot is None else hot, memory or Memory()), "part long, lang string, phrase string, f long")
    return counted.repartition("part").groupBy("part", "lang", "phrase").agg(F.sum("f").alias("f")).drop("part")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def _scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut. frequent: lang, phrase, f and k (words) of all frequent phrases."""
    cuts = frequent.filter("k > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "k")
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - k)")})
    cuts = cuts.join(frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").alias("score")
    least = cuts.select("lang", "phrase", "a", score, "cut", "l", "r").groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("best"))
    return least.select("lang", "phrase", "best.*").join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang")


def _covered(frequent: DataFrame) -> DataFrame:
    """lang, phrase and the count of the most frequent longer candidate that holds the phrase."""
    words = F.split("phrase", " ")
    spans = F.expr("flatten(transform(sequence(2, k - 1), n -> transform(sequence(1, k - n + 1), i -> array_join(slice(w, i, n), ' '))))")
    inner = frequent.filter("k > 2").select("lang", "f", "k", words.alias("w")).select("lang", "f", F.explode(F.array_distinct(spans)).alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = 30, cover: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang", memory: Memory | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first `top` phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at punctuation and line ends, pieces into words at blanks. Candidates
    are phrases of two to four words that occur at least `least` times within pieces; l and r are the counts of the two
    parts at the cut with the lowest score, and a candidate goes where a longer one that holds it has at least `cover`
    percent of its count. A null language counts as und, null and empty texts have no words, repeated rows count each time, an
    empty table gives an empty result, and other columns are ignored. A text is counted in parts of any number; memory
    follows the longest text and the bounds in `memory`. n counts all words of the language.
    """
    tables = Kept(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    enough = F.col("f") >= least
    ones = tables.keep(count_phrases(docs, (1,), memory=memory).filter(enough | (F.col("phrase") == "")), "ones")
    totals = ones.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    words = ones.filter("phrase <> ''")
    n = totals.agg(F.sum("n")).first()[0] or 0
    often = words.filter(_wide("f") * HOT_SHARE >= n).select("lang", "phrase")  # HOT_SHARE at most
    hot = np.array([r.h for r in often.mapInArrow(_hashes, "h long").collect()], np.int64).view(U)
    words_kept = bit_filter(words)
    twos = tables.keep(count_phrases(docs, (2,), words_kept, None, hot, memory).filter(enough), "twos")
    pairs_kept = bit_filter(twos)
    more = tables.keep(count_phrases(docs, (3, 4), words_kept, pairs_kept, hot, memory).filter(enough), "more")
    k = F.size(F.split("phrase", " "))
    frequent = words.withColumn("k", F.lit(1)).unionByName(twos.withColumn("k", F.lit(2))).unionByName(more.withColumn("k", k))
    scored = _scored(frequent, totals).join(_covered(frequent), ["lang", "phrase"], "left")
    left = scored.filter(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * cover))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = left.withColumn("place", F.row_number().over(salted)).filter(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    out = tables.keep(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "ranked")
    tables.drop(ones, twos, more)
    for f in (words_kept, pairs_kept):
        f.bits.unpersist()
    return out
