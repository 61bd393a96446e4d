"""Periodic runs of words, by recompression.

A run is a maximal stretch of words with a period (words that far apart are equal) that fills at least three periods.

* Candidates come from a harmonic grid: for every period q up to a third of the text, places a fixed step apart, the step
  growing with q, so that all periods together have about n log n of them. Every run with that period that is long
  enough holds a place of the grid whose next few words repeat q words later; places where they don't are dropped by
  comparison of words.
* Texts with candidates are compressed into a grammar by recompression: in each round equal neighbours form a block
  (symbol and length), then symbols are dealt into left and right ones by a hash and every left one followed by a right
  one becomes a pair. Blocks and pairs that are equal get one number, so equal numbers of a round stand for equal words.
* A candidate's exact extent comes from two queries on the grammar: how far the words at p and at p + q agree, forwards
  and backwards. A query climbs while both places start the same symbol, moves past equal symbols (a block by its
  length at once) and comes down where they differ. All queries of a chunk move together, in arrays.

Texts of a batch are compressed together, each within its own limits; no run crosses texts. Memory follows the longest
text, and candidates are handled a bounded number at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ironsift.llm.arrowtext import GOLD, SPACES, U, id_and_text, mix, pieces, ranges, rows_of, text_buffers, tokens

LOOK = 4
CHUNK = 1 << 18
TOGETHER = 1 << 20


@dataclass
class Grammar:
    """All rounds one after another; a node is one symbol's occurrence in one round. Each text of a round ends with a node
    of its own, whose symbol is negative and occurs nowhere else."""

    symbol: np.ndarray
    size: np.ndarray  # words
    parent: np.ndarray  # node of the next round, -1 in the last one
    child: np.ndarray  # first node of the round before, the node itself in round 0
    last: np.ndarray  # last node of the round before
    opens: np.ndarray  # whether the node is the first of its parent
    closes: np.ndarray  # whether it is the last
    ahead: np.ndarray  # equal symbols from here on, this one included
    behind: np.ndarray  # equal symbols up to here
    base: np.ndarray  # words before the texts, by which nodes of round 0 are numbered


def _numbered(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """A new symbol for each distinct key."""
    distinct, which = np.unique(keys, return_inverse=True)
    return fresh + which, fresh + len(distinct)


def _stretches(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start and the length of each maximal stretch of equal symbols."""
    start = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1])))
    return start, np.diff(np.append(start, len(symbol)))


def compress(words: np.ndarray, first: np.ndarray) -> Grammar:
    """The grammar of texts whose words are numbered from 0; first: where each text starts, with the end."""
    n_texts = len(first) - 1
    symbol = np.insert(words.astype(np.int64), first[1:], -1 - np.arange(n_texts))
    size = (symbol >= 0).astype(np.int64)
    fresh = int(words.max(initial=-1)) + 1
    rounds, offset, child_at, last_at = [], 0, np.arange(len(symbol)), np.arange(len(symbol))
    for k in range(10_000):
        n = len(symbol)
        start, length = _stretches(symbol)
        inside = np.arange(n) - np.repeat(start, length)
        behind = inside + 1
        ahead = np.repeat(length, length) - inside
        row = {"symbol": symbol, "size": size, "child": child_at, "last": last_at, "ahead": ahead, "behind": behind}
        rounds.append(row)
        if n <= 2 * n_texts and (length == 1).all():
            break
        block = symbol[start].copy()
        many = np.flatnonzero(length > 1)
        if len(many):
            block[many], fresh = _numbered(block[many] * (int(length.max()) + 1) + length[many], fresh)
        left = (mix(block.view(U) * GOLD + np.full(1, k + 1, U)) >> U(63)).astype(bool) & (block >= 0)
        head = np.flatnonzero(left[:-1] & ~left[1:] & (block[1:] >= 0))
        keep = np.ones(len(block), bool)
        keep[head + 1] = False
        if len(head):
            whole, fresh = _numbered(block[head] * fresh + block[head + 1], fresh)
            block[head] = whole
        open_at = start[keep]
        row["opens"] = np.zeros(n, bool)
        row["opens"][open_at] = True
        row["parent"] = offset + n + np.cumsum(row["opens"]) - 1
        row["closes"] = np.append(row["opens"][1:], True)
        child_at, last_at = offset + open_at, offset + np.append(open_at[1:], n) - 1
        symbol, size = block[keep], np.add.reduceat(size, open_at)
        offset += n
    rounds[-1] |= {"opens": np.zeros(len(symbol), bool), "closes": np.zeros(len(symbol), bool), "parent": np.full(len(symbol), -1)}
    return Grammar(*(np.concatenate([r[x] for r in rounds]) for x in ("symbol", "size", "parent", "child", "last", "opens", "closes", "ahead", "behind")), base=first[:-1] + np.arange(n_texts))


def agree_ahead(g: Grammar, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the nodes a and b of round 0 on are equal, pair by pair."""
    return _agree(g, a, b, g.opens, g.ahead, g.child, 1)


def agree_behind(g: Grammar, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words up to and with the nodes a and b of round 0 are equal. The first text has no node before it, so a
    place before a text is the end of the text before, or -1."""
    return _agree(g, a, b, g.closes, g.behind, g.last, -1)


def _agree(g: Grammar, a: np.ndarray, b: np.ndarray, edge: np.ndarray, equal: np.ndarray, down: np.ndarray, way: int) -> np.ndarray:
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero((a >= 0) & (b >= 0))
    a, b = a[live], b[live]
    while len(live):
        same = g.symbol[a] == g.symbol[b]
        up = same & edge[a] & edge[b]
        pa_, pb = g.parent[a], g.parent[b]
        up[up] = g.symbol[pa_[up]] == g.symbol[pb[up]]
        over = np.flatnonzero(same & ~up)
        step = np.minimum(equal[a[over]], equal[b[over]])
        out[live[over]] += step * g.size[a[over]]
        ended = ~same & (g.child[a] == a) & (g.child[b] == b)
        fall = np.flatnonzero(~same & ~ended)
        a, b = np.where(up, pa_, a), np.where(up, pb, b)
        a[fall], b[fall] = down[a[fall]], down[b[fall]]
        a[over] += way * step
        b[over] += way * step
        left = ~ended
        if way < 0:  # behind the first text's first symbol there is no node
            left &= (a >= 0) & (b >= 0)
        live, a, b = live[left], a[left], b[left]
    return out


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of every word; equal words have equal numbers."""
    inside = ~SPACES[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    rows = offs[:-1][offs[:-1] < offs[1:]]
    first[rows] = inside[rows]
    last[rows[1:] - 1] = inside[rows[1:] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    places = np.concatenate(([0], np.cumsum(end - start)))
    kind = pa.large_binary()
    packed = pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(places), pa.py_buffer(data[inside])])
    return start, end, packed.dictionary_encode().indices.to_numpy().astype(np.int64)


def _grid(count: np.ndarray, times: int, least: int, look: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place and period of the grid of texts with so many words, a bounded number at a time."""
    most = np.where(count >= least, count // times, 0)
    text = np.repeat(np.arange(len(count)), most)
    period = ranges(np.ones(len(most), np.int64), most + 1)
    step = np.maximum(least, times * period) - period - look + 1
    room = count[text] - period - look
    n = np.where(room >= 0, room // step + 1, 0)
    before = np.cumsum(n)
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(before, (before[lo - 1] if lo else 0) + CHUNK, "right")))
        k = n[lo:hi]
        yield np.repeat(text[lo:hi], k), ranges(np.zeros(len(k), np.int64), k) * np.repeat(step[lo:hi], k), np.repeat(period[lo:hi], k)
        lo = hi


def _candidates(words: np.ndarray, first: np.ndarray, times: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The places of the grid whose next words repeat a period later."""
    look = min(LOOK, *(max(least, times * q) - q for q in range(1, least + 1)))
    for text, place, period in _grid(np.diff(first), times, least, look):
        at = first[text] + place
        live = np.flatnonzero(words[at] == words[at + period])
        for k in range(1, look):
            live = live[words[at[live] + k] == words[at[live] + period[live] + k]]
        if len(live):
            yield text[live], place[live], period[live]


def runs_of(words: np.ndarray, first: np.ndarray, times: int = 3, least: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and least period of every run, by text, start and period. words: numbers of the words of all texts;
    first: where each text starts, with the end."""
    open_ = np.zeros(len(first) - 1, bool)
    for text, _, _ in _candidates(words, first, times, least):
        open_[text] = True
    found = [np.zeros((0, 4), np.int64)]
    kept = np.flatnonzero(open_)
    batches = np.searchsorted(np.cumsum(np.diff(first)[kept]), np.arange(TOGETHER, max(1, np.diff(first)[kept].sum()), TOGETHER))
    for part in np.split(kept, np.unique(batches)):
        if len(part):
            found.append(_exact(words, first, part, times, least))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def _exact(words: np.ndarray, first: np.ndarray, part: np.ndarray, times: int, least: int) -> np.ndarray:
    """The runs of some texts: candidates extended by queries on their grammar. One stretch has all multiples of its period;
    the least stays."""
    own = words[ranges(first[part], first[part + 1])]
    own_first = np.concatenate(([0], np.cumsum(np.diff(first)[part])))
    grammar = compress(own, own_first)
    out = np.zeros((0, 4), np.int64)
    for text, place, period in _candidates(own, own_first, times, least):
        a = grammar.base[text] + place
        ahead = agree_ahead(grammar, a, a + period)
        behind = agree_behind(grammar, a - 1, a + period - 1)
        length = ahead + behind + period
        long = length >= np.maximum(least, times * period)
        rows = np.stack((text, place - behind, length, period), 1)[long]
        rows = np.concatenate((out, rows))
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
        out = rows[new]
    return np.column_stack((part[out[:, 0]], out[:, 1:]))


def _collapsed(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The given words of each row joined by single blanks, and where each row's text ends."""
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    size = end - start + ~last
    wide = np.append(data, np.uint8(0x20))
    out = wide[ranges(start, start + size)]
    ends = np.cumsum(size)
    out[ends[~last] - 1] = 0x20
    per_row = np.bincount(row, size, n_rows).astype(np.int64)
    return out, np.concatenate(([0], np.cumsum(per_row)))


def _found(times: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, all_offs = text_buffers(batch.column("text"))
            for a, b in pieces(all_offs):
                data, offs = whole[all_offs[a] : all_offs[b]], all_offs[a : b + 1] - all_offs[a]
                start, end, words = _words(data, offs)
                row, first = rows_of(start, offs)
                text, at, length, period = runs_of(words, first, times, least)
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, first[text] + at + period, 1)
                np.add.at(gone, first[text] + at + length, -1)
                stay = np.cumsum(gone[:-1]) == 0
                left, cuts = _collapsed(data, start[stay], end[stay], row[stay], b - a)
                runs = pa.StructArray.from_arrays([pa.array(at), pa.array(length), pa.array(period)], ["start", "length", "period"])
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(b - a + 1)), pa.int32()), runs),
                    pa.Array.from_buffers(pa.string(), b - a, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(left)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, times: int = 3, least: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length and least period in words, by start, then period) and the text in which each run has
    one period left, its words joined by single blanks.

    A run is a maximal stretch with at least `least` words and `times` (two or more) periods. A null or empty text has no words, no runs and an
    empty collapsed text. Null and repeated ids are carried along row by row, an empty table gives an empty one, other
    columns are ignored. A text is one record whatever its length; n words make about n log n places of the grid.
    """
    if times < 2 or least < times:
        raise ValueError("a run has two periods or more, and a word in each")
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return id_and_text(docs, id_col, text_col).mapInArrow(_found(times, least), schema)
