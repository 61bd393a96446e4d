"""Finding every window of a fixed length that also starts earlier, without comparing pairs.

Shared by the two substring operators, which differ in their units (bytes or words) and in how they
choose anchors. The steps:

1. Each document yields anchors. An anchor stands for a short run of window starts; it has the hash
   of a short gram (its bucket) and the hash of its context, all that these windows cover. Two equal
   windows always have an anchor of the same bucket at the same place.
2. Anchors meet by bucket. A bucket with one context is settled: all but its first holder are
   repeats. Where a bucket has several contexts, one holder of each goes on as an edge.
3. Where the plan refines buckets, edges are split into runs of finer buckets, which meet and are settled in the
   same way; what is ambiguous still goes on as an edge.
4. The windows of edges meet, by their own hash or (bytes only) as whole contexts of their bucket; all
   but the first holder are repeats.
5. Each document removes what its repeated windows cover.

Before each exchange, a record batch keeps one row for each context or window (its first holder); the
others are repeats already. A bucket with more than CROWD contexts in one batch is crowded: the further
ones are dealt out by context. So no group has more than CROWD rows from each batch, however often its text occurs.
Edges of a crowded bucket, or of one with more than TOGETHER contexts in all, meet by the hashes of their windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ironsift.llm.arrowtext import GOLD, U, carried_schema, id_and_text, mix, pieces, ranges, signed, spread, text_buffers, with_carried

ROWS_OUT = 100_000
CROWD = 8
TOGETHER = 64


@dataclass
class Anchors:
    """Of some rows: window starts lo..hi (in units) of each anchor, bucket, context; window hashes by start."""

    lo: np.ndarray
    hi: np.ndarray
    bucket: np.ndarray
    context: np.ndarray
    windows: np.ndarray
    first: np.ndarray  # the first unit of each row, with the total at the end
    anchor: np.ndarray | None = None  # for plans that refine: the place of each anchor's gram, and the ids of all grams
    ids: np.ndarray | None = None


Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # lo, hi, bucket, context


@dataclass
class Plan:
    """anchors: of bytes and row offsets. cleaned: bytes, row offsets, removed units to one output batch.

    within: whether an earlier place of the same document counts. refine: the runs into which some anchors are split,
    with finer buckets. context_windows: where units are bytes, the window hashes and their starts in texts that
    lie one after another; contexts are then sent whole, which is shorter than the hashes of all their windows.
    """

    anchors: Callable[[np.ndarray, np.ndarray], Anchors]
    cleaned: Callable[[pa.Array, np.ndarray, np.ndarray, Anchors, np.ndarray], pa.RecordBatch]
    length: int
    within: bool
    refine: Callable[[Anchors, np.ndarray], Runs] | None = None
    context_windows: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None


def _parts(batch: pa.RecordBatch, plan: Plan) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Anchors]]:
    data, offs = text_buffers(batch.column("text"))
    for a, b in pieces(offs):
        part = data[offs[a] : offs[b]]
        own = offs[a : b + 1] - offs[a]
        yield a, b, part, own, plan.anchors(part, own)


def _text_id(part: np.ndarray, own: np.ndarray, row: int) -> int:
    return xxhash.xxh3_64_intdigest(part[own[row] : own[row + 1]].tobytes()) - (1 << 63)


def _blobs(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Window starts lo..hi of each row, packed."""
    order = np.argsort(row, kind="stable")
    pairs = np.stack([lo[order], hi[order]], 1).astype("<i8")
    rows, at = np.unique(row[order], return_index=True)
    return rows, [x.tobytes() for x in np.split(pairs, at[1:])] if len(rows) else []


def _emit(key: np.ndarray, value: np.ndarray, doc: np.ndarray, sure: np.ndarray, known: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Rows for the exchange; known: document, text id and packed repeats, dealt out by document."""
    names = ["key", "value", "doc_id", "sure", "spans"]
    for a in range(0, len(key), ROWS_OUT):
        cut = slice(a, a + ROWS_OUT)
        n = len(key[cut])
        yield pa.RecordBatch.from_arrays([pa.array(signed(key[cut])), pa.array(signed(value[cut])), pa.array(doc[cut]), pa.array(sure[cut]), pa.nulls(n, pa.binary())], names)
    if known:
        doc = np.array([x[0] for x in known], np.int64)
        value = pa.array([x[1] for x in known], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(signed(mix(doc.view(U)))), value, pa.array(doc), pa.nulls(len(known), pa.bool_()), pa.array([x[2] for x in known], pa.binary())], names)


def _firsts(ids: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the index of the first entry (smallest row, place) with its id; and the first entries."""
    by = None
    if not (np.diff(row) >= 0).all() or ((np.diff(row) == 0) & (np.diff(place) < 0)).any():
        by = np.lexsort((place, row))
        ids = ids[by]
    order = np.argsort(ids)
    sorted_ids = ids[order]
    at = np.flatnonzero(np.concatenate(([True], sorted_ids[1:] != sorted_ids[:-1])))
    least = np.minimum.reduceat(order, at)
    first = np.empty(len(ids), np.int64)
    first[order] = np.repeat(least, np.diff(np.concatenate((at, [len(ids)]))))
    if by is None:
        return first, least
    out = np.empty(len(ids), np.int64)
    out[by] = by[first]
    return out, by[least]


def _settle(plan: Plan, docs: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, ids: np.ndarray, text_ids: dict[int, int]) -> tuple[np.ndarray, list[tuple[int, int, bytes]]]:
    """Within a batch: the entries that stand for their id, and the repeats already known."""
    rank = np.empty(len(docs), np.int64)
    rank[np.argsort(docs, kind="stable")] = np.arange(len(docs))
    same = np.unique(docs, return_inverse=True)[1]
    first, least = _firsts(ids, rank[row], lo)
    again = np.flatnonzero(first != np.arange(len(ids)))
    first = first[again]
    other = same[row[first]] != same[row[again]]
    repeat = again[other | (row[first] == row[again])] if plan.within else again[other]
    rows, packed = _blobs(row[repeat], lo[repeat], hi[repeat])
    return np.sort(least), [(int(docs[r]), text_ids[int(r)], x) for r, x in zip(rows, packed, strict=True)]


def _edges(plan: Plan, batch: pa.RecordBatch, deep: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Anchors, Runs]]:
    """The parts of a batch with the runs of their anchors, or (deep) with the finer runs of those that are edges."""
    if deep:
        edges = [_lists(batch.column(x)) for x in ("edges", "crowds")]
    for a, b, part, own, x in _parts(batch, plan):
        runs = x.lo, x.hi, x.bucket, x.context
        if deep:
            row = np.searchsorted(x.first, x.lo, "right") - 1
            runs = plan.refine(x, np.any([_held(x.context, row, y, a, b) for y in edges], axis=0))
        yield a, b, part, own, x, runs


def _anchor_rows(plan: Plan, deep: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: list[tuple[np.ndarray, ...]] = []
            text_ids: dict[int, int] = {}
            for a, b, part, own, x, (lo, hi, bucket, context) in _edges(plan, batch, deep):
                row = np.searchsorted(x.first, lo, "right") - 1
                got.append(((row + a).astype(np.int32), (lo - x.first[row]).astype(np.int32), (hi - x.first[row]).astype(np.int32), bucket, context))
                text_ids |= {int(r) + a: _text_id(part, own, int(r)) for r in np.unique(row)}
            if not got or not sum(len(x[0]) for x in got):
                continue
            row, lo, hi, bucket, context = (np.concatenate(x) for x in zip(*got, strict=True))
            del got
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            kept, known = _settle(plan, docs, row, lo, hi, mix(bucket * GOLD + context), text_ids)
            doc, k, c = docs[row[kept]], bucket[kept], context[kept]
            order = np.argsort(k)
            at = np.flatnonzero(np.concatenate(([True], k[order][1:] != k[order][:-1])))
            size = np.diff(np.concatenate((at, [len(k)])))
            crowd, far = np.zeros(len(k), bool), np.zeros(len(k), bool)
            crowd[order] = np.repeat(size > CROWD, size)
            far[order] = np.arange(len(k)) - np.repeat(at, size) >= CROWD
            yield from _emit(np.where(far, mix(k ^ mix(c)), k), c, doc, crowd, known)

    return run


def _window_rows(plan: Plan, columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The windows of the last edges, one row for each that no earlier document of the batch has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [_lists(batch.column(x)) for x in columns]
            got, text_ids = [], {}
            for a, b, part, own, x, (lo, hi, _, context) in _edges(plan, batch, plan.refine is not None):
                row = np.searchsorted(x.first, lo, "right") - 1
                pick = np.any([_held(context, row, y, a, b) for y in edges], axis=0)
                at = np.unique(ranges(lo[pick], hi[pick]))
                if len(at):
                    row = np.searchsorted(x.first, at, "right") - 1
                    got.append((row + a, at - x.first[row], x.windows[at]))
                    text_ids |= {int(r) + a: _text_id(part, own, int(r)) for r in np.unique(row)}
            if not got:
                continue
            row, at, window = (np.concatenate(x) for x in zip(*got, strict=True))
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            kept, known = _settle(plan, docs, row, at, at + 1, window, text_ids)
            yield from _emit(window[kept], np.zeros(len(kept), U), docs[row[kept]], np.zeros(len(kept), bool), known)

    return run


_CONTEXTS = "key long, doc_id long, text_id long, place long, context binary"


def _context_rows(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The whole contexts of the edges, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _CONTEXTS.split(", ")]
        for batch in batches:
            edges = _lists(batch.column("last_edges"))
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, part, own, x, (lo, hi, bucket, context) in _edges(plan, batch, plan.refine is not None):
                row = np.searchsorted(x.first, lo, "right") - 1
                pick = np.flatnonzero(_held(context, row, edges, a, b))
                if not len(pick):
                    continue
                row, lo, end = row[pick], lo[pick], hi[pick] + plan.length - 1
                ids = np.zeros(b - a, np.int64)
                for r in np.unique(row):
                    ids[r] = _text_id(part, own, int(r))
                size = np.concatenate(([0], np.cumsum(end - lo))).astype(np.int32)
                context = pa.Array.from_buffers(pa.binary(), len(pick), [None, pa.py_buffer(size), pa.py_buffer(part[ranges(lo, end)])])
                yield pa.RecordBatch.from_arrays([pa.array(signed(bucket[pick])), pa.array(docs[row + a]), pa.array(ids[row]), pa.array(lo - x.first[row]), context], names)

    return run


def _settle_contexts(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by key, document and place: which windows of each context also start earlier."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key = rows["key"].to_numpy().view(U)
        doc, text_id, place = (rows[x].to_numpy() for x in ("doc_id", "text_id", "place"))
        data, offs = text_buffers(rows["context"])
        windows, start = plan.context_windows(data, offs)
        row = np.searchsorted(offs, start, "right") - 1
        at = place[row] + start - offs[row]
        ids = windows ^ mix(key[row])
        _, first, group = np.unique(ids, return_index=True, return_inverse=True)
        least = np.full(len(first), len(doc), np.int64)
        np.minimum.at(least, group, row)
        start_at = np.full(len(first), np.iinfo(np.int64).max)
        mine = row == least[group]
        np.minimum.at(start_at, group[mine], at[mine])
        holder = least[group]
        same = (doc[row] == doc[holder]) & (text_id[row] == text_id[holder])
        later = (doc[row] > doc[holder]) | (same & (at > start_at[group]))
        if later.any():
            by, packed = _blobs(row[later], at[later], at[later] + 1)
            yield pa.RecordBatch.from_arrays([pa.array(doc[by]), pa.array(text_id[by]), pa.array(packed, pa.binary())], ["doc_id", "text_id", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            key = rows["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from settle(rows.slice(0, cut).combine_chunks())
            rest = rows.slice(cut).combine_chunks().to_batches()[0]
        if rest is not None:
            yield from settle(pa.Table.from_batches([rest]))

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a column of lists; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.array([0 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()], np.int64)
    return column.flatten(), np.concatenate(([0], np.cumsum(n)))


def _held(values: np.ndarray, row: np.ndarray, lists: tuple[pa.Array, np.ndarray], a: int, b: int) -> np.ndarray:
    """Which values the list of their row (rows a to b of the batch) holds."""
    flat, offs = lists
    held = flat.slice(offs[a], offs[b] - offs[a]).to_numpy(zero_copy_only=False).astype(np.int64).view(U)
    if not len(held):
        return np.zeros(len(values), bool)
    of = np.repeat(np.arange(b - a), np.diff(offs[a : b + 1]))
    busy = np.zeros(b - a, bool)
    busy[of] = True
    out = busy[row]
    salt = mix(np.arange(b - a, dtype=U) + U(1))
    at = np.flatnonzero(out)
    out[at] = np.isin(mix(values[at] ^ salt[row[at]]), mix(held ^ salt[of]))
    return out


def _clean_rows(plan: Plan, carry: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts, finer, windows = (_lists(batch.column(x)) for x in ("contexts", "finer_contexts", "windows"))
            packed = [_lists(batch.column(x)) for x in ("known", "finer_known", "known_windows", "known_contexts")]
            deep = plan.refine is not None and len(finer[0]) > 0
            for a, b, part, own, x, runs in _edges(plan, batch, deep):
                row = np.searchsorted(x.first, x.lo, "right") - 1
                pick = _held(x.context, row, contexts, a, b)
                lo, hi = [x.lo[pick]], [x.hi[pick]]
                if deep:
                    pick = _held(runs[3], np.searchsorted(x.first, runs[0], "right") - 1, finer, a, b)
                    lo.append(runs[0][pick])
                    hi.append(runs[1][pick])
                if windows[1][b] > windows[1][a]:
                    every = np.arange(x.first[-1])
                    at = np.flatnonzero(_held(x.windows, np.searchsorted(x.first, every, "right") - 1, windows, a, b))
                    lo.append(at)
                    hi.append(at + 1)
                for flat, offs in packed:
                    for r in np.flatnonzero(np.diff(offs[a : b + 1])):
                        mine = _text_id(part, own, int(r))
                        for known in flat.slice(offs[a + r], offs[a + r + 1] - offs[a + r]).to_pylist():
                            if known["text_id"] == mine:
                                pairs = np.frombuffer(known["spans"], "<i8").reshape(-1, 2) + x.first[r]
                                lo.append(pairs[:, 0])
                                hi.append(pairs[:, 1])
                gone = spread(np.concatenate(lo), np.concatenate(hi) + plan.length - 1, int(x.first[-1]))
                yield with_carried(plan.cleaned(batch.column("doc_id").slice(a, b - a), part, own, x, gone), batch, a, b, carry)

    return run


_EXCHANGED = "key long, value long, doc_id long, sure boolean, spans binary"


def _resolved(rows: DataFrame) -> DataFrame:
    """Rows dealt out by key: which are repeats of a smaller document, which keys have several values, and which many."""
    by = Window.partitionBy("key").orderBy("value", "doc_id")
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    past = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("value").over(by)
    marked = rows.withColumn("start", F.when(before.isNull() | (before != F.col("value")), F.col("doc_id")))
    marked = marked.withColumn("holder", F.last("start", ignorenulls=True).over(past))
    marked = marked.withColumns({"crowded": F.max("sure").over(whole), "n_values": F.count("start").over(whole)})
    return marked.withColumns({"several": F.col("crowded") | (F.col("n_values") > 1), "crowded": F.col("crowded") | (F.col("n_values") > TOGETHER)})


def _known() -> Column:
    return F.col("spans").isNotNull()


def _later() -> Column:
    return F.col("spans").isNull() & (F.col("doc_id") > F.col("holder"))


def _edge() -> Column:
    return F.col("spans").isNull() & (F.col("doc_id") == F.col("holder")) & F.col("several")


def _known_spans() -> Column:
    return F.collect_list(F.when(_known(), F.struct(F.col("value").alias("text_id"), "spans")))


def _by_document(rows: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """For each document the contexts that are repeats, those that are edges of small and of large buckets, and the
    repeats that its batch has found."""
    kinds = (_later(), _edge() & ~F.col("crowded"), _edge() & F.col("crowded"))
    sets = [F.collect_set(F.when(x, F.col("value"))).alias(k) for x, k in zip(kinds, names[:3], strict=True)]
    return _resolved(rows).filter(_known() | _later() | _edge()).groupBy("doc_id").agg(*sets, _known_spans().alias(names[3]))


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, plan: Plan, schema: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each document without what its repeated windows cover, as plan.cleaned returns it.

    Null texts count as empty. A document with a null id is neither a source nor cleaned. Rows that share
    an id are separate documents of the same rank: none is earlier than the other. Columns named in carry go along with
    their row; others are ignored.
    """
    docs = id_and_text(docs, id_col, text_col, carry)
    named = docs.filter(F.col("doc_id").isNotNull())
    found = _by_document(named.select("doc_id", "text").mapInArrow(_anchor_rows(plan), _EXCHANGED), ("contexts", "edges", "crowds", "known"))
    # All uses of the texts read the same columns and rows, so that they are dealt out by id only once.
    joined = named.join(found.hint("shuffle_hash"), "doc_id", "left")
    some = (F.size("edges") > 0) | (F.size("crowds") > 0)
    spans = "array<struct<text_id: long, spans: binary>>"
    if plan.refine:
        finer = _by_document(joined.filter(some).mapInArrow(_anchor_rows(plan, deep=True), _EXCHANGED), ("finer_contexts", "last_edges", "last_crowds", "finer_known"))
        joined = joined.join(finer.hint("shuffle_hash"), "doc_id", "left")
    else:
        joined = joined.withColumns({"finer_contexts": F.lit(None).cast("array<long>"), "finer_known": F.lit(None).cast(spans), "last_edges": F.col("edges"), "last_crowds": F.col("crowds")})

    by_window = ["last_crowds"] if plan.context_windows else ["last_edges", "last_crowds"]
    some = reduce(Column.__or__, (F.size(x) > 0 for x in by_window))
    windows = _resolved(joined.filter(some).mapInArrow(_window_rows(plan, by_window), _EXCHANGED)).filter(_known() | _later())
    again = windows.groupBy("doc_id").agg(F.collect_set(F.when(_later(), F.col("key"))).alias("windows"), _known_spans().alias("known_windows"))
    whole = joined.join(again.hint("shuffle_hash"), "doc_id", "left")
    if plan.context_windows:
        contexts = joined.filter(F.size("last_edges") > 0).mapInArrow(_context_rows(plan), _CONTEXTS)
        contexts = contexts.repartition("key").sortWithinPartitions("key", "doc_id", "text_id", "place")
        repeats = contexts.mapInArrow(_settle_contexts(plan), "doc_id long, text_id long, spans binary")
        repeats = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("text_id", "spans")).alias("known_contexts"))
        whole = whole.join(repeats.hint("shuffle_hash"), "doc_id", "left")
    else:
        whole = whole.withColumn("known_contexts", F.lit(None).cast(spans))
    unnamed = docs.filter(F.col("doc_id").isNull())
    return whole.unionByName(unnamed, allowMissingColumns=True).mapInArrow(_clean_rows(plan, carry), schema + carried_schema(docs, carry))
