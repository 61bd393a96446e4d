"""Word, line and n-gram hashes of Arrow text columns, computed with numpy over whole record batches.

Everything here is a helper that runs inside Spark tasks. A batch is handled in pieces of a quarter of
a megabyte, so that memory does not follow the size of the batch; a single long text is cut at
separators. Hashes are 64-bit and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64
GOLD = U(0x9E3779B97F4A7C15)
PIECE = 1 << 18

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_IDS = mix((np.arange(256, dtype=U) + U(1)) * GOLD)
_lower = np.arange(256)
_lower[65:91] += 32
LOWER = _lower.astype(np.uint8)
LOWER_IDS = BYTE_IDS[_lower]

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NEWLINES = np.zeros(256, bool)
NEWLINES[0x0A] = True

_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * PIECE)
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b, U)
            p[0] = U(1)
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def range_hashes(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ids[start:end] for every pair; independent of where the range stands."""
    up, down = powers(len(ids) + 1)
    sums = np.zeros(len(ids) + 1, U)
    np.cumsum(ids * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * GOLD)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def pieces(offs: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows that together have at most size bytes, or one row with more."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _cut(data: np.ndarray, offs: np.ndarray, seps: np.ndarray, a: int, b: int) -> int:
    """The last place up to b (or else the first after it) where a part that starts at a may end."""
    n = len(data)
    if b >= n:
        return n
    at_sep = np.flatnonzero(seps[data[a:b]])
    row = offs[np.searchsorted(offs, b, "right") - 1]
    best = max(int(at_sep[-1]) + a if len(at_sep) else a, int(row))
    while best <= a:
        row = int(offs[min(np.searchsorted(offs, b, "right"), len(offs) - 1)])
        c = min(n, b + PIECE)
        at_sep = np.flatnonzero(seps[data[b:c]])
        nearest = int(at_sep[0]) + b if len(at_sep) else n + 1
        if min(row, nearest) <= c or c == n:
            return min(row, nearest, n)
        b = c
    return best


def tokens(data: np.ndarray, offs: np.ndarray, seps: np.ndarray = SPACES, ids: np.ndarray = BYTE_IDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every maximal run of bytes that are not separators; runs end with their row."""
    parts = []
    a, n = 0, len(data)
    while a < n:
        b = _cut(data, offs, seps, a, min(n, a + PIECE))
        seg = data[a:b]
        inside = ~seps[seg]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        rows = offs[np.searchsorted(offs, a, "left") : np.searchsorted(offs, b, "left")] - a
        first[rows] = inside[rows]
        ends = rows[rows > 0] - 1
        last[ends] = inside[ends]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        parts.append((range_hashes(ids[seg], s, e), s + a, e + a))
        a = b
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))  # type: ignore[return-value]


def rows_of(starts: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each token, and for each row the index of its first token (with the total at the end)."""
    first = np.searchsorted(starts, offs)
    return np.repeat(np.arange(len(offs) - 1), np.diff(first)), first


def grams(ids: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and index of the first token of each run of n tokens of one row."""
    counts = np.diff(first)
    room = np.repeat(first[1:], counts)
    at = np.flatnonzero(np.arange(len(ids)) + n <= room)
    return range_hashes(ids, at, at + n), at


def spread(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the half-open ranges."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, lo, 1)
    np.add.at(steps, hi, -1)
    return np.cumsum(steps[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true flags."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All positions of the half-open ranges, one range after another."""
    n = hi - lo
    return np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(lo) else np.zeros(0, np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def id_and_text(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and text, and the columns to carry along. Columns that have the name and type already stay as they are: an alias would
    keep Spark from seeing that two uses of them are the same exchange."""
    ready = dict(docs.dtypes)
    doc_id = F.col(id_col) if id_col == "doc_id" and ready[id_col] == "bigint" else F.col(id_col).cast("long").alias("doc_id")
    text = F.col(text_col) if text_col == "text" and ready[text_col] == "string" else F.col(text_col).cast("string").alias("text")
    return docs.select(doc_id, text, *(x for x in carry if x not in ("doc_id", "text")))


def carried_schema(docs: DataFrame, carry: tuple[str, ...]) -> str:
    """Names and types of the columns to carry along, to be added to a schema."""
    return "".join(f", `{x}` {docs.schema[x].dataType.simpleString()}" for x in carry)


def with_carried(out: pa.RecordBatch, batch: pa.RecordBatch, a: int, b: int, carry: tuple[str, ...]) -> pa.RecordBatch:
    """Results of the rows a to b of a batch, with the columns that they carry along."""
    return pa.RecordBatch.from_arrays([*out.columns, *(batch.column(x).slice(a, b - a) for x in carry)], [*out.schema.names, *carry])
