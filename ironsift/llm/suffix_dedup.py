"""Suffix-array dedup: bytes of every string of a given length that also starts earlier are removed.

Method: bucket-pointer refinement of the suffixes. The bucket identifier of a suffix is the hash of its
first q = 32 bytes, built by pairing the identifiers of its halves. Buckets are refined by the identifiers
of later offsets, and each level reuses the identifiers of the one before.

* Of the q-grams of every window of 100 bytes only the one with the least identifier (ties: the leftmost) is put
  into its bucket, which equal windows choose alike. A bucket whose suffixes stand in one context is settled, and a
  suffix alone in its bucket is never refined.
* Ambiguous buckets are refined by an exchange on the pair (identifier at p, identifier at p + 32); windows
  that end before p + 64 are sorted on (identifier at p, identifier at p - 32), which they hold. Most are settled then.
* What is still ambiguous is refined to its full depth: depth 64 pairs the identifiers at p and p + 32, depth 100
  those of depth 64 at p and p + 36. Small buckets do so where they meet, of large ones single windows are dealt out by
  their identifier of depth 100.

No suffix is ranked: order doesn't matter for equality, so identifiers are 64-bit hashes, the same in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ironsift.llm.arrowtext import BYTE_IDS, GOLD, U, mix, ranges, runs
from ironsift.llm.repeats import Anchors, Plan, repeated_windows

LENGTH = 100
GRAM = 32
_STARTS = 1 << 16
_PLACE = U((1 << 20) - 1)
_SCHEMA = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>"


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The identifier of a bucket from those of its first part and of a later offset."""
    z = (x ^ (x >> U(31))) * U(0xD6E8FEB86659FD93) + y
    return z ^ (z >> U(29))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window of the width."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _gram_ids(data: np.ndarray) -> np.ndarray:
    """The bucket identifier of every suffix at depth 32."""
    ids, depth = BYTE_IDS[data], 1
    while depth < GRAM:
        ids = _pair(ids[:-depth], ids[depth:])
        depth *= 2
    return mix(ids)


def _window_ids(ids: np.ndarray) -> np.ndarray:
    """The bucket identifiers at depth 100 from those at depth 32."""
    double = _pair(ids[:-GRAM], ids[GRAM:])
    rest = LENGTH - 2 * GRAM
    return mix(_pair(double[:-rest], double[rest:]))


def _valid(offs: np.ndarray) -> np.ndarray:
    """Where a window may start, so that it ends in its row."""
    valid = np.ones(int(offs[-1]), bool)
    valid[ranges(np.maximum(offs[1:] - LENGTH + 1, offs[:-1]), offs[1:])] = False
    return valid


def _context_windows(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(_valid(offs))
    return _window_ids(_gram_ids(data))[start], start


def _gram_places(ids: np.ndarray) -> np.ndarray:
    """For the start of every window the place of the gram with the least identifier in it, the leftmost of equals."""
    keys = (ids & ~_PLACE) | np.arange(len(ids), dtype=U)
    return (_least(keys, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)


def _anchors(data: np.ndarray, offs: np.ndarray) -> Anchors:
    """The anchors of rows that lie one after another. Identifiers are made block by block, but runs are found over all
    blocks and end with their row only, so that the anchors of a text don't depend on what stands around it."""
    n = len(data)
    count = max(0, n - LENGTH + 1)
    ids, windows, at = np.zeros(max(0, n - GRAM + 1), U), np.zeros(n, U), np.zeros(count, np.int64)
    for a in range(0, count, _STARTS):
        part = _gram_ids(data[a : a + _STARTS + LENGTH - 1])
        ids[a : a + len(part)] = part
        b = min(count, a + _STARTS)
        at[a:b] = _gram_places(part) + a
        windows[a:b] = _window_ids(part)
    valid = _valid(offs)[:count]
    change = np.ones(count + 1, bool)  # whether a window and the one before have different anchors
    change[1:count] = (at[1:] != at[:-1]) | ~valid[:-1] | ~valid[1:]
    lo, hi = np.flatnonzero(valid & change[:-1]), np.flatnonzero(valid & change[1:]) + 1
    anchor = at[lo]
    return Anchors(lo, hi, ids[anchor], _contexts(ids, anchor, lo, hi), windows, offs, anchor, ids)


def _contexts(ids: np.ndarray, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The identifier of all that the windows lo to hi of an anchor cover, from those at later and later offsets."""
    last = hi - 1 + LENGTH - GRAM
    context = mix(ids[anchor] + (anchor - lo).astype(U) * GOLD + (hi - lo).astype(U))
    for step in range(0, 2 * LENGTH - GRAM, GRAM):
        context = _pair(context, ids[np.minimum(lo + step, last)])
    return mix(context)


def _refined(found: Anchors, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One refinement of the buckets of some anchors: their windows that hold the next 32 bytes are sorted on the bucket
    identifier there, the others, which hold the 32 bytes before, on the identifier there. Equal windows stay together."""
    lo, hi, bucket, anchor = found.lo[pick], found.hi[pick], found.bucket[pick], found.anchor[pick]
    cut = np.clip(anchor + 2 * GRAM - LENGTH, lo, hi)
    right, left = cut < hi, lo < cut
    ids = found.ids
    keys = np.concatenate((_pair(bucket[right], ids[anchor[right] + GRAM]), _pair(bucket[left] ^ GOLD, ids[anchor[left] - GRAM])))
    lo, hi, anchor = (np.concatenate(x) for x in ((cut[right], lo[left]), (hi[right], cut[left]), (anchor[right], anchor[left])))
    return lo, hi, mix(keys), _contexts(ids, anchor, lo, hi)


def span_lists(gone: np.ndarray, first: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The runs of removed units of each row, relative to its start, and how many units each row lost."""
    lo, hi = runs(gone)
    cuts = first[1:-1]
    inner = cuts[(cuts > 0) & (cuts < len(gone))]
    both = inner[gone[inner] & gone[inner - 1]] if len(gone) else inner
    lo, hi = np.unique(np.concatenate((lo, both))), np.unique(np.concatenate((hi, both)))
    row = np.searchsorted(first, lo, "right") - 1
    offsets = np.searchsorted(row, np.arange(len(first)))
    pairs = pa.StructArray.from_arrays([pa.array(lo - first[row], pa.int64()), pa.array(hi - first[row], pa.int64())], ["start", "end"])
    total = np.concatenate(([0], np.cumsum(gone)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs), np.diff(total[first])


def packed(kind: pa.DataType, data: np.ndarray, keep: np.ndarray, offs: np.ndarray) -> pa.Array:
    """The kept bytes of each row."""
    total = np.concatenate(([0], np.cumsum(keep)))[offs].astype(np.int32)
    return pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(total), pa.py_buffer(data[keep])])


def _cleaned(doc_id: pa.Array, data: np.ndarray, offs: np.ndarray, found: Anchors, gone: np.ndarray) -> pa.RecordBatch:
    spans, lost = span_lists(gone, offs)
    kept = packed(pa.binary(), data, ~gone, offs)
    return pa.RecordBatch.from_arrays([doc_id, kept, pa.array(np.diff(offs)), pa.array(lost), spans], ["doc_id", "kept", "n_bytes", "n_removed", "spans"])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept bytes, n_bytes, n_removed and the removed spans of every document, judged on the input.

    A byte goes when a string of 100 bytes that covers it also starts earlier: in a document with a smaller
    id, or before in the same document. What is left may cut a character, so it is binary. Nulls, empty
    texts, repeated ids and other columns: see repeats.repeated_windows. Texts under 100 bytes stay whole.
    """
    return repeated_windows(docs, id_col, text_col, Plan(_anchors, _cleaned, LENGTH, True, _refined, _context_windows), _SCHEMA)
