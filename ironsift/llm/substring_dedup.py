"""Substring dedup: words of every run of a given length that also occurs in an earlier document are removed.

Method: difference-cover anchors. Word positions whose remainder modulo 7 is in {0, 1, 3} are a difference
cover: for any two positions i and j there is a shift under 7 that takes both into the cover. Runs of 7
words are hashed at cover positions only, so two equal runs of 13 words, wherever they stand, share an
aligned anchor. A match is then extended to the 13 to 19 words around the anchor, and where these differ,
to each single run of 13 words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ironsift.llm.arrowtext import GOLD, U, mix, range_hashes, rows_of, tokens
from ironsift.llm.repeats import Anchors, Plan, repeated_windows
from ironsift.llm.suffix_dedup import packed, span_lists

LENGTH = 13
PERIOD = 7
COVER = (0, 1, 3)
GRAM = LENGTH - PERIOD + 1
_SCHEMA = "doc_id long, kept string, n_words long, n_removed long, spans array<struct<start: long, end: long>>"


def _anchors(data: np.ndarray, offs: np.ndarray) -> Anchors:
    ids, starts, _ = tokens(data, offs)
    row, first = rows_of(starts, offs)
    n = len(ids)
    place = np.arange(n) - first[row]
    last = first[1:][row] - LENGTH  # the last window start of the row
    at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (np.arange(n) + GRAM <= first[1:][row]) & (last >= first[:-1][row]))
    lo, hi = at - np.minimum(place[at], PERIOD - 1), np.minimum(at, last[at]) + 1
    keep = lo < hi
    at, lo, hi = at[keep], lo[keep], hi[keep]
    bucket = range_hashes(ids, at, at + GRAM)
    context = mix(range_hashes(ids, lo, hi - 1 + LENGTH) ^ ((at - lo).astype(U) * GOLD))
    windows = np.zeros(n, U)
    full = np.arange(max(0, n - LENGTH + 1))
    windows[full] = range_hashes(ids, full, full + LENGTH)
    return Anchors(lo, hi, bucket, context, windows, first)


def _cleaned(doc_id: pa.Array, data: np.ndarray, offs: np.ndarray, found: Anchors, gone: np.ndarray) -> pa.RecordBatch:
    _, starts, ends = tokens(data, offs)
    row, first = rows_of(starts, offs)
    spans, lost = span_lists(gone, first)
    stay = np.flatnonzero(~gone)
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts[stay]] += 1
    np.subtract.at(keep, ends[stay], 1)
    keep = np.cumsum(keep[:-1], dtype=np.int8) > 0
    gap = ends[stay[:-1]][row[stay[:-1]] == row[stay[1:]]] if len(stay) else stay
    data = data.copy()
    data[gap] = 0x20
    keep[gap] = True
    return pa.RecordBatch.from_arrays([doc_id, packed(pa.string(), data, keep, offs), pa.array(np.diff(first)), pa.array(lost), spans], ["doc_id", "kept", "n_words", "n_removed", "spans"])


def dedup_word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kept words joined by one space, n_words, n_removed and the removed word spans of every document.

    A word goes when a run of 13 words that covers it also starts in a document with a smaller id, judged on
    the input. Nulls, empty texts, repeated ids and other columns: see repeats.repeated_windows. Texts under
    13 words stay whole.
    """
    return repeated_windows(docs, id_col, text_col, Plan(_anchors, _cleaned, LENGTH, within=False), _SCHEMA, carry)
