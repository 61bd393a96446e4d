"""Quality rules: base counts, and compression bands that reject repetitive or incompressible text.

Method: the zstandard ratio (compressed bytes by bytes) of the whole document, and of each fixed chunk of
4096 bytes, must lie in a band that depends on the length; short text compresses less. What follows the last
full chunk is judged by the band of its own length, and again within the chunk that ends with the text.
Repetitive text falls below its band; base64 and random printable text stand above it from 256 bytes on. Random
hexadecimal digits (0.50 to 0.53) are as dense as prose below 16384 bytes, and pass there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ironsift.llm.arrowtext import GOLD, NEWLINES, SPACES, U, carried_schema, grams, id_and_text, mix, pieces, rows_of, spread, text_buffers, tokens, with_carried

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CHUNK = 4096
LEVEL = 3
#: Length in bytes from which the band holds, lowest and highest ratio. Below the first no band holds.
#: The highest lie between prose and base64: from 1024 bytes on prose was seen at 0.70 at most, from 4096 on at 0.55, from 16384
#: on 0.47; base64 has 0.85 or more up to 512 bytes, and never less than 0.75.
BANDS = ((128, 0.45, 1.05), (256, 0.42, 0.84), (512, 0.40, 0.78), (1024, 0.38, 0.74), (2048, 0.37, 0.70), (4096, 0.35, 0.65), (16384, 0.32, 0.49), (65536, 0.28, 0.48))
#: The band of every full chunk.
CHUNK_LOW, CHUNK_HIGH = 0.25, 0.65

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(x) for x in "#*$%&|<>"]] = True
_SCHEMA = "doc_id long, n_bytes long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, min_chunk_ratio double, max_chunk_ratio double, tail_ratio double"


def _again(row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries equal an earlier one of their row, and which have an equal at all."""
    keys = mix(ids ^ mix(row.astype(U) + GOLD))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, shared = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    shared[order[1:]] = same
    shared[order[:-1]] |= same
    return later, shared


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offs])


def base_counts(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    ids, starts, ends = tokens(data, offs)
    row, first = rows_of(starts, offs)
    in_words = ~SPACES[data]
    letters = in_words & ((data & 0xC0) != 0x80)
    line_ids, line_starts, line_ends = tokens(data, offs, NEWLINES)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_ids, line_starts = line_ids[worded], line_starts[worded]
    line_row, line_first = rows_of(line_starts, offs)
    dup_lines, _ = _again(line_row, line_ids)
    hashes, at = grams(ids, first, 3)
    _, shared = _again(row[at], hashes)
    repeat = spread(at[shared], at[shared] + 3, len(ids))
    return [np.diff(first), _sums(letters, offs), _sums(SYMBOLS[data], offs), _sums(dup_lines, line_first), _sums(repeat, first)]


def _ratios(data: bytes, press: zstandard.ZstdCompressor) -> tuple[float | None, float | None, float | None, float | None]:
    n = len(data)
    if not n:
        return None, None, None, None
    whole = len(press.compress(data)) / n
    chunks = [len(press.compress(data[a : a + CHUNK])) / CHUNK for a in range(0, n - CHUNK + 1, CHUNK)] if n > CHUNK else []
    tail = n % CHUNK if n > CHUNK else 0
    if tail:
        chunks.append(len(press.compress(data[-CHUNK:])) / CHUNK)
    return whole, min(chunks, default=None), max(chunks, default=None), len(press.compress(data[-tail:])) / tail if tail else None


def _band(n_bytes: Column) -> tuple[Column, Column]:
    """Lowest and highest ratio for a length."""
    low, high = F.lit(0.0), F.lit(float("inf"))
    for size, least, most in BANDS:
        low = F.when(n_bytes >= size, F.lit(least)).otherwise(low)
        high = F.when(n_bytes >= size, F.lit(most)).otherwise(high)
    return low, high


def _measures(carry: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        for batch in batches:
            data, offs = text_buffers(batch.column("text"))
            for a, b in pieces(offs):
                part, own = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                counts = [pa.array(x, pa.int64()) for x in base_counts(part, own)]
                raw = part.tobytes()
                ratios = zip(*(_ratios(raw[i:j], press) for i, j in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)), strict=True)
                out = pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(np.diff(own)), *counts, *(pa.array(x, pa.float64()) for x in ratios)], names)
                yield with_carried(out, batch, a, b, carry)

    return run


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Base counts, ratios, base_failed, reason and kept of every document.

    A null text counts as empty: no words, null ratios, base_failed. A null id is carried along; rows that share an
    id are judged one by one. Texts under 128 bytes have no band, and chunks count only in texts over one chunk; tail_ratio is null in others and in whole chunks.
    reason is the first rule that rejects (null if kept). Columns named in carry (text among them) go along with
    their row; others are ignored.
    """
    docs = id_and_text(docs, id_col, text_col, carry)
    out = docs.mapInArrow(_measures(carry), _SCHEMA + carried_schema(docs, carry))
    low, high = _band(F.col("n_bytes"))
    tail_low, tail_high = _band(F.col("n_bytes") % CHUNK)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    reason = F.when(F.col("n_words") < MIN_WORDS, "few words").when(failed, "repeated words")
    reason = reason.when(F.col("ratio") < low, "repetitive").when(F.col("ratio") > high, "incompressible")
    reason = reason.when(F.col("min_chunk_ratio") < CHUNK_LOW, "repetitive chunk").when(F.col("max_chunk_ratio") > CHUNK_HIGH, "incompressible chunk")
    reason = reason.when(F.col("tail_ratio") < tail_low, "repetitive tail").when(F.col("tail_ratio") > tail_high, "incompressible tail")
    return out.withColumns({"base_failed": failed, "reason": reason}).withColumn("kept", F.col("reason").isNull())
