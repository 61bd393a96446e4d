"""Byte-level BPE by ranks, in two tiers.

Texts are split into pre-tokens by rules over whole arrays of characters. Tier one: a minimal perfect hash of the
vocabulary (levels of bits, where each entry takes the first level on which no other entry shares its place; its slot is
the number of bits before it) answers all pre-tokens of a batch at once; the bytes at the slot are compared, so that a
pre-token outside the vocabulary isn't taken for an entry. Tier two: what is no entry is merged by a heap of ranks over
linked bytes. Its results are remembered per worker, up to a bound.

Which characters are letters, numbers and blanks is asked of the tiktoken library, once for each character that occurs,
since other libraries follow other versions of Unicode.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ironsift.llm.arrowtext import BYTE_IDS, GOLD, U, id_and_text, mix, pieces, range_hashes, ranges, text_buffers

MEMORY = 500_000
LONG = 64
LETTER, NUMBER, BLANK, OTHER = 1, 2, 3, 4
#: The pattern that `Splitter` follows.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class PerfectHash:
    """Slots 0 to n-1 of n distinct 64-bit keys; other keys get any slot or -1."""

    def __init__(self, keys: np.ndarray, room: float = 2.0) -> None:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys aren't distinct")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # bits, and how many are set before each
        base = 0
        while len(keys):
            places = self._places(keys, len(self.levels), max(1, int(room * len(keys))))
            bits = np.bincount(places, minlength=max(1, int(room * len(keys)))) == 1
            self.levels.append((bits, base + np.cumsum(bits) - bits))
            base += int(bits.sum())
            keys = keys[~bits[places]]

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.full(1, level + 1, U) * GOLD) % U(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(self.levels):
            places = self._places(keys[left], level, len(bits))
            hit = bits[places]
            out[left[hit]] = before[places[hit]]
            left = left[~hit]
        return out


class Splitter:
    """The pre-tokens of texts, as PATTERN matches them one after another; together they cover each text."""

    def __init__(self) -> None:
        import tiktoken

        single = {bytes([b]): b for b in range(256)}
        self.known = [(k, tiktoken.Encoding(f"class {k}", pat_str=p, mergeable_ranks=single, special_tokens={})) for k, p in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s"))]
        self.kind = np.zeros(0x110000, np.uint8)

    def _kinds(self, chars: np.ndarray) -> np.ndarray:
        kinds = self.kind[chars]
        if not kinds.all():
            new = np.unique(chars[kinds == 0])
            self.kind[new] = OTHER
            text = new.astype("<u4").tobytes().decode("utf-32-le")
            for k, library in self.known:
                members = library.decode_bytes(library.encode_ordinary(text)).decode()
                self.kind[np.frombuffer(members.encode("utf-32-le"), "<u4")] = k
            kinds = self.kind[chars]
        return kinds

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in the UTF-8 bytes of texts that have the given offsets."""
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        if not len(chars):
            return np.zeros(0, np.int64)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        kinds = self._kinds(chars)
        starts = np.searchsorted(at, offs[:-1][offs[:-1] < offs[1:]])
        before, after = np.zeros_like(kinds), np.zeros_like(kinds)
        before[1:], after[:-1] = kinds[:-1], kinds[1:]
        before[starts] = after[starts[1:] - 1] = 0
        blank = kinds == BLANK
        after_space = np.zeros(len(chars), bool)
        after_space[1:] = chars[:-1] == 0x20
        after_space[starts] = False
        first = (kinds != before) & (blank | ~after_space)
        first |= blank & (after != BLANK) & (after != 0)
        self._contractions(chars, after, first)
        return at[first]

    @staticmethod
    def _contractions(chars: np.ndarray, after: np.ndarray, first: np.ndarray) -> None:
        quotes = np.flatnonzero((chars == 0x27) & first & (after == LETTER))
        if not len(quotes):
            return
        n = len(chars)
        one = chars[quotes + 1]
        two = np.where((quotes + 2 < n) & (after[quotes + 1] == LETTER), chars[np.minimum(quotes + 2, n - 1)], 0)
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        hit, size = quotes[short | long], np.where(short, 2, 3)[short | long]
        first[hit + 1] = False
        ends = hit + size
        first[ends[ends < n]] = True


class Ranks:
    """A rank file's entries: their slots, their bytes by slot and by rank, and the merges."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        with system.open_input_stream(name) as f:
            entries = [line.split() for line in f.read().splitlines() if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in entries}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a byte has no rank")
        order = sorted(self.ranks, key=self.ranks.__getitem__)
        self.data, self.offs = self._joined(order)
        self.by_rank = np.full(max(self.ranks.values()) + 1, -1)
        numbers = np.array([self.ranks[x] for x in order])
        self.by_rank[numbers] = np.arange(len(order))
        keys = range_hashes(BYTE_IDS[self.data], self.offs[:-1], self.offs[1:])
        self.hash = PerfectHash(keys)
        self.entry = np.empty(len(order), np.int64)
        self.entry[self.hash.slots(keys)] = np.arange(len(order))
        self.rank = numbers
        self.split = Splitter()
        self.pairs = [[self.ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]
        self.memory: dict[bytes, bytes] = {}

    @staticmethod
    def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)

    def whole(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Ranks of the pre-tokens data[lo:hi] that are entries, else -1."""
        out = np.full(len(lo), -1)
        slots = self.hash.slots(range_hashes(BYTE_IDS[data], lo, hi))
        entry = np.where(slots >= 0, self.entry[slots], 0)
        a = self.offs[entry]
        same = np.flatnonzero((slots >= 0) & (self.offs[entry + 1] - a == hi - lo))
        if len(same):
            size = hi[same] - lo[same]
            equal = data[ranges(lo[same], hi[same])] == self.data[ranges(a[same], a[same] + size)]
            same = same[np.logical_and.reduceat(equal, np.cumsum(size) - size)]
            out[same] = self.rank[entry[same]]
        return out

    def merged(self, token: bytes) -> list[int]:
        """Ranks that a pre-token merges into: the lowest rank first, the leftmost of equals."""
        n, ranks, pairs = len(token), self.ranks, self.pairs
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        now = [pairs[a][b] for a, b in zip(token, token[1:], strict=False)]  # the rank of the pair that starts here
        now.append(-1)
        heap = [r * n + i for i, r in enumerate(now) if r >= 0]
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            if now[i] != r:
                continue
            j = end[i]
            k = end[i] = end[j]
            now[j] = now[i] = -1
            if k < n:
                before[k] = i
                r = now[i] = ranks.get(token[i : end[k]], -1)
                if r >= 0:
                    heapq.heappush(heap, r * n + i)
            p = before[i]
            if p >= 0:
                r = now[p] = ranks.get(token[p:k], -1)
                if r >= 0:
                    heapq.heappush(heap, r * n + p)
        out, i = [], 0
        while i < n:
            out.append(ranks[token[i : end[i]]])
            i = end[i]
        return out

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and where each text's start."""
        lo = self.split(data, offs)
        hi = np.append(lo[1:], len(data))
        found = self.whole(data, lo, hi)
        missed = np.flatnonzero(found < 0)
        count = np.ones(len(lo), np.int64)
        raw, memory, parts = data.tobytes(), self.memory, []
        for a, b in zip(lo[missed].tolist(), hi[missed].tolist(), strict=True):
            token = raw[a:b]
            ids = memory.get(token)
            if ids is None:
                ids = array("i", self.merged(token)).tobytes()
                if b - a <= LONG:
                    if len(memory) >= MEMORY:
                        memory.clear()
                    memory[token] = ids
            parts.append(ids)
        count[missed] = np.array([len(x) for x in parts], np.int64) // 4
        at = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(at[-1], np.int32)
        out[at[:-1][found >= 0]] = found[found >= 0]
        out[ranges(at[missed], at[missed + 1])] = np.frombuffer(b"".join(parts), np.int32)
        return out, at[np.searchsorted(lo, offs)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and the place where those of each id start (with the end)."""
        entry = self.by_rank[ids]
        if len(ids) and entry.min() < 0:
            raise ValueError("an id has no entry")
        lo, hi = self.offs[entry], self.offs[entry + 1]
        return self.data[ranges(lo, hi)], np.concatenate(([0], np.cumsum(hi - lo)))


_loaded: dict[str, Ranks] = {}


def ranks_of(path: str) -> Ranks:
    """The rank file of this worker, loaded once."""
    if path not in _loaded:
        _loaded[path] = Ranks(path)
    return _loaded[path]


def _encoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks_of(path)
        for batch in batches:
            data, offs = text_buffers(batch.column("text"))
            for a, b in pieces(offs):
                ids, at = own.encode(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                decoded, places = own.decode(ids)
                columns = [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))]
                cuts = pa.py_buffer(places[at].astype(np.int32))
                columns.append(pa.Array.from_buffers(pa.binary(), b - a, [None, cuts, pa.py_buffer(decoded)]))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return run


def encode_ranked(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and decoded bytes of every document, without special tokens.

    A null or empty text has no ids and decodes to nothing. Null and repeated ids are carried along row by row, an empty
    table gives an empty one, other columns are ignored. A text is one record, whatever its length; memory follows the
    longest text. The rank file must be at the same path on every worker.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_encoded(ranks_path), "doc_id long, ids array<int>, decoded binary")
