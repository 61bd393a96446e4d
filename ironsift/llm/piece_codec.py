"""SentencePiece encoding and decoding with the source bytes of every piece.

Method: offset-preserving encoding. The text is normalised by longest-prefix match through the compiled
character map of the model (a double-array trie whose leaves point at replacement strings), and every
normalised byte remembers where its source starts. Pieces are then projected through that record to byte
spans of the original text. Merging uses the library's own model, loaded without the dummy prefix, over
segments that no piece can cross (a run of word marks and what follows it, or a run of newlines and what
follows); each distinct segment is merged once per worker and kept in a bounded cache.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ironsift.llm.arrowtext import id_and_text, pieces, text_buffers

MARK = "▁"
CACHE = 200_000
_SEGMENT = re.compile(f"{MARK}+[^{MARK}\n]*|\n+[^{MARK}\n]*|[^{MARK}\n]+")
_ALONE = re.compile(f"{MARK}*[^{MARK}\n]*|\n+[^{MARK}\n]*")


class CharacterMap:
    """Longest-prefix replacement by a compiled character map; without a map, characters stay."""

    def __init__(self, blob: bytes) -> None:
        self.units: list[int] = []
        self.strings = b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix of data[at:] and the length of that prefix."""
        found = None
        if not self.units:
            return found
        step = lambda u: (u >> 10) << ((u & 512) >> 6)
        node = step(self.units[0])
        for n, byte in enumerate(data[at:], 1):
            node ^= byte
            if node >= len(self.units) or self.units[node] & 0x800000FF != byte:
                break
            unit = self.units[node]
            node ^= step(unit)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = self.strings[value : self.strings.index(b"\0", value)], n
        return found


class Normalizer:
    def __init__(self, chars: CharacterMap, dummy_prefix: bool, trim: bool) -> None:
        self.chars, self.dummy_prefix, self.trim = chars, dummy_prefix, trim

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its bytes (and its end) the source byte where it starts."""
        data = text.encode()
        mark = MARK.encode()
        if not self.chars.units and not self.trim:
            source = np.frombuffer(data, np.uint8)
            width = np.where(source == 0x20, len(mark), 1)
            head = len(mark) if self.dummy_prefix and data else 0
            places = np.concatenate((np.zeros(head, np.int64), np.repeat(np.arange(len(data)), width), [len(data)]))
            return (MARK if head else "") + text.replace(" ", MARK), places
        out: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            hit = self.chars.longest(data, at)
            n = hit[1] if hit else 1 + sum(1 for x in data[at + 1 : at + 4] if x & 0xC0 == 0x80 and data[at] >= 0xC0)
            if hit is None and data[at] >= 0xC0:
                n = 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            for byte in hit[0] if hit else data[at : at + n]:
                out.append((bytes([byte]), at))
            at += n
        if self.trim:
            out = [x for i, x in enumerate(out) if x[0] != b" " or (i and out[i - 1][0] != b" ")]
            while out and out[-1][0] == b" ":
                out.pop()
        if self.dummy_prefix and out:
            out.insert(0, (b" ", 0))
        wide = [(y, at) for x, at in out for y in (mark if x == b" " else x)]
        end = len(data)
        return bytes(y for y, _ in wide).decode(errors="replace"), np.array([at for _, at in wide] + [end], np.int64)


class Codec:
    """A model with its normaliser; encodes to ids and piece sizes, decodes from the same segments."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        self.normalize = Normalizer(CharacterMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        self.prefixed = spec.add_dummy_prefix or spec.remove_extra_whitespaces
        self.sizes = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in model.pieces])
        self.unknown = {i for i, p in enumerate(model.pieces) if p.type == p.UNKNOWN}
        self.knows_all = bool(model.trainer_spec.byte_fallback)
        self.separable = all(_ALONE.fullmatch(p.piece) for p in model.pieces if p.type in (p.NORMAL, p.USER_DEFINED)) and model.trainer_spec.byte_fallback
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        spec.precompiled_charsmap = b""
        self.library = sentencepiece.SentencePieceProcessor()
        self.library.load_from_serialized_proto(model.SerializeToString())
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.odd: dict[str, bytes] = {}  # sizes of the pieces of segments with characters that the model doesn't know

    def _learn(self, segments: set[str]) -> None:
        new = list(segments - self.cache.keys())
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            self.odd.clear()
            new = list(segments)
        ids = self.library.encode(new, num_threads=1)
        for segment, x, text in zip(new, ids, self.library.decode(ids, num_threads=1), strict=True):
            self.cache[segment] = np.array(x, "<i4").tobytes(), text
            if self.knows_all is False and not self.unknown.isdisjoint(x):
                found = self.library.encode(segment, return_type="proto").pieces
                self.odd[segment] = np.array([len(p.surface.encode()) for p in found], "<i4").tobytes()

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str], list[tuple[str, np.ndarray]], list[np.ndarray]]:
        """Per text its ids (packed), what they decode to, its normalised form with source places, and the sizes of its pieces in that form."""
        normal = [self.normalize(x) for x in texts]
        parts = [_SEGMENT.findall(x) if self.separable else [x] for x, _ in normal]
        self._learn(set().union(*parts))
        ids, decoded, sizes = [], [], []
        for part in parts:
            both = [self.cache[x] for x in part]
            ids.append(b"".join([x[0] for x in both]))
            text = "".join([x[1] for x in both])
            decoded.append(text[1:] if self.prefixed and text.startswith(" ") else text)
            if not self.odd or self.odd.keys().isdisjoint(part):
                sizes.append(self.sizes[np.frombuffer(ids[-1], "<i4")])
            else:
                odd = [self.odd.get(x) for x in part]
                sizes.append(np.concatenate([self.sizes[np.frombuffer(x[0], "<i4")] if y is None else np.frombuffer(y, "<i4") for x, y in zip(both, odd, strict=True)]))
        return ids, decoded, normal, sizes

    def spans(self, places: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte range of every piece of a normalised text, given the source places of its bytes and the pieces' sizes."""
        if size.sum() != len(places) - 1:
            raise ValueError("pieces don't add up to the normalised text")
        end = np.cumsum(size)
        return places[end - size], places[end]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The model of this worker, loaded once."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _encoded(path: str, spans: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            _, offs = text_buffers(batch.column("text"))
            for a, b in pieces(offs):
                texts = [x or "" for x in batch.column("text").slice(a, b - a).to_pylist()]
                packed, decoded, normal, sizes = own.encode(texts)
                ids = np.frombuffer(b"".join(packed), "<i4")
                at = pa.array(np.concatenate(([0], np.cumsum([len(x) // 4 for x in packed]))), pa.int32())
                columns = [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(at, pa.array(ids)), pa.array(decoded)]
                names = ["doc_id", "ids", "decoded"]
                if spans:
                    both = [own.spans(places, x) for (_, places), x in zip(normal, sizes, strict=True)]
                    for k, name in enumerate(("starts", "ends")):
                        columns.append(pa.ListArray.from_arrays(at, pa.array(np.concatenate([x[k] for x in both]), pa.int64())))
                        names.append(name)
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """doc_id, ids, decoded text and (if asked for) the source byte starts and ends of the pieces of every document.

    A null text counts as empty: no ids, empty text. Null and repeated ids are carried along row by row; an empty table gives an empty one. With a
    model that has no bytes to fall back to, what it doesn't know becomes its unknown piece, with the span of all that this piece stands for. A text is
    one record whatever its length. The model file must be at the same path on every worker. Other columns are ignored.
    """
    schema = "doc_id long, ids array<int>, decoded string" + ", starts array<long>, ends array<long>" * spans
    return id_and_text(docs, id_col, text_col).mapInArrow(_encoded(model_path, spans), schema)
