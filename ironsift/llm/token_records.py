"""Token ids as binary record files with an index.

A shard is a sequence of records, each framed as

    length of the body, unsigned 64-bit | masked checksum of those 8 bytes, 32-bit | body | masked checksum of the body

all little-endian. The checksum is CRC-32, rotated right by 15 bits plus 0xA282EAD8, so that a checksum stored
within data isn't taken for one of the data. The body is: document id (signed 64-bit), 1 if that id is null, bytes per
token (2 if the vocabulary allows it, else 4), then the ids. Beside each shard stands an index with the id and the byte
offset of every record (two signed 64-bit each), so that shuffled reads seek to records without a scan.

Shards hold ascending ranges of document ids and are written by the tasks, one file each, into the shared folder. A
file's name has its task attempt; only the names that successful tasks return are read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ironsift.llm.arrowtext import LOWER, SPACES, id_and_text, pieces, ranges, text_buffers
from ironsift.llm.shared import kept, shared_dir

CACHE = 800_000
SEPARATOR = "0"
TOGETHER = 1000
PART = 1 << 21
_LETTERS, _PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<q??")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    size = struct.pack("<Q", len(body))
    return size + struct.pack("<I", masked(size)) + body + struct.pack("<I", masked(body))


def head(doc_id: int | None, width: int) -> bytes:
    return _BODY.pack(doc_id or 0, doc_id is None, width == 2)


def frames(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The bodies of a stream of records; an error where a checksum doesn't hold or a record is cut."""
    while head := read(_HEAD.size):
        if len(head) != _HEAD.size:
            raise ValueError("damaged record length")
        size, check = _HEAD.unpack(head)
        if masked(head[:8]) != check:
            raise ValueError("damaged record length")
        body, end = read(size), read(4)
        if len(body) != size or len(end) != 4 or masked(body) != struct.unpack("<I", end)[0]:
            raise ValueError("damaged record")
        yield body


#: Texts that show whether a tokenizer treats runs of a text apart from one another.
_PROBES = [
    "Two Words", "Tab\tand\nline  two", "It's a-b, c.d! (e) f_g", "\u00c9 e\u0301 A\u0301B I\u0307 \u0130", "0 10 x0y 0", "na\u00efve \ufb01n \u01c5", "\u4e2d\u6587 \u5b57", "#x #Y ... !!", "A,B a ,b",
    "don't STOP it'll", "100% 3.14 1,000", " lead and trail ", "", "\u200b a\u00a0b", "\ud55c\uad6d\uc5b4 \u0e44\u0e17\u0e22",
]


class WordEncoder:
    """Ids of texts; each distinct run without ASCII white space is encoded once and kept in a bounded cache.

    That is right for tokenizers that compose and lower characters, drop white space, and whose pre-tokens cross neither
    it nor the place after a letter. Whether one is such is verified as it is loaded, by its parts and on probes; for any
    other, whole texts are encoded. Where the digit SEPARATOR is one token, new runs without it are encoded many
    at a time with it in between, and taken apart at its id: no other text has that id.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        alone = self._ids([SEPARATOR])[0]
        self.separator = alone[0] if len(alone) == 1 else None
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}
        self.by_runs = True
        self.by_runs = self._by_runs()

    def _by_runs(self) -> bool:
        probes = [*_PROBES, " ".join(_PROBES), "".join(_PROBES)]
        whole = [np.array(x, self.kind).tobytes() for x in self._ids(probes)]
        try:
            return self._drops_blanks() and self.encode(pa.array(probes)) == whole
        except ValueError:
            return False

    def _drops_blanks(self) -> bool:
        """Whether the tokenizer's first step parts a text at white space and forgets it."""
        step = self.library.pre_tokenizer
        return step is not None and step.pre_tokenize_str(" \t\n\r ") == [] and len(step.pre_tokenize_str("a b")) == 2

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        together = [w for w in words if SEPARATOR not in w] if self.separator is not None else []
        alone = [w for w in words if SEPARATOR in w] if self.separator is not None else words
        for w, x in zip(alone, self._ids(alone), strict=True):
            self.cache[w] = np.array(x, self.kind).tobytes()
        for a in range(0, len(together), TOGETHER):
            part = together[a : a + TOGETHER]
            ids = np.array(self._ids([f" {SEPARATOR} ".join(part)])[0], self.kind)
            cuts = np.flatnonzero(ids == self.separator) * self.width
            if len(cuts) != len(part) - 1:
                raise ValueError("separators don't match the words")
            raw = ids.tobytes()
            starts, ends = [0, *(cuts + self.width).tolist()], [*cuts.tolist(), len(raw)]
            self.cache.update(zip(part, [raw[i:j] for i, j in zip(starts, ends, strict=True)], strict=True))

    def _words(self, data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The runs of all texts, and for each text the number of its first. Runs also end between an ASCII letter and
        ASCII punctuation, where pre-tokens do. A-Z are lowered but before other characters, with which they may compose."""
        inside = ~SPACES[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (_LETTERS[data[:-1]] & _PUNCTUATION[data[1:]])
        rows = offs[:-1][offs[:-1] < len(data)]
        first[rows] = inside[rows]
        lowered = LOWER[data]
        lowered[:-1] = np.where(data[1:] < 128, lowered[:-1], data[:-1])
        starts = np.flatnonzero(first)
        places = np.cumsum(inside, dtype=np.int32)
        ends = np.append(places[starts] - 1, places[-1] if len(places) else 0).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(lowered[inside]))
        return words, np.searchsorted(starts, offs)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The packed ids of every text; null counts as empty. Texts with a special token's string are encoded whole."""
        texts = pc.fill_null(texts, "")
        if not self.by_runs:
            return [np.array(x, self.kind).tobytes() for x in self._ids(texts.to_pylist())]
        whole = np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False)
        own = {int(i): np.array(self._ids([texts[i].as_py()])[0], self.kind).tobytes() for i in np.flatnonzero(whole)}
        if own:
            texts = pc.if_else(pa.array(whole), "", texts)
        runs, row = self._words(*text_buffers(texts))
        numbered = runs.dictionary_encode()
        words = numbered.dictionary.to_pylist()
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = words
        self._learn(new)
        known = [self.cache[w] for w in words]
        ends = np.cumsum([0, *map(len, known)]) // self.width
        at = numbered.indices.to_numpy()
        lo, hi = ends[at], ends[at + 1]
        ids = np.frombuffer(b"".join(known), self.kind)[ranges(lo, hi)].tobytes()
        cuts = (np.concatenate(([0], np.cumsum(hi - lo)))[row] * self.width).tolist()
        return [own.get(k, ids[i:j]) for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _written(folder: str, tokenizer_path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        own = encoder(tokenizer_path)
        end = np.array([end_id], f"<u{own.width}").tobytes()
        task = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        name = f"{root}/shard-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, index, at, n_tokens, first = None, [], 0, 0, None
        for batch in batches:
            _, offs = text_buffers(batch.column("text"))
            for a, b in pieces(offs, PART):
                part = batch.slice(a, b - a)
                ids = own.encode(part.column("text"))
                for doc_id, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    if out is None:
                        system.create_dir(root, recursive=True)
                        out, first = system.open_output_stream(f"{name}.rec"), doc_id
                    record = frame(head(doc_id, own.width) + x + end)
                    out.write(record)
                    index.append((doc_id or 0, at))
                    at += len(record)
                    n_tokens += len(x) // own.width + 1
        if out is not None:
            out.close()
            with system.open_output_stream(f"{name}.idx") as f:
                f.write(np.array(index, "<i8").tobytes())
            row = {"shard": task.partitionId(), "path": f"{folder}/{name.rpartition('/')[2]}.rec", "first_doc": first, "n_records": len(index), "n_tokens": n_tokens}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int64()), ("path", pa.string()), ("first_doc", pa.int64()), ("n_records", pa.int64()), ("n_tokens", pa.int64())]))

    return run


def parse(body: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, missing, short = _BODY.unpack_from(body)
    return None if missing else doc_id, np.frombuffer(body, "<u2" if short else "<u4", offset=_BODY.size).astype("<u4")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    names = ["doc_id", "start", "ids"]
    for batch in batches:
        for row in batch.to_pylist():
            system, path = fs.FileSystem.from_uri(row["path"])
            start, rows = row["base"], ([], [], [])
            with system.open_input_stream(path, buffer_size=1 << 20) as f:
                for body in frames(f.read):
                    doc_id, ids = parse(body)
                    for x, y in zip(rows, (doc_id, start, ids.tobytes()), strict=True):
                        x.append(y)
                    start += len(ids)
                    if len(rows[0]) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], names)
                        rows = ([], [], [])
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], names)


def write_records(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each shard written: shard, path, first_doc, n_records, n_tokens.

    Documents stand in ascending id order (nulls first, rows that share an id by their text). A null text counts as
    empty; each document ends with end_id. An empty table writes no file. Other columns are ignored.
    """
    dealt = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "shard long, path string, first_doc long, n_records long, n_tokens long"
    return kept(dealt.mapInArrow(_written(folder, tokenizer_path, end_id), schema), "shards")


def read_records(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit) of every record."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    based = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("path", "base")
    n = max(1, shards.count())
    return based.repartition(n, F.xxhash64("path")).mapInArrow(_read, "doc_id long, start long, ids binary")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for record_file in batch.column("path").to_pylist():
            system, path = fs.FileSystem.from_uri(record_file)
            with system.open_input_stream(path.removesuffix(".rec") + ".idx") as f:
                entries = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array([record_file] * len(entries), pa.string()), pa.array(entries[:, 0]), pa.array(entries[:, 1])], ["path", "doc_id", "at"])


def read_index(shards: DataFrame) -> DataFrame:
    """path, doc_id (0 for a null id) and byte offset (at) of every record, from the index files alone."""
    return shards.select("path").repartition(max(1, shards.count()), F.xxhash64("path")).mapInArrow(_index, "path string, doc_id long, at long")


def _seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        out, files = ([], []), {}
        for record_file, doc_id, at in zip(*(batch.column(k).to_pylist() for k in ("path", "doc_id", "at")), strict=True):
            if record_file not in files:
                system, path = fs.FileSystem.from_uri(record_file)
                files[record_file] = system.open_input_file(path)
            files[record_file].seek(at)
            own, ids = parse(next(frames(files[record_file].read), b"") or _damaged())
            if (own or 0) != doc_id:
                raise ValueError("index and records don't agree")
            out[0].append(own)
            out[1].append(ids.tobytes())
        for f in files.values():
            f.close()
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], ["doc_id", "ids"])


def _damaged() -> bytes:
    raise ValueError("index points beyond the records")


def read_shuffled(shards: DataFrame, seed: int) -> DataFrame:
    """doc_id and ids of every record, dealt out and ordered by a seeded hash of their places: tasks seek to records by the
    index, and a record that isn't the one that the index tells of is an error."""
    order = F.xxhash64("path", "at", F.lit(seed))
    dealt = read_index(shards).withColumn("order", order).repartition("order").sortWithinPartitions("order")
    return dealt.select("path", "doc_id", "at").mapInArrow(_seek, "doc_id long, ids binary")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
