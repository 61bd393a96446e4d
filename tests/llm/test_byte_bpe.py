"""Byte-level BPE against the tiktoken library, and its parts by themselves."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from ironsift.llm import byte_bpe
from ironsift.llm.arrowtext import U, text_buffers
from ironsift.llm.byte_bpe import PerfectHash, encode_ranked, ranks_of
from ironsift.llm.registry import QUERIES, tokenizer_file
from tests.conftest import DATA

PATH = tokenizer_file("byte_bpe_multi_50k.tiktoken")
ALPHABET = ["a", "b", "s", "t", "re", "ve", "ll", "m", "d", "'", "'", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", "　", "1", "²", "é", "ß", "漢", "😀", ".", ",", "#", "​", "́", "Ⅷ", "_", "͸"]


@pytest.fixture(scope="module")
def library():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(PATH).ranks, special_tokens={})


def encoded(texts):
    own = ranks_of(PATH)
    data, offs = text_buffers(pa.array(texts, pa.string()))
    ids, at = own.encode(data, offs)
    assert own.decode(ids)[0].tobytes() == data.tobytes()
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_random_texts(library):
    pick = random.Random(4)
    texts = ["".join(pick.choice(ALPHABET) for _ in range(pick.randrange(30))) for _ in range(5000)]
    assert encoded(texts) == [library.encode_ordinary(x) for x in texts]


def test_every_character(library):
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    texts = [every[i : i + 4000] for i in range(0, len(every), 4000)]
    assert encoded(texts) == [library.encode_ordinary(x) for x in texts]


def test_long_tokens(library):
    texts = ["a" * 50_000, "ab" * 20_000, " " * 9000 + "x", "\n" * 4000, "don't" * 3000, ""]
    assert encoded(texts) == [library.encode_ordinary(x) for x in texts]


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "MEMORY", 3)
    texts = [f"qzx{k % 7} wvu{k % 5}" for k in range(60)]
    assert encoded(texts) == [library.encode_ordinary(x) for x in texts]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64))
    own = PerfectHash(keys)
    assert sorted(own.slots(keys).tolist()) == list(range(len(keys)))
    assert PerfectHash(np.zeros(0, U)).slots(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        PerfectHash(np.zeros(2, U))


def test_rank_file_without_a_byte(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.Ranks(str(tmp_path / "ranks"))


def test_odd_rows(spark):
    rows = [(1, "a b", 5), (None, "a b", 6), (1, "a b", 5), (2, None, 7), (3, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted(((r.doc_id or 0, len(r.ids), bytes(r.decoded)) for r in encode_ranked(docs, PATH).collect()), key=repr)
    assert got == [(0, 2, b"a b"), (1, 2, b"a b"), (1, 2, b"a b"), (2, 0, b""), (3, 0, b"")]
    assert encode_ranked(docs.limit(0), PATH).collect() == []


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = QUERIES["op12_byte_bpe"](spark, DATA).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
