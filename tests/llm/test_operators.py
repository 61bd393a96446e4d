"""Each operator against a brute-force version, on awkward rows and on the small tables."""

import base64
import collections
import hashlib
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ironsift.llm import quality_model, token_records
from ironsift.llm.compression_rules import quality_rules
from ironsift.llm.decontaminate import decontaminate
from ironsift.llm.main_text import extract_main_text, main_text
from ironsift.llm.ngram_join import similar_documents
from ironsift.llm.perspectives import rotate_perspectives
from ironsift.llm.piece_codec import CharacterMap, Normalizer, codec, encode_pieces
from ironsift.llm.quality_model import isotonic
from ironsift.llm.registry import ORACLES, QUERIES, tokenizer_file
from ironsift.llm.substring_dedup import dedup_word_runs
from ironsift.llm.suffix_dedup import dedup_bytes
from ironsift.llm.token_records import frame, frames, new_folder, read_index, read_records, read_shuffled, write_records
from tests.conftest import DATA
from tests.oracle import spark_rows, sql_rows

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{k % 97}{'é' * (k % 3)}" for k in range(9000))
BASE = " ".join(f"base{k}" for k in range(60))
ROWS = [
    (3, BASE, "x"), (1, BASE, "x"), (2, BASE + " tail words here", None), (4, None, "y"), (5, "", "y"), (6, "a b c", "z"), (7, "a b c", "z"), (8, "aaaa " * 400, "z"),
    (9, LONG, "l"), (10, "new start " + LONG[:4000], "l"), (11, "ÀÉÎ " * 60, "u"), (11, "other text under the same id " + BASE, "u"), (None, BASE, "n"), (12, " \n\t ", "s"), (6, "a b c", "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, kept string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def brute_words(rows):
    seen, out = {}, []
    named = [(i, WORD.findall(t or "")) for i, t, _ in rows]
    for i, w in named:
        for p in range(len(w) - 12):
            if i is not None:
                seen[tuple(w[p : p + 13])] = min(i, seen.get(tuple(w[p : p + 13]), i))
    for i, w in named:
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if i is not None and seen[tuple(w[p : p + 13])] < i:
                gone[p : p + 13] = [True] * 13
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def brute_bytes(rows):
    first, out = {}, []
    for i, t, _ in rows:
        b = (t or "").encode()
        for p in range(len(b) - 99):
            if i is not None:
                first[b[p : p + 100]] = min(i, first.get(b[p : p + 100], i))
    for i, t, _ in rows:
        b, own = (t or "").encode(), set()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            k = b[p : p + 100]
            if i is not None and (first[k] < i or k in own):
                gone[p : p + 100] = b"\1" * 100
            own.add(k)
        out.append((i, len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def test_word_runs(docs):
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in dedup_word_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted(brute_words(ROWS), key=repr)


def test_bytes(docs):
    got = [(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in dedup_bytes(docs).collect()]
    assert sorted(got, key=repr) == sorted(brute_bytes(ROWS), key=repr)


def test_small_batches_and_table(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        table = spark.read.parquet(f"{DATA}/documents.parquet")
        rows = [(r.doc_id, r.text, None) for r in table.collect()]
        got = {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept)) for r in dedup_bytes(table).collect()}
        assert got == {i: x for i, *x in [(i, (a, b, c)) for i, a, b, c in brute_bytes(sorted(rows))] for x in x}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_similar(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t, _ in ROWS:
        w = WORD.findall((t or "").translate(low))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    root = {i: i for i, _ in sets}
    for _ in sets:
        for i, a in sets:
            for j, b in sets:
                if None not in (i, j) and a and b and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(docs)[0].collect()]
    assert sorted(got, key=repr) == sorted(((i, len(s), root[i]) for i, s in sets), key=repr)


def test_decontaminate(spark, docs):
    items = spark.createDataFrame([(1, "Base3 base4, base5 base6 base7 base8 base9 base10 base11 base12 base13"), (2, "A b"), (3, None), (4, ""), (None, "w5 w6é"), (2, "a B")], "item_id long, text string")
    got = {(r.doc_id, r.text): (r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate(docs, items).collect()}
    assert len(got) == len({(i, t) for i, t, _ in ROWS})
    assert got[1, BASE][1:] == (11, ["1"], True) and got[None, BASE][1:] == (11, ["1"], True)
    assert got[6, "a b c"] == (3, 2, ["2"], True) and got[4, None] == (0, 0, [], False)
    assert decontaminate(docs, items.limit(0)).filter("contaminated").count() == 0


def test_rules(docs):
    for r in quality_rules(docs).collect():
        text = next(t or "" for i, t, _ in ROWS if i == r.doc_id and len((t or "").encode()) == r.n_bytes)
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        hit = {k + d for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for d in range(3)}
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and (not r.kept or not r.base_failed)


def test_pieces_without_spans(docs):
    assert encode_pieces(docs, tokenizer_file("piece_bpe_32k.model"), spans=False).count() == len(ROWS)


def character_map(entries):
    """A compiled character map: a double-array trie of the keys, and the strings that its leaves point at."""
    strings, at = b"", {}
    for key, text in entries.items():
        at[key.encode()] = len(strings)
        strings += text.encode() + b"\0"
    units, used = [0] * 4096, {0}

    def build(node, keys):
        """Places the children of a node, whose keys have their first bytes gone."""
        labels = sorted({k[0] for k, _ in keys if k} | ({0} if any(not k for k, _ in keys) else set()))
        base = next(x for x in range(1, 2000) if all(x ^ c not in used for c in labels))
        units[node] |= (base ^ node) << 10
        used.update(base ^ c for c in labels)
        for c in labels:
            if c == 0:
                units[base] = 1 << 31 | next(v for k, v in keys if not k)
                units[node] |= 1 << 8
            else:
                units[base ^ c] |= c
        for c in labels:
            if c:
                build(base ^ c, [(k[1:], v) for k, v in keys if k and k[0] == c])

    build(0, list(at.items()))
    table = np.array(units, "<u4")
    return np.array([table.nbytes], "<u4").tobytes() + table.tobytes() + strings


MAP = {"a": "bc", "ab": "q", "é": "e", "ﬁ": "fi", "\t": " ", "e\u0301": "é"}


def test_character_map():
    chars = CharacterMap(character_map(MAP))
    assert chars.longest(b"abc", 0) == (b"q", 2) and chars.longest(b"ac", 0) == (b"bc", 1) and chars.longest(b"xa", 0) is None
    text, places = Normalizer(chars, dummy_prefix=True, trim=True)("  xa é ")
    assert text == "▁xbc▁e" and places.tolist() == [0, 0, 0, 2, 3, 3, 4, 4, 4, 5, 8]


@pytest.mark.parametrize("trim", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
def test_model_with_a_character_map(tmp_path, prefix, trim):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.precompiled_charsmap = character_map(MAP)
    model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.remove_extra_whitespaces = prefix, trim
    (tmp_path / "mapped.model").write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "mapped.model"))
    texts = ["", "a cab in the ﬁeld", "é e\u0301 tab\there", "  two  blanks  ", "abab aab", "line\n\nbreak", "🙂 a"]
    for text, packed, plain, (_, places), sizes in zip(texts, *codec(str(tmp_path / "mapped.model")).encode(texts), strict=True):
        own = np.frombuffer(packed, "<i4")
        assert own.tolist() == library.encode(text), text
        assert plain == library.decode(own.tolist()), text
        if own.size:
            starts, ends = codec(str(tmp_path / "mapped.model")).spans(places, sizes)
            assert starts[1:].tolist() == ends[:-1].tolist() and ends[-1] == len(text.encode())


def test_records(spark, docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    got = read_records(write_records(docs, tokenizer_file("word_bpe_49k.json"), 2, new_folder(spark))).orderBy("start").collect()
    want = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t, _ in ROWS]
    assert sorted(bytes(r.ids) for r in got) == sorted(want)
    assert [r.start for r in got] == np.cumsum([0, *(len(r.ids) // 4 for r in got[:-1])]).tolist()
    assert [r.doc_id or 0 for r in got] == sorted(i or 0 for i, _, _ in ROWS)
    assert read_records(write_records(empty, tokenizer_file("word_bpe_49k.json"), 2, new_folder(spark))).count() == 0
    data = frame(b"abc") + frame(b"")
    read = lambda d: (lambda f: list(frames(f.read)))(__import__("io").BytesIO(d))
    assert read(data) == [b"abc", b""]
    for bad in (data[:12] + b"x" + data[13:], data[:5], data[:-1], data + b"\0"):
        with pytest.raises(ValueError):
            read(bad)


def test_index(spark, docs, empty):
    path = tokenizer_file("word_bpe_49k.json")
    shards = write_records(docs, path, 2, new_folder(spark))
    whole = sorted((r.doc_id or 0, bytes(r.ids)) for r in read_records(shards).collect())
    assert sorted((r.doc_id or 0, bytes(r.ids)) for r in read_shuffled(shards, 7).collect()) == whole
    orders = [[r.doc_id for r in read_shuffled(shards, k).coalesce(1).collect()] for k in (7, 7, 8)]
    assert orders[0] == orders[1] != orders[2]
    index = read_index(shards)
    assert index.count() == len(ROWS) == shards.agg(F.sum("n_records")).first()[0]
    assert read_shuffled(write_records(empty, path, 2, new_folder(spark)), 1).count() == 0
    moved = index.withColumn("doc_id", F.col("doc_id") + 1)
    with pytest.raises(Exception, match="don't agree"):
        moved.select("path", "doc_id", "at").mapInArrow(token_records._seek, "doc_id long, ids binary").collect()


def test_other_tokenizers_encode_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    other, known = (token_records.WordEncoder(tokenizer_file(x)) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    assert known.by_runs and not other.by_runs
    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    texts = ["Hello  world", "", "a\n b", LONG[:500]]
    assert other.encode(pa.array([*texts, None])) == [np.array(library.encode(t, add_special_tokens=False).ids, other.kind).tobytes() for t in [*texts, ""]]


def test_perspectives(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 1, "system", "rule"), (1, 2, None, "x"), (2, 0, "system", "only"), (None, 0, "ann", "lost")]
    got = {(r.conv_id, r.speaker): r for r in rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {(1, "ann"), (1, "bob")}
    r = got[1, "ann"]
    assert r.text == "<|assistant|>\nhi<|end|>\n<|user name=bob|>\n<|end|>\n<|system|>\nrule<|end|>\n<|user name=unknown|>\nx<|end|>\n"
    a, b = map(int, r.mask.split("-"))
    assert r.text[a:b] == "hi<|end|>\n" and r.n_target_chars == b - a


def test_main_text(spark):
    page = '<nav><a href=x>Home of the and</a></nav><article><h1>T&amp;t</h1><p>Short.<p>The cat is in the house and it was on the mat <b>with</b> a hat.<div class="comments"><p>the best of all in the world and more of it</div></article><footer>the end of it</footer>'
    assert main_text(page) == "T&t\nShort.\nThe cat is in the house and it was on the mat with a hat."
    assert [(r.text, r.n_chars) for r in extract_main_text(spark.createDataFrame([(1, "u", None)], "page_id long, url string, html string")).collect()] == [("", 0)]


def test_isotonic():
    assert isotonic(np.array([1.0, 3.0, 2.0, 4.0]), np.ones(4)).tolist() == [1, 2.5, 2.5, 4]


def test_quality(spark):
    out = QUERIES["op4_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    assert len(out) == 1000 and np.mean([a == b for a, b in held]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def test_fit_is_ridge_of_all_rows(spark):
    """Weights against one system solved from all training rows, and the curve against their bins."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abc de.\n"), n)) for n in rng.integers(0, 400, 300)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (7, texts[3]), (301, None), (302, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, float(len(t) > 150)) for k, t in enumerate(texts)] + [(5, 1.0), (6, None), (8, 9.0), (None, 1.0)], "doc_id long, label double")
    measured = docs.mapInArrow(quality_model._measured, "doc_id long, " + ", ".join(f"{c} double" for c in quality_model.FEATURES))
    model = quality_model.fit(measured, labels)
    frame = measured.toPandas()
    known = labels.toPandas().query("label in (0, 1) and doc_id == doc_id").groupby("doc_id").label.mean()
    frame = frame[frame.doc_id.isin(known.index)]
    fold = frame.doc_id.map(lambda x: zlib.crc32(str(int(x)).encode()) % 4)
    train = frame[fold < 2]
    z, y = model.fourier(train[quality_model.FEATURES].to_numpy()), known[train.doc_id].to_numpy()
    penalty = np.diag(np.append(np.full(quality_model.N_FOURIER, quality_model.RIDGE * len(z) / quality_model.N_FOURIER), 1e-9 * len(z)))
    assert np.allclose(model.fourier(frame[quality_model.FEATURES].to_numpy()) @ np.linalg.solve(z.T @ z + penalty, z.T @ y), model.fourier(frame[quality_model.FEATURES].to_numpy()) @ model.weights, atol=1e-5)
    assert (np.diff(model.curve[1]) >= 0).all()
    out = quality_model.score_quality(docs, labels.withColumnRenamed("label", "quality")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (301, 302)}) == 1 and not next(r for r in out if r.doc_id is None).held_out
    none = quality_model.score_quality(docs, labels.limit(0).withColumnRenamed("label", "quality")).collect()
    assert {round(r.score, 1) for r in none} == {0.5}


def test_repeated_rows_and_clashing_names(spark):
    rows = [(1, 0, "ann", "hi"), (1, 0, "ann", "hi"), (1, 1, "bob", "yo")]
    got = {r.speaker: r for r in rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS place", "2 AS segment", "3 AS body")).collect()}
    assert (got["ann"].n_turns, got["ann"].n_target_turns, got["bob"].n_target_turns) == (3, 2, 1)
    page = "<p>The cat is in the house and it was on the mat with a hat.</p>"
    pages = spark.createDataFrame([(1, "u", page), (1, "u", page), (None, None, ""), (2, "v", page * 3000)], "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    assert sorted(r.n_chars for r in extract_main_text(pages).collect()) == [0, 57, 57, 3000 * 58 - 1]
    docs = spark.createDataFrame([(1, BASE), (2, None)], "doc_id long, text string").selectExpr("*", "1 AS label", "2 AS spans", "3 AS holder", "4 AS items", "5 AS start", "6 AS place", "7 AS kept", "8 AS bits", "9 AS fold")
    items = spark.createDataFrame([(1, BASE)], "item_id long, text string").selectExpr("*", "1 AS n", "2 AS words")
    for df in (dedup_word_runs(docs), dedup_bytes(docs), quality_rules(docs), similar_documents(docs)[0], decontaminate(docs, items), encode_pieces(docs, tokenizer_file("piece_bpe_32k.model")), read_records(write_records(docs, tokenizer_file("word_bpe_49k.json"), 2, new_folder(spark)))):
        assert df.count() == 2


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for f in (dedup_word_runs, dedup_bytes, quality_rules, lambda x: decontaminate(x, items), lambda x: encode_pieces(x, tokenizer_file("piece_bpe_32k.model")), lambda x: quality_model.score_quality(x, labels)):
        assert f(empty).count() == 0
    assert similar_documents(empty)[0].count() == 0
    assert rotate_perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    whole = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, whole, DATA).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, DATA)) == sql_rows(ORACLES[name], DATA)


def test_pipeline(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    rows = QUERIES["pipeline"](spark, DATA).collect()
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    text = {r.doc_id: r.text for r in table.collect()}
    kept = {r.doc_id for r in QUERIES["op8_quality_rules"](spark, DATA).collect() if r.kept}
    first = {r.doc_id for r in similar_documents(table.filter(table.doc_id.isin(list(kept))))[0].collect() if r.doc_id == r.component_id}
    left = {i: k for i, _, _, k in brute_words([(i, text[i], None) for i in sorted(first)]) if k}
    bad = {r.doc_id for r in decontaminate(spark.createDataFrame(list(left.items()), "doc_id long, text string"), spark.read.parquet(f"{DATA}/benchmark.parquet")).filter("contaminated").collect()}
    want = {i: hashlib.sha256(",".join(map(str, library.encode(k))).encode()).hexdigest() for i, k in left.items() if i not in bad}
    assert {r.doc_id: r.ids_sha256 for r in rows} == want


def test_pipeline_stages_on_awkward_rows(spark):
    prose = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    passage = next(r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() if len(r.text.split()) > 9)
    more = [(i, x, None) for k, x in enumerate(prose) for i in (None, 20 + k // 2)] + [(11, f"{prose[0]} {passage}", None), (None, f"{prose[1]} {passage}", None)]
    rows = [(i, t, f"lang {k}", f"source {k}", len(t or "")) for k, (i, t, _) in enumerate(ROWS + more)]
    alone = spark.createDataFrame([(k, r[1]) for k, r in enumerate(rows)], "doc_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    run = lambda stage: sorted(map(tuple, stage(spark, docs, DATA).collect()), key=repr)
    want = lambda stay: sorted((rows[k] for k in stay), key=repr)

    good = {r.doc_id for r in quality_rules(alone).filter("kept").collect()}
    assert {rows[k][0] for k in good} & {rows[k][0] for k in set(range(len(rows))) - good} - {None} and any(rows[k][0] is None for k in good)
    assert run(corpus_pipeline.keep_good) == want(good)

    bad = {r.doc_id for r in decontaminate(alone, spark.read.parquet(f"{DATA}/benchmark.parquet")).filter("contaminated").collect()}
    assert {len(rows) - 1, len(rows) - 2} <= bad and ROWS.index((11, "ÀÉÎ " * 60, "u")) not in bad
    assert run(corpus_pipeline.drop_contaminated) == want(set(range(len(rows))) - bad)

    left = [(i, w, *r[2:4], len(w)) for r, (i, _, _, w) in zip(rows, brute_words([r[:3] for r in rows]), strict=True) if w]
    assert run(corpus_pipeline.drop_repeats) == sorted(left, key=repr)

    root = {r.doc_id: r.component_id for r in similar_documents(docs)[0].collect()}
    assert run(corpus_pipeline.keep_one_of_each) == want(k for k, r in enumerate(rows) if r[0] is None or root[r[0]] == r[0])


def test_main_text_by_density():
    good = ["The cat is in the house and it was on the mat with a hat.", "A dog of the house is at the door and it was not in by day."]
    dull = "Wood iron copper silver gold tin lead zinc nickel chrome cobalt."
    body = "".join(f"<div>{x}</div>" for x in good)
    teaser = "<article><h3>Other story</h3></article>"
    assert main_text(f"<h1>Title</h1>{body}{teaser}") == main_text(f"<h1>Title</h1>{body}") == "\n".join(["Title", *good])
    assert main_text(f"<article><h1>T</h1><p>{good[1]}</p><h2>More</h2><p>End.</p></article><div>{good[0]}</div><div>Cart</div>") == "\n".join(["T", good[1], "More", "End.", good[0]])
    links = "<p><a href=x>All of the other stories that we have for you in the archive</a></p>"
    assert main_text(f"<article>{links}<p>{dull}</p>{links}<p>Short.</p>{links}<p>{good[0]}</p></article>") == good[0]
    assert main_text(f"<article><h1>T</h1><p>{dull}</p></article><div>Cart</div>") == f"T\n{dull}"


def test_piece_spans(spark):
    import sentencepiece

    model = tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    for text, normal in zip(["", " a  b", "é▁\n"], codec(model).encode(["", " a  b", "é▁\n"])[2], strict=True):
        assert normal[0] == ("▁" + text.replace(" ", "▁") if text else "") and len(normal[1]) == len(normal[0].encode()) + 1
    encoded = encode_pieces(table, model).select("doc_id", "ids", "starts", "ends", F.xxhash64("starts", "ends").alias("digest")).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in table.collect()}
    assert len(encoded) == len(texts)
    for r in encoded:
        assert r.starts[1:] == r.ends[:-1] and (not r.ids or (r.starts[0], r.ends[-1]) == (0, len(texts[r.doc_id])))
        for k, (i, a, b) in enumerate(zip(r.ids, r.starts, r.ends, strict=True)):
            source, piece = texts[r.doc_id][a:b], library.id_to_piece(i)
            assert source == bytes([int(piece[3:5], 16)]) if library.is_byte(i) else "▁" * (k == 0) + source.decode().replace(" ", "▁") == piece
    digests = {r.doc_id: r.digest for r in encoded}
    assert {r.doc_id: r.spans_xxhash64 for r in QUERIES["op9_sentencepiece"](spark, DATA).collect()} == digests
    assert "spans_xxhash64" in corpus_pipeline.encode(spark, table, DATA).columns


def test_rules_on_tails_and_encoded_text(spark):
    rng = random.Random(7)
    table = quality_rules(spark.read.parquet(f"{DATA}/documents.parquet"), carry=("text",)).filter("kept AND n_bytes > 1000 AND ratio > 0.42").collect()
    prose = " ".join(r.text for r in sorted(table, key=lambda r: r.doc_id) if r.text.isascii())[:28672]
    assert len(prose) == 28672
    sentence = "This sentence is the same as the one before it. "
    base64_of = lambda n: base64.encodebytes(rng.randbytes(n)).decode()
    printable = "".join(rng.choice(string.ascii_letters + string.digits + string.punctuation + " ") for _ in range(4095))
    texts = [prose, prose[:27001], prose + (sentence * 90)[:4095], prose + (sentence * 90)[:1000], prose + printable, prose + base64_of(1500), base64_of(60_000), base64_of(6000), "\n".join(rng.randbytes(32).hex() for _ in range(1200))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.reason for r in quality_rules(docs).collect()}
    assert got[0] is None and got[1] is None
    assert all(got[k] for k in range(2, len(texts))), got


def test_pieces_of_every_row(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    texts = [t for _, t, _ in ROWS] + [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    texts += ["  two blanks  first and last  ", "\n\n line\n\n\nbreaks \n \t tabs\r\n", "▁ literal ▁▁ marks▁", " ▁", "🙂 ́e​", "a" * 300]
    rows = encode_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), tokenizer_file("piece_bpe_32k.model")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == library.encode(text), text[:80]
        assert r.decoded == library.decode(list(r.ids)), text[:80]
