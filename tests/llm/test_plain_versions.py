"""Second, plain versions of operators that SQL can't express, over whole small tables."""

import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ironsift.llm import main_text as rules
from ironsift.llm.compression_rules import quality_rules
from ironsift.llm.main_text import extract_main_text, main_text
from ironsift.llm.piece_codec import codec
from ironsift.llm.registry import QUERIES, tokenizer_file
from tests.conftest import DATA

WORD = re.compile(r"[^\x20\x09-\x0d]+")


class Plain(HTMLParser):
    """The blocks of a well-formed page, from the events of the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.found, self.text, self.linked = [], [], "", 0
        self.link = self.heading = False
        self.skipped = None

    def end_block(self):
        if self.text.split():
            excluded = any(x for _, x in self.open)
            content = any(t in rules.CONTENT for t, _ in self.open)
            self.found.append({"text": " ".join(self.text.split()), "linked": self.linked, "excluded": excluded, "content": content, "heading": self.heading, "good": None})
        self.text, self.linked = "", 0

    def marked(self, tag, attrs, in_content):
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role", "aria-label")).replace("_", "-")
        unseen = any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and re.search(r"display\s*:\s*none", v or "")) for k, v in attrs)
        kind = tag in rules.BOILERPLATE or (tag == "header" and not in_content)
        return kind or unseen or (tag not in ("body", "html", "main") and bool(rules._MARKED.search(names)))

    def handle_starttag(self, tag, attrs):
        if self.skipped:
            return
        if tag in rules.SILENT:
            self.skipped = tag
            return
        if tag == "br":
            self.text += " "
            return
        if tag == "a":
            self.link = True
        inside = any(t in rules.CONTENT for t, _ in self.open)
        if tag in rules.BLOCKS or tag in rules.BOILERPLATE:
            self.end_block()
            self.link, self.heading = False, tag in rules.HEADINGS
            if tag in rules.VOID:
                return
            if tag == "p" and self.open and self.open[-1][0] == "p":
                self.open.pop()
            self.open.append((tag, self.marked(tag, attrs, inside)))
        elif tag not in rules.VOID and self.marked(tag, attrs, True):
            self.end_block()
            self.open.append((tag, True))

    def handle_endtag(self, tag):
        if self.skipped:
            self.skipped = None if tag == self.skipped else self.skipped
            return
        if tag == "a":
            self.link = False
        known = any(t == tag for t, _ in self.open)
        if tag in rules.BLOCKS or tag in rules.BOILERPLATE:
            self.end_block()
            self.link = self.heading = False
        elif known:
            self.end_block()
        if known:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not self.skipped:
            self.text += data
            if self.link:
                self.linked += len("".join(data.split()))


def plain_text(page):
    parser = Plain()
    parser.feed(page or "")
    parser.close()
    parser.end_block()
    found = [b for b in parser.found if not b["excluded"]]
    for b in found:
        words = re.findall(r"[^\W\d_]+", b["text"].lower())
        if b["linked"] * 2 > len(b["text"].replace(" ", "")):
            b["good"] = False
        elif not b["heading"] and len(words) >= 10 and sum(w in rules.STOP_WORDS for w in words) >= 0.15 * len(words):
            b["good"] = True
    known = any(b["good"] for b in found)
    count = lambda inside: sum(len(b["text"].split()) for b in found if b["content"] == inside and (b["good"] is True if known else b["good"] is None))
    if count(True) > count(False):
        found = [b for b in found if b["content"] or b["good"]]
        if not known:
            for b in found:
                b["good"] = b["good"] is None
    decided = [b["good"] for b in found]
    labels = list(decided)
    for k in reversed(range(len(found))):
        if decided[k] is None:
            if found[k]["heading"]:
                labels[k] = bool(k + 1 < len(found) and labels[k + 1])
            else:
                left = next((x for x in reversed(decided[:k]) if x is not None), None)
                right = next((x for x in decided[k + 1 :] if x is not None), None)
                labels[k] = left is not False and right is not False and bool(left or right)
    return "\n".join(b["text"] for b, good in zip(found, labels, strict=True) if good)


@pytest.mark.parametrize("folder", [DATA, "/root/testdata/sf0.01"])
def test_pages_by_a_second_extractor(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = {r.page_id: r.text for r in QUERIES["op5_html_extraction"](spark, folder).collect()}
    assert got == {r.page_id: plain_text(r.html) for r in pages}
    assert sum(map(len, got.values())) > 1000 * len(pages) / 2


LINE = "The text of this page is here for all of them to read and it has the words that a text has."


@pytest.mark.parametrize("page", [
    f'<p class="x>{LINE}', f"<p class='x>{LINE}</p>", f'<p title="a > b">{LINE}</p>', f"<p {LINE[:0]}>{LINE}", f"<p/>{LINE}", f"<p\n class=x\n>{LINE}</p >", f"</div></p>{LINE}</b>", f"<!-- <p> -->{LINE}<!-- never closed", f"<!DOCTYPE html><?xml x?>{LINE}",
    f"<P CLASS=x>{LINE}</P>", f"<p class=x\">{LINE}", f"<p class>{LINE}", f"<p><b>{LINE}</i></p>", f"<p data-x='\"'>{LINE}</p>", f"{LINE}<script>x('</p>')", f"{LINE}<p class=\"x", f"<p =\"\">{LINE}", f"<p x='1'y=\"2\">{LINE}", f"<p>{LINE}<p",
])
def test_malformed_tags(page):
    assert main_text(page) == LINE


def test_broken_references_and_stray_signs():
    assert main_text(f"<p>1 < 2 &amp; 3 &gt 2 &nosuch; {LINE}</p>") == f"1 < 2 & 3 > 2 &nosuch; {LINE}"


def test_empty_and_null_pages(spark):
    rows = spark.createDataFrame([(1, "u", None, 1), (None, None, "", 2)], "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in extract_main_text(rows).collect()) == [(0, "", 0), (1, "", 0)]
    assert extract_main_text(rows.limit(0)).collect() == []


def test_base_counts_of_every_row(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, DATA).collect()}
    assert got.keys() == texts.keys() and any(r.n_symbols for r in got.values())
    whole = {r.doc_id: r.kept for r in quality_rules(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    for i, text in texts.items():
        words = WORD.findall(text)
        assert got[i].n_words == len(words) and got[i].word_chars == sum(map(len, words))
        assert got[i].n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert got[i].base_failed == (len(words) < 50 or 100 * got[i].n_repeat_words > 50 * len(words))
        assert got[i].kept == whole[i] and not (got[i].kept and got[i].base_failed)


def test_token_records_of_the_whole_table(spark):
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op10_token_records"](spark, DATA).collect()}
    start = 0
    for (i, _), encoded in zip(rows, library.encode_batch([x for _, x in rows], add_special_tokens=False), strict=True):
        ids = np.array([*encoded.ids, 2], "<u4")
        assert got.pop(i) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_pieces_of_a_model_without_bytes(tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    for piece in model.pieces:
        if piece.type == piece.BYTE:
            piece.type = piece.UNUSED
    model.trainer_spec.byte_fallback = False
    path = tmp_path / "plain.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    own = codec(str(path))
    for text in ["", "plain", "a \U00016100\U00016101 b", "\U00016100", "x\U0001f9ffy\nz  \U00016100"]:
        (packed,), (decoded,), ((_, places),), (sizes,) = own.encode([text])
        ids = np.frombuffer(packed, "<i4")
        assert ids.tolist() == library.encode(text)
        assert decoded == library.decode(ids.tolist())
        starts, ends = own.spans(places, sizes)
        assert starts.tolist()[1:] == ends.tolist()[:-1] and (not len(ids) or (starts[0], ends[-1]) == (0, len(text.encode())))
