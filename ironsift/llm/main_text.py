"""HTML extraction: the main text of pages by two passes of block rules.

Method: a page is cut into blocks at block-level tags. The first pass decides blocks by their density of stop
words, their length, the share of their characters inside links, and by the kind of element they stand in
(menus, forms and the like are never main text). Short blocks stay open, and long ones with few stop words. The
second pass gives open blocks the label of the nearest decided neighbours on either side, and headings that of the
block after them. Where article and main elements hold most of the good words, open blocks outside are no text and
no neighbours; good ones outside stay. Only a page without any good block takes the open blocks of these elements,
if they hold most of its open words.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    "the of and to a in is it that for was on as with be by are this from at or an have not which but his her they you we he she its were been their has "
    "de la le et les des un une en du que est pour dans qui par sur au avec ce il elle ne pas plus sont se aux ou mais leur nous vous "
    "der die das und ist von zu den mit sich auf für nicht ein eine dem im es auch als an werden aus er hat dass sie nach wird bei noch wie einer um am sind oder "
    "el los las y es por con para una del al lo como más pero sus su son entre cuando muy sin sobre también me hasta hay donde quien desde todo nos".split()
)
# Elements by their role in a page.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
SILENT = frozenset("script style noscript template svg math iframe object textarea select head canvas audio video".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button fieldset label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset("article main".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:"[^"]*"|'[^']*'|[^>"'])*(?:["'][^>]*)?)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_MARKED = re.compile(
    r"\b(?:ads?|adverts?|advertisement|advertising|banner|sponsored|sponsor|promo|promotion|sidebar|side-bar|comments?|commentlist|disqus|replies|respond|cookies?|consent|gdpr|notice|alert|popup|pop-up|modal|overlay|newsletter|subscribe|subscription|signup|share|sharing|social|related|recommended|breadcrumbs?|navbar|nav|navigation|menu|footer|masthead|site-header|toolbar|pagination|pager|copyright|login|search|widget|tags)\b",
    re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_UNSEEN = re.compile(r"""aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_FLAG = re.compile(r"(?<![-\w])hidden(?![-\w])", re.I)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
_WORD = re.compile(r"[^\W\d_]+")

LONG_WORDS = 10
STOP_DENSITY = 0.15
LINK_DENSITY = 0.5


@dataclass
class Block:
    text: str
    link_chars: int
    excluded: bool
    content: bool
    heading: bool
    good: bool | None = None


def _excluded(tag: str, attributes: str, in_content: bool) -> bool:
    """Whether an element holds no main text: by its kind, its names, or because it isn't shown."""
    if tag in BOILERPLATE or (tag == "header" and not in_content):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or "display" in attributes:
        if _UNSEEN.search(attributes) or _FLAG.search(_QUOTED.sub("", attributes)):
            return True
    names = " ".join(x[2].strip("\"'") for x in _ATTRIBUTE.finditer(attributes))
    return tag not in ("body", "html", "main") and bool(_MARKED.search(names.replace("_", "-")))


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, excluded, content
    text: list[tuple[str, bool]] = []
    links, heading, at = 0, False, 0

    def flush() -> None:
        whole = "".join(x for x, _ in text)
        linked = sum(len("".join(html.unescape(x).split())) for x, in_link in text if in_link)
        text.clear()
        clean = " ".join(html.unescape(whole).split())
        if clean:
            _, excluded, content = stack[-1] if stack else ("", False, False)
            out.append(Block(clean, linked, excluded, content, heading))

    for start, end, closing, tag, attributes in _tags(page):
        if start > at:
            text.append((page[at:start], links > 0))
        at = end
        if not tag:
            continue
        if tag == "br":
            text.append((" ", False))
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag not in BLOCKS and tag not in BOILERPLATE:
            if not closing and tag not in VOID and _ATTRIBUTE.search(attributes) and _excluded(tag, attributes, True):
                flush()
                stack.append((tag, True, bool(stack and stack[-1][2])))
            elif closing and any(x[0] == tag for x in stack):
                flush()
                while stack and stack.pop()[0] != tag:
                    pass
            continue
        flush()
        links = 0
        heading = tag in HEADINGS and not closing
        if tag in VOID:
            continue
        if closing:
            if any(x[0] == tag for x in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag == "p" and stack and stack[-1][0] == "p":
            stack.pop()
        _, excluded, content = stack[-1] if stack else ("", False, False)
        stack.append((tag, excluded or _excluded(tag, attributes, content), content or tag in CONTENT))
    if at < len(page):
        text.append((page[at:], links > 0))
    flush()
    return out


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, end, whether it closes, name and attributes of tags; comments and silent elements have no name."""
    at = 0
    while m := _TOKEN.search(page, at):
        tag, at = (m[2] or "").lower(), m.end()
        if tag in SILENT and not m[1]:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at) if not m[3].endswith("/") else m
            at = end.end() if end else len(page)
            tag = ""
        yield m.start(), at, bool(m[1]), tag, m[3] or ""


def _first_pass(block: Block) -> bool | None:
    if block.excluded:
        return False
    n_chars = len(block.text.replace(" ", ""))
    if block.link_chars > LINK_DENSITY * n_chars:
        return False
    if block.heading:
        return None
    words = [x.lower() for x in _WORD.findall(block.text)]
    if len(words) < LONG_WORDS:
        return None
    return True if sum(x in STOP_WORDS for x in words) >= STOP_DENSITY * len(words) else None


def main_text(page: str | None) -> str:
    """The blocks of main text, joined by newlines."""
    found = [b for b in blocks(page or "") if not b.excluded]  # what stands apart from the text is no neighbour
    n_words: Counter[tuple[bool | None, bool]] = Counter()
    for b in found:
        b.good = _first_pass(b)
        n_words[b.good, b.content] += len(b.text.split())
    label = True if any(b.good for b in found) else None
    if n_words[label, True] > n_words[label, False]:  # the page says where most of its text is
        found = [b for b in found if b.content or b.good]
        if label is None:
            for b in found:
                b.good = b.good is None
    before: list[bool | None] = []
    last = None
    for b in found:
        before.append(last)
        last = b.good if b.good is not None else last
    last, follows = None, False
    for b, left in zip(reversed(found), reversed(before), strict=True):
        right = last
        if b.good is not None:
            last = b.good
        elif b.heading:
            b.good = follows
        else:
            b.good = left is not False and right is not False and bool(left or right)
        follows = b.good
    return "\n".join(b.text for b in found if b.good)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array([main_text(x) for x in part.column("html").to_pylist()], pa.string())], ["page_id", "url", "text"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, row by row.

    A null or empty page has an empty text, an empty table gives an empty one; null and repeated ids or urls are carried along. Unclosed or stray
    tags are tolerated; a quote that nothing closes ends with its tag. A page is one record whatever its length. Other columns are ignored.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    out = rows.mapInArrow(_extracted, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
