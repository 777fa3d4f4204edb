"""Operator 6: main-text extraction from raw HTML by two-pass block rules.

The page is cut into blocks at block-level tags; inline tags stay inside a
block, scripts, styles and other non-text elements are skipped. The first pass labels a
block from its length, its share of stop words, its share of linked
characters and the element it sits in (menus, headers, footers, sidebars,
notices, adverts, forms, comments are boilerplate, by element or by name; an explicit article or main
element speaks for text, and names and forms that only lay out the page around it end there). Short blocks that these rules leave open inherit in
the second pass: the label of the nearest decided neighbours, where both
sides agree or one is nearer; at equal distance the preceding one decides.

Edge cases: null or empty html, or a page with no block of text, gives an
empty text; unclosed and stray tags, comments and quotes are tolerated;
repeated rows are independent; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import small_batches, text_column

# Frequent function words of the supported languages (a parameter of the rules).
STOP_WORDS = frozenset(
    """the of and to in a is that for it on was as with be by are this at an from or not
    der die und das den von zu mit ein ist im auf für des dem nicht sich eine auch es
    le la les de et des en un une du que qui est dans pour au pas sur ce par avec
    el los las y del que en un una por con para se no es su al lo como""".split()
)
# Elements whose content is never text.
SKIPPED = frozenset("script style noscript template iframe object svg math canvas audio video head title textarea select option datalist".split())
# Elements that hold boilerplate wherever they stand.
BOILERPLATE = frozenset("nav header footer aside form menu dialog button fieldset".split())
TEXT_REGIONS = frozenset("article main".split())
# Elements that end the block before them and the one inside them.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
# Elements whose end tag closes what is open inside them.
SCOPES = frozenset("article aside blockquote button details dialog div dl fieldset figure footer form header li main menu nav ol section table td th tr ul".split())
# Words of class, id and role values that name boilerplate.
HINTS = frozenset(
    """ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments contentinfo cookie cookies
    consent disclaimer disqus footer header masthead menu menubar modal nav navbar navigation newsletter notice notices popup promo
    promoted promotion related recommended respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget
    complementary search""".split()
)
# Of these, names that keep their meaning around an article element (a reader's comment may be an article of its own);
# the others name the layout of a page when an article or main element lies inside, and end there.
LASTING = frozenset(
    """ad ads advert adverts advertisement advertising comment comments disqus promo promoted promotion related recommended respond
    sponsor sponsored""".split()
)
# First words of class names that state a fact about the page, not what the element is.
FLAGS = frozenset("has no with without is not hide hidden show".split())
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <[!?][^>]*> | <(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)> | <(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<attrs2>[^>]*)>""",
    re.S | re.X,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HINT_WORDS = re.compile(r"[a-z]+")


def hints_of(attrs: str) -> set[str]:
    """Boilerplate words among the class, id and role names; names that only state a fact (``has-sidebar``) don't count."""
    out: set[str] = set()
    for name in " ".join(filter(None, sum(NAMED.findall(attrs), ()))).lower().split():
        words = HINT_WORDS.findall(name)
        if words and words[0] not in FLAGS:
            out.update(HINTS.intersection(words))
    return out


GOOD, BAD, OPEN = 1, 0, -1


@dataclass(frozen=True)
class BlockRules:
    short: int = 70             # characters: shorter blocks are left open
    long: int = 200             # characters: a long block with stop words is text
    stop_low: float = 0.1
    stop_high: float = 0.2
    link_share: float = 0.4     # above: a list of links


@dataclass
class Block:
    text: str
    linked: int
    boilerplate: bool
    region: bool


def blocks_of(page: str) -> Iterator[Block]:
    # (element, boilerplate for good, boilerplate up to an article or main element, text region), cumulative
    scopes: list[tuple[str, bool, bool, bool]] = []
    endless: set[str] = set()                       # skipped elements that have no end tag any more
    parts: list[str] = []
    linked = link_depth = at = 0

    def block() -> Block | None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        out = None
        if text:
            top = scopes[-1] if scopes else ("", False, False, False)
            out = Block(text, linked, top[1] or top[2], top[3])
        parts, linked = [], 0
        return out

    def take(raw: str) -> None:
        nonlocal linked
        if raw:
            s = entities.unescape(raw) if "&" in raw else raw
            parts.append(s)
            if link_depth:
                linked += len(" ".join(s.split()))

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            take(page[at:])
            break
        take(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["end"] or m["end2"])
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in SKIPPED and not closing:
            if attrs.endswith("/") and name not in ("script", "style", "textarea", "title"):
                continue    # an empty element
            end = None if name in endless else re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            if end is None:
                endless.add(name)
            if name in ("script", "style", "textarea", "title", "noscript", "iframe") or end:
                at = end.end() if end else len(page)
            if name in BLOCKS or name == "head":
                if b := block():
                    yield b
            continue
        if name == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1))
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in BLOCKS and name not in SCOPES:
            continue
        if b := block():
            yield b
        if name == "p" or name not in SCOPES:
            link_depth = 0 if closing else link_depth
        if name in SCOPES:
            if closing:
                for k in range(len(scopes) - 1, -1, -1):
                    if scopes[k][0] == name:
                        del scopes[k:]
                        break
            elif not attrs.endswith("/"):
                _, lasting, layout, region = scopes[-1] if scopes else ("", False, False, False)
                hints = hints_of(attrs)
                if name in TEXT_REGIONS:
                    layout, region = False, True
                else:
                    # a form may be wrapped around a whole page
                    layout = layout or name == "form" or bool(hints - LASTING)
                    lasting = lasting or (name in BOILERPLATE and name != "form") or bool(hints & LASTING)
                scopes.append((name, lasting, layout, region))
    if b := block():
        yield b


def first_pass(b: Block, rules: BlockRules, has_region: bool) -> int:
    size = len(b.text)
    if b.boilerplate or b.linked > rules.link_share * size:
        return BAD
    if b.region:
        return GOOD
    words = b.text.lower().split()
    stops = sum(w.strip(".,;:!?") in STOP_WORDS for w in words) / len(words)
    if has_region:
        # an explicit text region elsewhere: only clearly running text counts outside of it
        return GOOD if size > rules.long and stops >= rules.stop_high else BAD
    if size < rules.short:
        return OPEN if not b.linked else BAD
    if stops >= rules.stop_high:
        return GOOD
    if stops >= rules.stop_low:
        return GOOD if size > rules.long else OPEN
    return BAD if size <= rules.long else OPEN


def second_pass(labels: list[int]) -> list[int]:
    """Open blocks take the label of the nearest decided neighbours; no decided block at all: text."""
    n = len(labels)
    before, after = [(-1, OPEN)] * n, [(-1, OPEN)] * n
    last = (-1, OPEN)
    for k in range(n):
        if labels[k] != OPEN:
            last = (k, labels[k])
        before[k] = last
    last = (-1, OPEN)
    for k in range(n - 1, -1, -1):
        if labels[k] != OPEN:
            last = (k, labels[k])
        after[k] = last
    out = []
    for k, own in enumerate(labels):
        if own == OPEN:
            (i, x), (j, y) = before[k], after[k]
            if x == OPEN or y == OPEN:
                own = y if x == OPEN else x
                own = GOOD if own == OPEN else own
            elif x == y:
                own = x
            else:
                own = x if k - i <= j - k else y
        out.append(own)
    return out


def extract(page: str | None, rules: BlockRules = BlockRules()) -> str:
    found = list(blocks_of(page or ""))
    has_region = any(b.region and not b.boilerplate for b in found)
    labels = second_pass([first_pass(b, rules, has_region) for b in found])
    return "\n".join(b.text for b, keep in zip(found, labels) if keep == GOOD)


def extract_pages(pages: DataFrame, rules: BlockRules = BlockRules()) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``page_id, url, html``."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p, rules) for p in text_column(batch, "html").to_pylist()]
            cols = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
