"""Main text of web pages by two passes of block rules (operator 1).

The page is cut into blocks of text at block-level tags. What stands in a menu,
header, footer, sidebar, notice, advert, form, script, style or reader comment, by its
element, role or name, is no candidate. Pass one decides every other block by link density,
length and stop-word density. Where the page has article or main elements, the text
that this pass finds inside and outside of them is compared, and the larger part is where the
main text is: articles outweighed by the page's own text are teasers. Pass two
gives ambiguous, mostly short, blocks the label of the nearest decided neighbours, those of
the same article first.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import batched

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be been but by for from had has have he her his i in is it its no not of on or our she so that the
    their them there they this to was we were what when which who will with would you your
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour qu que qui
    sa se ses son sont sur un une vous
    als am auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist
    mit nach nicht noch nur oder sich sie sind so über um und uns von vor war wie wir zu zum zur
    al como con de del el ella en entre es esta este fue ha la las lo los más me mi muy no nos o para pero por que se si sin
    sobre son su sus también un una y ya""".split()
)
# HTML element names by their part in the page.
_BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td
    tfoot th thead tr ul video audio caption title""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("head nav footer aside form script style noscript template button select option svg annotation annotation-xml iframe object canvas dialog menu textarea title video audio".split())
_RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Words of class and id names that mark what is not the article.
_MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner
    banners cookie cookies consent gdpr notice notices notification notifications alert alerts popup popups modal overlay newsletter subscribe
    subscription signup sidebar sidebars rail widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs toolbar topbar
    footer masthead comment comments disqus respond replies reply discussion social share sharing related recommended recommendations
    pagination pager login search skip copyright
    commentlist commentform commentarea commentbox commentsection adsbygoogle adsense adslot adbox adunit adcontainer adwrapper
    topnav sidenav subnav mainnav sitenav pagefooter sitefooter siteheader sharebar sharedaddy""".split()
)
# Marks that are ordinary words too, so that they mark only names made of marks and of words for parts of a page.
_COMMON_MARKS = frozenset(
    """social share sharing search login skip copyright alert alerts notice notices notification notifications menu menus related
    recommended recommendations discussion reply replies respond banner banners rail rails overlay promotion sponsor sponsors subscription""".split()
)
_PARTS = frozenset(
    """area bar block body bottom box button buttons card cards center col column container content cta footer form grid group
    head header heading icon icons inline inner input item items js layout left link links list main mobile module outer page panel
    post posts article articles row section site slot stack sticky stories story strip text title top right unit wrap wrapper
    also follow for holder label like links may media more most network networks placeholder popular prompt read reading region see to toggle
    tools you zone""".split()
)
_ARTICLE_MARKS = _MARKS & frozenset("ad ads advert sponsored promo comment comments reply related recommended".split())
_IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WORD = re.compile(r"[^\W\d_]+")

#: A block with a larger share of its characters in links is no text.
LINK_DENSITY = 0.5
#: Share of stop words from which a long enough block counts as text.
STOP_DENSITY = 0.12
SHORT_WORDS = 8
LONG_CHARS = 200
#: Articles with less text than this share of the text outside of them are teasers.
TEASER = 0.25


@dataclass
class Block:
    """A run of text between block-level tags; ``article`` numbers the article it is in, 0 for none."""

    text: str
    linked: int
    article: int
    tag: str


def _excluded(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _NEVER or (tag == "header" and not in_article):
        return True
    if not attributes.strip() or tag in ("html", "body", "main"):
        return False
    of = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in _ATTR.finditer(attributes)}
    if "hidden" in of or of.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", of.get("style", ""), re.I):
        return True
    if of.get("role", "").lower() in _ROLES:
        return True
    names = [{w.lower() for w in _NAME_WORD.findall(n)} for n in f"{of.get('class', '')} {of.get('id', '')}".split()]
    if tag == "article":
        return any(n & _ARTICLE_MARKS for n in names)
    return any(_marked(n) for n in names) or (not in_article and any("header" in n for n in names))


def _marked(name: set[str]) -> bool:
    """Whether the words of one class or id name say that the element is no part of the article."""
    if name & (_MARKS - _COMMON_MARKS):
        return True
    return bool(name & _MARKS) and all(w in _MARKS or w in _PARTS or w.isdigit() for w in name)


def blocks(page: str) -> list[Block]:
    """The page's candidate blocks, in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, bool]] = []  # element, whether in a left-out part, article, whether in a link
    open_now: Counter[str] = Counter()  # elements of each name on the stack
    parts: list[tuple[str, bool]] = []
    articles = 0
    at = 0

    def state() -> tuple[str, bool, int, bool]:
        return stack[-1] if stack else ("", False, 0, False)

    def end_block() -> None:
        if parts:
            raw = "".join(t for t, _ in parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                linked = sum(len(" ".join(html.unescape(t).split())) for t, in_link in parts if in_link)
                out.append(Block(text, linked, state()[2], next((s[0] for s in reversed(stack) if s[0] in _BLOCK), "")))
            parts.clear()

    def add(text: str) -> None:
        _, left_out, _, in_link = state()
        if text and not left_out:
            parts.append((text, in_link))

    def close(names: set[str], scope: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                end_block()
                open_now.subtract(s[0] for s in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    while (m := _TOKEN.search(page, at)) is not None:
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if open_now[tag] > 0:
                if tag in _BLOCK:
                    close({tag}, set())
                else:  # an inline end tag does not leave the block it stands in
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == tag:
                            open_now[tag] -= 1
                            del stack[i]
                            break
                        if stack[i][0] in _BLOCK:
                            break
            elif tag in _BLOCK:
                end_block()
            continue
        attributes = m[3] if m[3] is not None else m[6] or ""
        if tag == "br":
            add(" ")
            continue
        if tag in _BLOCK:
            if open_now["p"] > 0:
                close({"p"}, {"td", "th", "li", "button", "article", "section", "div"})
            if tag in _IMPLIED and any(open_now[t] > 0 for t in _IMPLIED[tag]):
                close(_IMPLIED[tag], _SCOPES[tag])
            end_block()
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK:
            continue
        _, left_out, article, in_link = state()
        left_out = left_out or _excluded(tag, attributes, article > 0)
        if tag in _RAW:
            found = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = found.end() if found else len(page)
            continue
        if not left_out and not article and (tag in ("article", "main") or 'role="main"' in attributes or 'itemprop="articleBody"' in attributes):
            articles += 1
            article = articles
        stack.append((tag, left_out, article, in_link or tag == "a"))
        open_now[tag] += 1
    add(page[at:])
    end_block()
    return out


def first_pass(b: Block) -> bool | None:
    """Whether a block is text by its own links, length and stop words; None if that is not clear."""
    if b.linked > LINK_DENSITY * len(b.text):
        return None if b.article and b.tag not in ("li", "ul", "ol", "td") else False
    words = [w.lower() for w in _WORD.findall(b.text)]
    if len(words) < SHORT_WORDS:
        return None
    if sum(w in STOP_WORDS for w in words) >= STOP_DENSITY * len(words) or b.article and len(b.text) >= LONG_CHARS:
        return True
    return None


def decide(found: list[Block]) -> list[bool]:
    """Whether each block belongs to the main text."""
    labels = [first_pass(b) for b in found]
    inside, outside = (sum(len(b.text) for b, label in zip(found, labels, strict=True) if label and bool(b.article) == part) for part in (True, False))
    # Articles with a small part of the page's text are teasers; with none of it on either side, the element tells.
    teasers = inside < TEASER * outside
    scoped = any(b.article for b in found) and not teasers and outside <= inside
    for i, b in enumerate(found):
        if scoped and not b.article or teasers and b.article:
            labels[i] = False
    last: dict[int, int] = {}  # nearest decided block so far, by article
    before, after = [None] * len(found), [None] * len(found)
    for order, side in ((range(len(found)), before), (reversed(range(len(found))), after)):
        last.clear()
        for i in order:
            if teasers and found[i].article:
                continue
            scope = found[i].article if scoped else 0
            side[i] = last.get(scope)
            if labels[i] is not None:
                last[scope] = i
    out = []
    for i, label in enumerate(labels):
        if label is None:
            sides = [(abs(j - i), not labels[j]) for j in (before[i], after[i]) if j is not None]
            if sides:
                label = not min(sides)[1]  # on a tie, text
            else:
                label = scoped or not any(labels)
            if scoped and found[i].linked <= LINK_DENSITY * len(found[i].text):
                label = True  # unlinked text inside the article stays
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """The main text of a page: blocks joined by an empty line; empty for NULL."""
    if not page:
        return ""
    found = blocks(page)
    return "\n\n".join(b.text for b, good in zip(found, decide(found), strict=True) if good)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    A NULL or empty html, or a page without text, gives an empty text; rows with
    equal or NULL page_ids each give a row. Very long or deeply nested pages are read whole, in
    time that grows with their length. An empty table gives no rows. Columns besides
    page_id, url and html are not read.
    """

    def run(batches):
        for b in batched(batches, 500):
            texts = [main_text(t) for t in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
