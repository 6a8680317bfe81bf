"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: structure (menus, headers, footers, forms, scripts,
elements named as adverts, notices or comments) marks blocks as bad; link density, length and stop-word density label
the others as good, bad, or undecided. In scripts and languages without a stop-word list sentence marks stand for
stop words. Undecided blocks inherit in a second pass the label of their nearest decided neighbours. Inside an ``article`` or
``main`` element, which the author has marked as the content, text that does not read like prose is undecided
rather than bad, one good neighbour is enough, and links do not count against a block. Elsewhere a short paragraph or heading
needs good text on one side and nothing bad on the other, any other short block good text on both.

Defined results: a null or empty page, or one without main text, gives the empty text. Markup that is cut off
at the end of a page ends there; a stray end tag is ignored, and an element left open ends with the one
around it, or where HTML lets its end tag be left out. Neighbours at equal distance need to agree. Repeated rows are extracted one by
one. Pages are read whole, in time linear in their length. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from riskstream.llm import storage

SHORT_CHARS = 70
LONG_CHARS = 200
LOW_STOP_DENSITY, HIGH_STOP_DENSITY = 0.15, 0.30
MAX_LINK_DENSITY = 0.5

# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from has have he her his i in is it its not of on or she that the their they this to
    was we were which will with you
    aber als am auch auf aus bei das dem den der des die durch ein eine einen einer es für hat ich im ist mit nach
    nicht noch oder sich sie sind über um und von vor war wie wird zu zum zur
    au aux avec ce ces dans de du elle en est et il ils je la le les leur lui mais ne nous ont ou par pas plus pour
    qui que sa se ses son sont sur un une vous
    al como con del el ella ellos era esta este fue ha hay lo los las más muy no nos para pero por se ser sin su sus
    también una y ya
    """.split()
)
# fixed values: HTML element names by role
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table
    tbody td tfoot th thead tr ul
    """.split()
)
PROSE_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption dd dt li".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title template iframe svg xmp noembed noframes".split())
BAD_TAGS = frozenset("head nav footer aside form button select option dialog menu label".split())
CONTENT_TAGS = frozenset("article main".split())
# fixed values: words in class, id or role that name an element as something other than content ...
BAD_WORDS = frozenset(
    """
    ad ads advert adverts advertisement advertisements adsense banner breadcrumb breadcrumbs comment comments commentlist
    consent contentinfo cookie cookies discussion disqus footer gdpr header login masthead menu modal nav navbar navigation
    newsletter notice notices pager pagination popup promo promos promotion related replies respond search share sharing
    sidebar signup social sponsor sponsored subscribe toolbar widget widgets
    """.split()
)
# ... and words that may stand beside them in one name
NEUTRAL_WORDS = frozenset(
    """
    area bar body bottom box button buttons container content fixed form global google group inner item items left link
    links list main module outer page panel primary reader right secondary section site sticky text thread top unit user
    users wrap wrapper
    """.split()
)
# fixed values: elements whose end tag may be left out: what an opening tag ends, and how far up it looks
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "a": (("a",), ("td", "th", "table", "button")),
}
PARAGRAPH_LIMITS = ("td", "th", "caption", "table", "button", "object")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+")


#: Marks that end or part sentences, and how many of them a long text has at least in each so many characters.
_MARKS = re.compile(r"[.,;:!?\u3001\u3002\uff01\uff0c\uff0e\uff1a\uff1b\uff1f\u061f\u060c\u06d4\u0964\u1362]")
CHARS_PER_MARK = 120
#: From this code point on, letters are of scripts that the stop words do not cover.
FOREIGN = 0x0370


@dataclass(slots=True)
class Block:
    text: str
    link_chars: int
    bad: bool  # by structure
    content: bool  # inside an element marked as the content
    prose: bool  # a paragraph, heading or the like
    label: str = ""


def _named_bad(value: str) -> bool:
    """Whether one of the names is made of bad words, and of neutral ones or numbers beside them."""
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value.strip("\"'")).lower().split():
        parts = [part for part in re.split(r"[^a-z0-9]+", name) if part and not part[:1].isdigit()]
        if any(part in BAD_WORDS for part in parts) and all(part in BAD_WORDS or part in NEUTRAL_WORDS for part in parts):
            return True
    return False


def _is_bad(name: str, rest: str, in_content: bool) -> bool:
    if name in BAD_TAGS or (name == "header" and not in_content):
        return True
    if not rest or name in CONTENT_TAGS or name in ("body", "html"):
        return False
    if in_content and (name in HEADINGS or name == "header"):
        return False
    for attribute in _NAMED.finditer(rest):
        # inside the content an id is as a rule the anchor of a heading or a section
        anchor = in_content and attribute[1].lower() == "id" and name in ("section", "p", "figure", "span", "a", "li")
        if not anchor and _named_bad(attribute[2]):
            return True
    return False


class _Open:
    """The elements that are open, with the places of each name, so that no end tag looks at all of them."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool]] = []  # name, bad, content
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def innermost(self, names) -> int:
        found = -1
        for name in names:
            if (places := self.places.get(name)) and places[-1] > found:
                found = places[-1]
        return found

    def push(self, name: str, bad: bool, content: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCK_TAGS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, bad, content))

    def close_from(self, place: int) -> None:
        """Close this element and all inside it."""
        while len(self.stack) > place:
            self.places[self.stack.pop()[0]].pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()


def blocks(html: str) -> list[Block]:
    """The non-empty blocks of a page in order."""
    found: list[Block] = []
    parts: list[str] = []
    link_parts: list[str] = []
    opened = _Open()
    ends: dict[str, re.Pattern] = {}

    def flush() -> None:
        nonlocal parts, link_parts
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                name, bad, content = opened.stack[-1] if opened.stack else ("", False, False)
                linked = len(" ".join(unescape("".join(link_parts)).split())) if link_parts else 0
                prose = bool(opened.blocks) and opened.stack[opened.blocks[-1]][0] in PROSE_TAGS
                found.append(Block(text, linked, bad, content, prose))
        parts, link_parts = [], []

    def close(place: int) -> None:
        """Close the element there; its text ends as a block if a block element closes with it."""
        if opened.blocks and opened.blocks[-1] >= place:
            flush()
        opened.close_from(place)

    at, n = 0, len(html)
    while at < n:
        tag = _TAG.search(html, at)
        end = tag.start() if tag else n
        if end > at:
            piece = html[at:end]
            parts.append(piece)
            if opened.places.get("a"):
                link_parts.append(piece)
        if not tag:
            break
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        closing = bool(tag["close"] or tag["close2"])
        if name in RAW_TAGS:
            if not closing:
                if name not in ends:
                    ends[name] = re.compile(rf"</{re.escape(name)}(?![a-zA-Z0-9:-])[^>]*(?:>|\Z)", re.IGNORECASE)
                over = ends[name].search(html, at)
                at = over.end() if over else n
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK_TAGS:
            flush()
        if closing:
            if (place := opened.innermost((name,))) >= 0:
                close(place)
            continue
        if name in BLOCK_TAGS and opened.places.get("p"):
            if (place := opened.places["p"][-1]) > opened.innermost(PARAGRAPH_LIMITS):
                close(place)
        if name in ENDS:
            ended, limits = ENDS[name]
            if (place := opened.innermost(ended)) > opened.innermost(limits):
                close(place)
        if name in VOID_TAGS:
            continue
        _, bad, content = opened.stack[-1] if opened.stack else ("", False, False)
        worse = _is_bad(name, tag["rest"] or tag["rest2"] or "", content)
        if worse and not bad:
            flush()
        opened.push(name, bad or worse, content or name in CONTENT_TAGS)
    flush()
    return found


def _reads_like_prose(text: str) -> str:
    """``good``, ``near`` or ``bad``, by the density of stop words, or of sentence marks where they do not apply."""
    size = len(text)
    marks = len(_MARKS.findall(text))
    if not text.isascii():
        letters = [ord(c) >= FOREIGN for c in text if c.isalpha()]
        if sum(letters) * 2 > len(letters):
            return "good" if marks * CHARS_PER_MARK >= size else "near"
    words = _WORD.findall(text.lower())
    density = sum(word in STOP_WORDS for word in words) / max(len(words), 1)
    if density >= HIGH_STOP_DENSITY:
        return "good" if size > LONG_CHARS else "near"
    sentences = size > LONG_CHARS and marks >= 2 and marks * CHARS_PER_MARK >= size
    return "near" if density >= LOW_STOP_DENSITY or sentences else "bad"


def classify(found: list[Block]) -> list[Block]:
    """Both passes: every block ends as ``good`` or ``bad``."""
    for block in found:
        size = len(block.text)
        if block.bad:
            block.label = "bad"
        elif block.link_chars > MAX_LINK_DENSITY * size:
            block.label = "near" if block.content and block.prose else "bad"
        elif size < SHORT_CHARS:
            block.label = "bad" if block.link_chars and not block.content and not block.prose else "short"
        else:
            block.label = _reads_like_prose(block.text)
            if block.content:  # the author says it is content; what reads like no prose waits for its neighbours
                block.label = "good" if block.label != "bad" else "near"
    # elements set apart by their tag or name are no neighbours of the text around them
    decides = [block.label in ("good", "bad") and not block.bad for block in found]
    before, last = [], {True: "", False: ""}
    for block, decided in zip(found, decides, strict=True):
        before.append(last[block.content])
        if decided:
            last[block.content] = block.label
    after = {True: "", False: ""}
    final = []
    for block, decided, previous in zip(reversed(found), reversed(decides), reversed(before), strict=True):
        sides = (previous, after[block.content])
        if decided:
            after[block.content] = block.label
        if block.label in ("good", "bad"):
            final.append(block.label)
        elif block.content or block.label == "near":  # one good neighbour is enough, and so is none at all
            final.append("good" if "good" in sides or not any(sides) else "bad")
        elif block.prose:
            final.append("good" if "good" in sides and "bad" not in sides else "bad")
        else:
            final.append("good" if sides == ("good", "good") else "bad")
    for block, label in zip(found, reversed(final), strict=True):
        block.label = label
    return found


def extract(html: str | None) -> str:
    """The main text of a page: its good blocks, one per line."""
    if not html:
        return ""
    return "\n".join(block.text for block in classify(blocks(html)) if block.label == "good")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def run(batches):
        for batch in batches:
            texts = [extract(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    return storage.texts(pages).select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
