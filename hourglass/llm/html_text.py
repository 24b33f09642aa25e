"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides each block by where
it stands (menus, headers, footers, sidebars, notices, adverts, forms and reader comments
are boilerplate), by its link density, and by its length and the density of stop words.
Short blocks and blocks without enough evidence stay open. In the second pass an open block
takes the label of its nearest decided neighbours: of both if they agree, else of the
nearer one. Neighbours are looked for in the block's own region (inside or outside the
article), and without any the region decides. In an article, long blocks without links are
main text whatever their density.

On a page without an article the rules decide alone. There a long block with few stop words
is main text if it reads as prose in any language: mostly letters, and sentences that end.
If no block has enough evidence, the longest kind of prose there is stands for the page,
or else its blocks of some length.

A class or id that says nothing but boilerplate ("comments", "cookie-notice", "post-comments")
marks its element; one that has such a word among others ("content has-sidebar", "social-impact")
is a hint: the element's blocks are decided by length, density and links among themselves, and
without a good one they go. An article or main below either opens its region, unless its own
class or id has such a word; below a marked element its blocks stay under the hint. At headings
such words count only before boilerplate.

Defined results: a null page is an empty one; a page without main text gives an empty
text; an unclosed tag ends with its container, an unclosed comment, script or style at the
end of the page; a tag with an unclosed quote is text; null ids, repeated rows and empty tables are kept as they are; other
columns are not read; pages of any length are read whole.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.shared_files import ship_package

# Function words of English, French, German and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be by for from has have he in is it its not of on or that the this to was were which will with you
au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous on ou par pas pour que qui sa se son sur un une vous
als am auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch sich sie sind und von war wie zu zum zur
al como con de del el ella en es esta este la las lo los más muy no o para pero por que se sin sobre su sus un una y
""".split())

# Names of elements.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead
tr ul""".split())
RAW_TAGS = frozenset("script style noscript template iframe textarea svg math object title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav aside form footer menu button select dialog".split())
ARTICLE_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose end tag may be left out; the next block ends them.
LIGHT_TAGS = frozenset("p li dt dd td th tr option".split())
BOILER_WORDS = frozenset("""ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright
disqus footer menu masthead modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related reply replies
respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget""".split())
#: Words that say nothing beside one of BOILER_WORDS.
FRAME_WORDS = frozenset("site post posts list item items box block slot unit area entry reader user form button buttons links".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())

SHORT, LONG = 70, 200
LOW_STOPS, HIGH_STOPS = 0.15, 0.3
MOST_LINKS = 0.5
#: Least share of letters in prose that is told without a word list.
LETTERS = 0.6

START = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)(?=[a-zA-Z])", re.S)
NAME_END = re.compile(r"[\s/>]|\Z")
MARK = re.compile(r"""[>"']|\Z""")
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
WORD = re.compile(r"[^\W\d_]+")
FULL_STOP = re.compile(r"[.!?…。！？](?!\w)")
SENTENCE_END = re.compile(r"[.!?…](?=\s|[\"'»”)]|\Z)|[。！？｡।؟۔]")


@dataclass
class Block:
    text: str
    link_chars: int
    boiler: bool       # stands in a container that is never main text
    region: int        # the article it stands in, 0 outside
    heading: bool
    hint: int          # the innermost container with a hint it stands in, 0 outside
    named: bool        # a heading whose class or id has a word of boilerplate
    label: str = "open"


def is_boiler(name: str, attributes: str) -> bool:
    """By its kind, its role or as it is hidden."""
    if name in BOILER_TAGS:
        return True
    if not attributes:
        return False
    return bool(HIDDEN.search(attributes)) or any(
        w in BOILER_ROLES for m in NAMES.finditer(attributes) if m[1].lower() == "role" for w in words_in(m))


def words_in(m: re.Match) -> list[str]:
    return re.split(r"[^a-z0-9]+", (m[2] or m[3] or m[4] or "").lower())


def boiler_name(attributes: str) -> str:
    """What class and id say: boilerplate ("marked"), something with a word of it ("hint"), or nothing ("")."""
    found = ""
    for m in NAMES.finditer(attributes) if attributes else ():
        if m[1].lower() != "role" and not BOILER_WORDS.isdisjoint(words_in(m)):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                words = [w for w in re.split(r"[^a-z0-9]+", name) if w and not w.isdigit()]
                if not BOILER_WORDS.isdisjoint(words):
                    if all(w in BOILER_WORDS or w in FRAME_WORDS for w in words):
                        return "marked"
                    found = "hint"
    return found


@dataclass(frozen=True)
class Place:
    """An open container."""
    name: str
    boiler: bool = False
    region: int = 0
    hint: int = 0
    fixed: bool = False     # boilerplate not only by a class or id


OUTSIDE = Place("")


def token_reader(page: str) -> Callable[[int], tuple[int, int, str | None, bool, str] | None]:
    """Reads the next comment or tag: start, end, name (None for a comment), whether it closes, attributes.

    A tag whose end is not found, as a quote stays open, is text. Places that lead there are
    remembered, so the time is linear in the page.
    """
    last = len(page)
    unclosed: set[int] = set()
    ahead = {NAME_END: (0, -1), MARK: (0, -1)}

    def next_of(pattern: re.Pattern, at: int) -> int:
        since, found = ahead[pattern]
        if not since <= at <= found:
            found = pattern.search(page, at).start()
            ahead[pattern] = at, found
        return found

    def tag_end(at: int) -> int:
        passed, k = [], next_of(MARK, at)
        while k < last and k not in unclosed:
            if page[k] == ">":
                return k
            passed.append(k)
            close = page.find(page[k], k + 1)
            k = next_of(MARK, close + 1) if close >= 0 else last
        unclosed.update(passed)
        return -1

    def read(at: int) -> tuple[int, int, str | None, bool, str] | None:
        while m := START.search(page, at):
            if m[1] is None:
                return m.start(), m.end(), None, False, ""
            named = next_of(NAME_END, m.end())
            end = tag_end(named)
            if end >= 0:
                return m.start(), end + 1, page[m.end():named].lower(), bool(m[1]), page[named:end]
            at = m.end()
        return None

    return read


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order."""
    found: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[Place] = []
    opened: Counter[str] = Counter()      # names on the stack: an end tag of no open element looks for none
    regions, hints, in_link, heading, named = 0, 0, False, False, False

    def close_block() -> None:
        nonlocal in_link
        in_link = False
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                links = " ".join(references.unescape("".join(linked)).split()) if linked else ""
                p = stack[-1] if stack else OUTSIDE
                found.append(Block(text, len(links), p.boiler, p.region, heading, p.hint, named))
        parts.clear()
        linked.clear()

    at, end, read = 0, len(page), token_reader(page)
    while at < end:
        token = read(at)
        piece = page[at:token[0] if token else end]
        if piece:
            parts.append(piece)
            if in_link:
                linked.append(piece)
        if token is None:
            break
        _, at, name, closing, attributes = token
        if name is None:
            continue
        if name in RAW_TAGS:
            if not closing and not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if name == "a":
            in_link = not closing
        if name == "br":
            parts.append(" ")
            continue
        block = name in BLOCK_TAGS
        fixed, word = (is_boiler(name, attributes), boiler_name(attributes)) if not closing else (False, "")
        if block:
            close_block()
            heading = name in HEADINGS and not closing
            named = heading and bool(word)
        if name in VOID_TAGS or (not block and not closing and not fixed and word != "marked"):
            continue
        if closing:
            if opened[name]:
                if not block:
                    close_block()
                while True:
                    last = stack.pop().name
                    opened[last] -= 1
                    if last == name:
                        break
            continue
        while block and stack and stack[-1].name in LIGHT_TAGS and (stack[-1].name == "p" or name in LIGHT_TAGS):
            opened[stack.pop().name] -= 1
        p = stack[-1] if stack else OUTSIDE
        boiler, region, hint, firm = p.boiler, p.region, p.hint, p.fixed
        if name in ARTICLE_TAGS:
            if (boiler or hint or not region) and not firm and not ((boiler or hint) and word):
                regions += 1
                region = regions
                # Below a marked element the article has to hold main text of its own; a hint it overrules.
                hints += boiler
                boiler, hint = False, hints if boiler else 0
        elif name not in ("body", "html"):
            firm = firm or fixed or (name == "header" and not region)
            if name not in HEADINGS:
                boiler = boiler or word == "marked"
                if word == "hint":
                    hints += 1
                    hint = hints
        if not block:
            close_block()
        # A header holds the page's title bar; inside an article it holds the article's title.
        stack.append(Place(name, boiler or firm, region, hint, firm))
        opened[name] += 1
    close_block()
    return found


def is_prose(text: str) -> bool:
    """Evidence that needs no word list: mostly letters, and sentences that end."""
    letters = sum(map(str.isalpha, text))
    return letters >= LETTERS * len(text) and bool(SENTENCE_END.search(text))


def first_pass(b: Block, bare: bool = False) -> str:
    """good, bad or open; ``bare`` if no block of the page stands in an article."""
    if b.boiler:
        return "bad"
    size = len(b.text)
    if b.link_chars / size > MOST_LINKS and not (b.region and b.heading):
        return "bad"
    if size < SHORT:
        return "open"
    if b.region and b.link_chars == 0 and size >= LONG:
        return "good"
    words = WORD.findall(b.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
    if stops >= HIGH_STOPS and (size >= LONG or b.region):
        return "good"
    if stops >= LOW_STOPS or b.region:
        return "open"
    if bare and not b.hint:
        # Few stop words: another language's text, or none.
        if is_prose(b.text):
            return "good" if size >= LONG else "open"
        return "bad" if size >= LONG else "open"
    return "bad"


def best_of(own: list[Block]) -> None:
    """Where nothing has shown to be main text, the longest kind of prose there is does."""
    if any(b.label == "good" for b in own):
        return
    for least in (SHORT, 0):
        found = [b for b in own if b.label == "open" and not b.heading and len(b.text) >= least and is_prose(b.text)]
        # Without any prose, blocks of some length or with a full stop that are not links.
        found = found or [b for b in own if not least and (len(b.text) >= SHORT or FULL_STOP.search(b.text))
                          and not b.heading and b.link_chars <= MOST_LINKS * len(b.text)]
        for b in found:
            b.label = "good"
        if found:
            return


def second_pass(found: list[Block], bare: bool = False) -> None:
    """Open blocks take the label of the nearest decided neighbours of their region and hint."""
    for b, after in zip(found, found[1:], strict=False):
        if b.named and after.boiler:
            b.label = "bad"
    groups: dict[tuple[int, int], list[Block]] = {}
    for b in found:
        if not b.boiler:
            groups.setdefault((b.region, b.hint), []).append(b)
    for (region, hint), own in groups.items():
        if bare and not hint:
            best_of(own)
        rest = "good" if region and not hint else "bad"
        near: list[list[tuple[int, str] | None]] = []
        for order in (range(len(own)), range(len(own) - 1, -1, -1)):
            last, side = None, [None] * len(own)
            for k in order:
                if own[k].label != "open":
                    last = (k, own[k].label)
                side[k] = last
            near.append(side)
        for k, b in enumerate(own):
            if b.label == "open":
                sides = [s for s in (near[0][k], near[1][k]) if s]
                if not sides:
                    b.label = rest
                else:   # of two as near, a heading goes with what follows, others as the region does
                    b.label = min(sides, key=lambda s: (abs(s[0] - k), b.heading and s[0] < k,
                                                        s[1] != rest))[1]


def main_text(page: str | None) -> str:
    """The main text: its blocks in page order, joined by an empty line."""
    found = blocks_of(page or "")
    bare = not any(b.region for b in found)
    for b in found:
        b.label = first_pass(b, bare)
    second_pass(found, bare)
    return "\n\n".join(b.text for b in found if b.label == "good")


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of ``pages`` (page_id, url, html)."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string")
