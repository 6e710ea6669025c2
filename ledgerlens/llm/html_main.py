"""Main text of web pages by two-pass block rules.

The markup is cut into blocks at block-level tags.  The first pass decides each block
by itself: blocks in page furniture (by element, class, id or role) and blocks made of
links are boilerplate; long blocks dense in stop words are text; the rest stays
open -- short blocks, and blocks with few stop words.  Where no stop list can tell --
blocks in a script without one, and pages of which no block is dense in stop words --
long blocks with few links are text.  In the second pass an open block
takes the label of its nearest decided neighbours: text if both sides are text,
boilerplate if both are not, and with one of each the nearer one (text if equally
near).  The edges of an ``article`` or ``main`` element count as decided text for the
blocks inside, which look no further than these edges; the edges of the page count
as boilerplate.  On a page with such an element, long open blocks outside are boilerplate.

A form, or an element named like furniture, that holds nearly all of a page's text and
parts of a page (a heading, a navigation, an article) is a wrapper, not furniture.

One row-parallel pass, no shuffle; a page is handled whole, whatever its length, in time
that grows with its length.

Defined results: null html is empty and gives an empty text; broken or cut-off
markup is read as far as it goes (a tag that never closes hides nothing after it
but its own text); equal rows give equal results; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlens.llm.bpe import in_batches

SHORT_CHARS = 70
LINK_SHARE = 0.5
STOP_SHARE = 0.15
FEW_LINKS = 0.25           # share of linked characters, where stop words cannot tell
WIDE_CHARS = 2             # more that a character counts in scripts without spaces
WRAPPER_SHARE = 0.8        # of a page's characters
WRAPPERS = 4               # that are looked through

# Frequent function words of the corpus languages.
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it its not of on or
she that the their they this to was were which will with you
als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es
für hat im ist mit nach nicht sich sie sind um und von vor war werden wie wird zu zum zur
au aux avec ce ces cette dans de des du elle en est et il ils la le les leur mais ne nous
ont ou par pas plus pour qu que qui sa se ses son sont sur un une vous
al como con del desde el ella en entre era es esta este fue ha hay lo los las más me mi muy
no nos o para pero por que se sin sobre su sus también te un una y ya
""".split())

# Elements whose content is never text of the page.
RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|title"
FURNITURE = frozenset("""
nav footer aside form menu dialog button select textarea label fieldset head
""".split())
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav
ol optgroup option p pre section summary table tbody td tfoot th thead tr ul
""".split())
BREAKS = frozenset(["br", "img", "input", "wbr"])
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDED_BY_NEXT = frozenset("p li dt dd td th tr option".split())
# Words in class, id or role that name page furniture.
NAMES = frozenset("""
ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment
comments consent cookie cookies disclaimer disqus footer gdpr menu modal nav navbar
navigation newsletter notice notification pager pagination paywall popup promo promotion
recommended related replies respond search share sharing sidebar signup social sponsor
sponsored subscribe toolbar widget complementary contentinfo form login
""".split())
# Words in front of a name that say the opposite, or what an element has.
NOT_NAMES = frozenset(["no", "not", "non", "without", "has", "have", "with"])
# Names of furniture that can be most of a page, and parts that a page has.
NEVER_WRAPPERS = frozenset(["comment", "comments", "disqus", "replies", "respond"])
PAGE_PARTS = frozenset(["article", "main", "h1", "nav", "header", "footer"])
# these name the furniture of a page, but inside an article its own title
TOP_NAMES = frozenset(["header", "masthead", "topbar"])

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?=[a-z/])[^>]*+\Z",
    re.I | re.S)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Scripts that put no spaces between words.
_WIDE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
                   "\U00020000-\U0003ffff]")


@dataclass
class Block:
    text: str
    linked: int            # characters inside links
    furniture: bool
    region: int            # number of the article element, 0 outside
    heading: bool = False
    outer: int = 0         # number of the outermost furniture around it


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    heading: bool = False
    links: int = 0
    inside: list[list] = field(default_factory=list)    # open furniture: [name, depth, number]
    ignored: frozenset = frozenset()                    # numbers of wrappers
    opened: int = 0
    wrappers: set[int] = field(default_factory=set)     # furniture that could be a wrapper
    paged: set[int] = field(default_factory=set)        # outermost furniture with parts of a page
    articles: list[str] = field(default_factory=list)
    region: int = 0
    regions: int = 0

    def add(self, raw: str):
        if raw:
            text = html.unescape(raw)
            self.parts.append(text)
            if self.links:
                self.linked += len("".join(text.split()))

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, self.linked, bool(self.inside), self.region,
                                     self.heading, self.inside[0][2] if self.inside else 0))
        self.parts.clear()
        self.linked = 0

    def open(self, name: str, attributes: str):
        if name in BLOCKS:
            self.flush()
            self.heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
        elif name in BREAKS:
            self.parts.append(" ")
        if name == "a":
            self.links = 1                               # links do not nest
        if name in VOID or attributes.endswith("/"):
            return
        if name in ("article", "main") and not self.inside:
            self.articles.append(name)
            if self.region == 0:
                self.regions += 1
                self.region = self.regions
        if self.inside:
            if name in PAGE_PARTS:
                self.paged.add(self.inside[0][2])
            top = self.inside[-1]
            if top[0] == name:
                if name in ENDED_BY_NEXT:
                    self.inside.pop()
                else:
                    top[1] += 1
                    return
        names = self.furniture(name, attributes)
        if names:
            self.opened += 1
            if name not in FURNITURE or name == "form":
                if not names & NEVER_WRAPPERS:
                    self.wrappers.add(self.opened)
            if self.opened not in self.ignored:
                self.inside.append([name, 1, self.opened])

    def furniture(self, name: str, attributes: str) -> frozenset | set:
        """The names by which an element is furniture, none if it is not."""
        if name in ("html", "body", "article", "main"):
            return frozenset()
        if name in FURNITURE or name == "header" and not self.region:
            return {name}
        found = set()
        if "=" in attributes:
            for value in _ATTRIBUTE.finditer(attributes):
                for token in (value[1] or value[2] or value[3] or "").split():
                    words = _NAME.findall(_CAMEL.sub(" ", token).lower())
                    if words and words[0] not in NOT_NAMES:
                        found |= NAMES.intersection(words)
                        if not self.region:
                            found |= TOP_NAMES.intersection(words)
        return found

    def wrapper(self) -> int:
        """The number of an outermost furniture that wraps the page, or 0."""
        held: dict[int, int] = {}
        for b in self.blocks:
            held[b.outer] = held.get(b.outer, 0) + len(b.text)
        total = sum(held.values())
        for number, chars in held.items():
            if (number in self.wrappers and number in self.paged
                    and chars >= WRAPPER_SHARE * total):
                return number
        return 0

    def close(self, name: str):
        if name in BLOCKS:
            self.flush()
            self.heading = False
        if name == "a":
            self.links = 0
        for i in range(len(self.inside) - 1, -1, -1):
            if self.inside[i][0] == name:
                self.inside[i][1] -= 1
                if self.inside[i][1] <= 0:
                    del self.inside[i:]
                break
        if self.articles and self.articles[-1] == name and not self.inside:
            self.articles.pop()
            if not self.articles:
                self.region = 0


def _read(page: str, ignored: frozenset) -> _Reader:
    reader, at = _Reader(ignored=ignored), 0
    for token in _TOKEN.finditer(page):
        reader.add(page[at:token.start()])
        at = token.end()
        if token[3]:
            name = token[3].lower()
            if token[2]:
                reader.close(name)
            else:
                reader.open(name, token[4])
    reader.add(page[at:])
    reader.flush()
    return reader


def blocks(page: str) -> list[Block]:
    """The blocks of a page in their order."""
    ignored = frozenset()
    while True:
        reader = _read(page, ignored)
        wrapper = reader.wrapper()
        if not wrapper or len(ignored) == WRAPPERS:
            return reader.blocks
        ignored |= {wrapper}


def _is_long(block: Block) -> bool:
    n = len(block.text)
    return n >= SHORT_CHARS or (not block.text.isascii() and
                                n + WIDE_CHARS * len(_WIDE.findall(block.text)) >= SHORT_CHARS)


def first_pass(block: Block) -> bool | None:
    """True for text, False for boilerplate, None if the block alone does not tell."""
    size = len(block.text) - block.text.count(" ")
    if block.furniture or block.linked > LINK_SHARE * size:
        return False
    if block.heading or len(block.text) < SHORT_CHARS:
        return None
    words = [w.strip("!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~").lower() for w in block.text.split()]
    stops = sum(w in STOP_WORDS for w in words)
    return True if stops >= STOP_SHARE * len(words) else None


def _untold(block: Block, known: bool) -> bool:
    """A long block with few links that stop words say nothing about."""
    size = len(block.text) - block.text.count(" ")
    if block.heading or block.linked > FEW_LINKS * size or not _is_long(block):
        return False
    return not known or 2 * len(_WIDE.findall(block.text)) > size


def _nearest(found: list[Block], decided: list[bool | None], step: int) -> list[tuple[int, bool]]:
    """For each open block, the distance and label of the decided block, or of the edge,
    next to it in one direction: one sweep."""
    out: list[tuple[int, bool]] = [(0, False)] * len(found)
    order = range(len(found)) if step > 0 else range(len(found) - 1, -1, -1)
    at, label, region = None, False, None
    for i in order:
        if found[i].region != region:                    # an edge: of the article, or the page
            region = found[i].region
            at, label = i - step, region > 0
        if decided[i] is None:
            out[i] = (abs(i - at), label)
        else:
            at, label = i, decided[i]
    return out


def labels(found: list[Block]) -> list[bool]:
    """Both passes: whether each block is text."""
    decided = [first_pass(b) for b in found]
    known = any(decided)
    articles = any(b.region and not b.furniture for b in found)
    for i, b in enumerate(found):
        if decided[i] is None:
            inside = bool(b.region) or not articles
            if inside and _untold(b, known):
                decided[i] = True
            elif not inside and not b.heading and _is_long(b):
                decided[i] = False
    before, after = _nearest(found, decided, 1), _nearest(found, decided, -1)
    out = []
    for own, (near, left), (far, right) in zip(decided, before, after):
        if own is None:
            own = left if left == right or near < far else right if far < near else True
        out.append(own)
    return out


def main_text(page: str | None) -> str:
    """The text blocks of a page, joined by line breaks."""
    found = blocks(page or "")
    return "\n".join(b.text for b, keep in zip(found, labels(found)) if keep)


def extract(df: DataFrame, column: str = "html", keep=("page_id", "url")) -> DataFrame:
    """keep columns, text string, n_chars long per row."""
    keep = list(keep)
    source = df.select(*keep, F.col(column).alias("__html"))
    kinds = [*(to_arrow_type(source.schema[c].dataType) for c in keep), pa.string(), pa.int64()]
    schema = T.StructType([*(source.schema[c] for c in keep),
                           T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        def rows():
            for b in batches:
                kept = [c.to_pylist() for c in b.columns[:-1]]
                for i, page in enumerate(b.columns[-1]):
                    text = main_text(page.as_py())
                    yield (*(c[i] for c in kept), text, len(text))
        return in_batches(rows(), schema.names, kinds, lambda r: 2 * r[-1])
    return source.mapInArrow(run, schema)
