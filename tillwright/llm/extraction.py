"""Main text of web pages by block rules in two passes.

The page is cut into blocks at block-level tags. The first pass looks at each block by itself: what stands in an element
that is never part of an article (navigation, forms, adverts, comments by name, …) is boilerplate, and so is a block that
is mostly links; a block of some length with the density of function words that running text has is content; long blocks
without are boilerplate, unless the page marks them as its article. Short blocks stay undecided. In the second pass an undecided
block takes the label of the nearest decided block, before or after it. Between content and boilerplate at the same
distance it is content only if the boilerplate is known by its markup, which tells nothing about what stands beside it.

A class or id that names page furniture may be that of a wrapper around everything. It does not count for a <main> inside,
for the only <article> of the page, for articles with more text than stands outside of furniture, and, if it is a word
of layout, for an element that holds most of the page's text. Text in links is not counted there.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

# Function words of the languages the rules know.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or our she so than that the their them then"
    " there these they this to was we were what when which who will with would you your"
    " au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se"
    " ses son sont sur un une vous"
    " aber als am an auch auf aus bei bin bis das dass dem den der des die doch ein eine einem einen einer es für hat ich ihr im ist"
    " man mit nach nicht noch nur oder sich sie sind so um und uns vom von vor war was wenn wie wir zu zum zur über"
    " al con como del el ella ellos era es esta este fue ha hay la las lo los me mi más muy no nos para pero por porque que"
    " se sin sobre son su sus también te un una y ya".split()
)
# Elements whose content is never text, that part blocks, that never hold an article, and that do.
_SILENT = frozenset("script style noscript template svg math iframe object head title canvas audio video select textarea".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr"
    " ul button".split()
)
_NEVER = frozenset("nav footer aside form menu button fieldset dialog".split())
_ARTICLE = frozenset(("article", "main"))
# What can stand in a head; its end tag may be left out, then anything else ends it.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role that name page furniture.
_FURNITURE = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies"
    " copyright disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice pager pagination paywall"
    " popup promo promotion recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored"
    " sponsors subscribe subscription tags teaser toolbar widget widgets alert contentinfo complementary".split()
)
# Those of them that also name wrappers by their layout.
_LAYOUT = frozenset("banner header masthead menu menubar nav navbar navigation paywall search sidebar social tags toolbar widget widgets".split())
# "has-sidebar" speaks of the layout, "entry-header" of the article's own heading.
_ABOUT_LAYOUT = frozenset("has with no is without".split())
_HEADING_LIKE = frozenset("header banner masthead tags".split())
_BODY = frozenset("article post entry story content main body text".split())
# In a tag, quotation marks hold an attribute's value after "=", and are ordinary characters anywhere else.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?>\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?)*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NAME_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Characters of scripts that part no words, each about as much text as three letters.
_WIDE = re.compile("[\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff]")
# Words of the heading above reader comments, and the beginning of a copyright line.
_COMMENTS = frozenset("comments comment kommentare kommentar commentaires commentaire comentarios comentario".split())
_COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)
_SPACE = re.compile(r"\s+")
_LETTERS = re.compile(r"[^\W\d_]+")
_ENDS = {name: re.compile(rf"</{name}\s*(?:>|\Z)", re.I) for name in ("script", "style", "textarea", "title")}

LINK_DENSITY = 0.33
STOP_DENSITY_HIGH = 0.15
STOP_DENSITY_LOW = 0.05
SHORT, LONG = 70, 200


@dataclass
class Block:
    """Text between two block-level tags, and where it stands."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    furniture: bool = False
    wrapper: int = 0
    region: int = 0
    article: bool = False
    heading: bool = False
    text: str = ""


@dataclass
class Wrapper:
    """An element named as furniture: the one it stands in, the region it was opened in, and whether its names are of layout."""

    parent: int
    region: int
    layout: bool


@dataclass
class Region:
    """An outermost article or main, and the innermost wrapper that it stands in."""

    wrapper: int
    main: bool
    named: bool
    furniture: bool


def _furniture_names(attributes: str) -> set[str]:
    names: set[str] = set()
    for _, value in _NAMES.findall(attributes):
        for name in _CAMEL.sub("-", value).lower().split():
            parts = _NAME_PARTS.findall(name)
            found = {p for before, p in zip(["", *parts], parts, strict=False) if p in _FURNITURE and before not in _ABOUT_LAYOUT}
            if found and parts[0] not in _ABOUT_LAYOUT and not (found <= _HEADING_LIKE and _BODY.intersection(parts)):
                names |= found
    return names


def _settle_names(blocks: list[Block], wrappers: list[Wrapper], regions: list[Region]) -> None:
    """Mark as furniture what stands in an element whose class or id says so and is to be believed. Entries 0 stand for none."""
    weight, held, free, total = [0] * len(wrappers), [0] * len(regions), 0, 0
    for block in blocks:
        if not block.furniture:
            size = max(0, len(block.text) - block.linked)
            total += size
            held[block.region] += size
            weight[block.wrapper] += size
            free += 0 if block.wrapper else size
    top, apart = [0] * len(wrappers), [False] * len(wrappers)
    for i in range(len(wrappers) - 1, 0, -1):
        weight[wrappers[i].parent] += weight[i]
    for i in range(1, len(wrappers)):
        parent = wrappers[i].parent
        top[i] = top[parent] or i
        apart[i] = apart[parent] or not wrappers[i].layout
    own = [i for i in range(1, len(regions)) if not (regions[i].named or regions[i].furniture)]
    longest = max((held[i] for i in own if not regions[i].wrapper or regions[i].main), default=0)
    together = [0] * len(wrappers)
    for i in own:
        together[top[regions[i].wrapper]] += held[i]
    freed = [False] * len(regions)
    for i in own:
        w = regions[i].wrapper
        freed[i] = regions[i].main or (held[i] > longest and ((len(own) == 1 and not apart[w]) or together[top[w]] > free))
    named = [False] * len(wrappers)

    def inside(wrapper: int, region: int) -> bool:
        """Whether names make furniture of what stands in a region and, in it or around it, a wrapper."""
        if region and wrappers[wrapper].region != region:
            return not freed[region] and named[wrapper]
        return named[wrapper]

    for i in range(1, len(wrappers)):
        named[i] = not (wrappers[i].layout and 2 * weight[i] > total) or inside(wrappers[i].parent, wrappers[i].region)
    for block in blocks:
        block.furniture = block.furniture or inside(block.wrapper, block.region)


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order; character references are decoded and white space runs are one blank."""
    out: list[Block] = []
    current = Block()
    # Open elements: name, whether it makes its content furniture, an article, silent, or a link.
    stack: list[tuple[str, bool, bool, bool, bool]] = []
    count: Counter[str] = Counter()  # of open elements, by name
    furniture = article = silent = link = heading = 0
    wrappers, regions = [Wrapper(0, 0, True)], [Region(0, False, False, False)]
    # Open wrappers with the depth of their elements, innermost last; and the open region.
    open_wrappers, region = [(0, 0)], 0

    def close_block() -> None:
        nonlocal current
        current.text = _SPACE.sub(" ", html.unescape("".join(current.parts))).strip()
        if current.text:
            out.append(current)
        current = Block()

    def put(raw: str) -> None:
        if silent and stack[-1][0] == "head" and raw.strip():
            pop()
        if silent or not raw:
            return
        if not current.parts:
            if not raw.strip():
                return
            current.furniture, current.article, current.heading = furniture > 0, article > 0, heading > 0
            current.wrapper, current.region = open_wrappers[-1][0], region
        current.parts.append(raw)
        if link:
            current.linked += len(raw.strip())

    def pop() -> str:
        nonlocal furniture, article, silent, link, heading, region
        if open_wrappers[-1][1] == len(stack) > 0:
            open_wrappers.pop()
        name, f, a, s, k = stack.pop()
        count[name] -= 1
        furniture, article, silent, link = furniture - f, article - a, silent - s, link - k
        heading -= name in ("h1", "h2", "h3", "h4", "h5", "h6")
        region = region if article else 0
        return name

    at, n = 0, len(page)
    while at < n:
        tag = _TAG.search(page, at)
        if tag is None:
            put(page[at:])
            break
        put(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if silent and not tag[1]:
            if name == "body" and count["head"]:
                while pop() != "head":
                    pass
            elif stack[-1][0] == "head" and name not in _IN_HEAD:
                pop()
        if name == "br":
            put(" ")
            continue
        if name in _BLOCK:
            close_block()
        if tag[1]:
            if count[name]:
                while pop() != name:
                    pass
            continue
        if name in _ENDS and not tag[3].endswith("/"):
            ended = _ENDS[name].search(page, at)
            at = ended.end() if ended else n
            continue
        if name in _VOID or tag[3].endswith("/"):
            continue
        # What a tag closes by itself: a paragraph ends where a block begins, a link where another does.
        if name in _BLOCK:
            while stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "a", "u", "small", "font"):
                if not count["p"] and stack[-1][0] != "a":
                    break
                if pop() == "p":
                    break
        attributes = tag[3]
        inside = article > 0
        is_article = name in _ARTICLE
        never = name in _NEVER or (name == "header" and not inside)
        hidden = named = False
        if attributes and name not in ("html", "body"):
            names = _furniture_names(attributes)
            hidden, named = name not in _ARTICLE and bool(_HIDDEN.search(attributes)), bool(names)
        entry = (name, never or hidden, is_article, name in _SILENT, name == "a")
        stack.append(entry)
        count[name] += 1
        if is_article and not inside:
            regions.append(Region(open_wrappers[-1][0], name == "main", named, furniture > 0))
            region = len(regions) - 1
        if named and not is_article:
            wrappers.append(Wrapper(open_wrappers[-1][0], region, names <= _LAYOUT))
            open_wrappers.append((len(wrappers) - 1, len(stack)))
        furniture, article, silent, link = furniture + entry[1], article + entry[2], silent + entry[3], link + entry[4]
        heading += name in ("h1", "h2", "h3", "h4", "h5", "h6")
    close_block()
    if len(wrappers) > 1:
        _settle_names(out, wrappers, regions)
    return out


def decide(block: Block, known: bool = True) -> bool | None:
    """First pass: content, boilerplate, or undecided. Pages in a language whose function words are not ``known`` are
    judged by length and links alone."""
    if block.furniture or (not block.article and len(block.text) < LONG and _COPYRIGHT.match(block.text)):
        return False
    if block.linked > LINK_DENSITY * len(block.text):
        return None if block.article and len(block.text) > SHORT else False
    size = len(block.text) + 2 * len(_WIDE.findall(block.text))
    if block.heading or size < SHORT:
        return None
    if not known:
        return True
    density = _density(block.text)
    if density >= STOP_DENSITY_HIGH:
        return True
    if density >= STOP_DENSITY_LOW and len(block.text) >= LONG:
        return True
    return None if block.article or len(block.text) < LONG else False


def _density(text: str) -> float:
    words = [w.lower() for w in _LETTERS.findall(text)]
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _settle_article(blocks: list[Block]) -> None:
    """Mark as furniture what stands under a heading of reader comments outside the article, and, if the page's articles
    hold a third of its running text or more, all that stands outside them."""
    comments = False
    for block in blocks:
        if block.heading:
            words = [w.lower() for w in _LETTERS.findall(block.text)]
            comments = len(words) <= 3 and not _COMMENTS.isdisjoint(words)
        block.furniture = block.furniture or (comments and not block.article)
    inside = outside = 0
    for block in blocks:
        if not block.furniture and len(block.text) >= SHORT:
            size = len(block.text) - block.linked
            inside, outside = inside + size * block.article, outside + size * (not block.article)
    if inside >= LONG and 2 * inside >= outside:
        for block in blocks:
            block.furniture = block.furniture or not block.article


def main_text(page: str) -> str:
    """Content blocks of a page, joined by an empty line."""
    blocks = blocks_of(page)
    _settle_article(blocks)
    running = " ".join(b.text for b in blocks if not b.furniture and b.linked <= LINK_DENSITY * len(b.text))
    known = _density(running) >= STOP_DENSITY_LOW / 2
    labels = [decide(b, known) for b in blocks]
    final = list(labels)
    before, last = [], None
    for i, label in enumerate(labels):
        last = i if label is not None else last
        before.append(last)
    after: int | None = None
    for i in range(len(blocks) - 1, -1, -1):
        if labels[i] is not None:
            after = i
            continue
        final[i] = _inherited(blocks, labels, i, before[i], after)
    return "\n\n".join(b.text for b, keep in zip(blocks, final, strict=True) if keep)


def _inherited(blocks: list[Block], labels: list[bool | None], i: int, before: int | None, after: int | None) -> bool:
    """Second pass. Inside a marked article only blocks of the article count as neighbours; alone there, it is content."""
    if blocks[i].article:
        before = before if before is not None and blocks[before].article and not blocks[before].furniture else None
        after = after if after is not None and blocks[after].article and not blocks[after].furniture else None
        if before is None and after is None:
            return True
    if before is None and after is None:
        return not blocks[i].heading and blocks[i].linked == 0
    if before is None or after is None:
        return bool(labels[after if before is None else before])
    if i - before == after - i and labels[before] != labels[after]:
        return blocks[after if labels[before] else before].furniture
    return bool(labels[before if i - before < after - i else after])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text (empty if there is none; for null, too), and ``n_chars``, its code points.

    Columns of these names are replaced; the html is left out. Every page is read whole, wherever its markup ends.
    """
    kept = [c for c in pages.columns if c.lower() not in (html_column.lower(), "text", "n_chars")]
    source = next(c for c in pages.columns if c.lower() == html_column.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "") for page in batch.column(source).to_pylist()]
            columns = [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "text", "n_chars"])

    named = [f"`{c}`" for c in kept]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*named).schema] + ["text string", "n_chars long"])
    return pages.select(*named, f"`{source}`").mapInArrow(run, schema)
