"""Main text of web pages by tree scoring.

Paragraphs earn points for their length and commas and pass them to their parent in full, to the next ancestors in
shrinking shares. A container's points are discounted by the share of its text that stands in links. The best container is
kept, with its siblings that read like part of it, and its text is given block by block.

Elements with names of boilerplate, and forms, are dropped before that, unless the page's article stands in them. Inside an
article a name that also fits a part of a text, such as "discussion", drops an element only if it does not read like prose.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_batches, rows_in

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template svg canvas iframe object audio video head title nav footer aside form button "
    "select textarea input label fieldset menu dialog map annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
#: These too stand inside a line: neither they nor what is in them ends a block.
PHRASING = INLINE | frozenset(
    "script style noscript template svg canvas iframe object audio video picture map button select textarea input label "
    "output progress meter embed param source track area link meta annotation annotation-xml".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td dd li".split())
LISTED = {  # items: the elements that they end, and those that bound them
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")), "td": (("td", "th"), ("tr",)), "th": (("td", "th"), ("tr",)),
    "option": (("option",), ("select",)),
}
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
PARTS = (
    r"nav(?:bar|igation)?|menu|top-?bar|masthead|site-?header|page-?header|footer|site-?footer|side-?bar|aside|notices?|alerts?|"
    r"cookies?|gdpr|consent|banner|ads?|advert\w*|adsense|promo\w*|sponsor\w*|comments?|comment-?(?:list|section|form)|"
    r"commentlist|disqus|replies|respond|form|login|sign-?up|subscribe|newsletter|share|sharing|breadcrumbs?|pagination|pager|"
    r"popup|modal|overlay|skip-?link|toolbar")
#: Names of boilerplate around an article that inside one may name a part of the text.
TOPICS = r"header|rail|discussion|responses|social|related|recommend\w*|widget|copyright"


def _named(names: str) -> re.Pattern[str]:
    return re.compile(rf"(?:^|[^a-z0-9])(?:{names})(?:$|[^a-z0-9])")


BOILERPLATE, PART_NAME = _named(f"{PARTS}|{TOPICS}"), _named(PARTS)
#: Names that say what the page around an element has or allows, not what the element is.
STATE = re.compile(r"(?:has|have|no|with|without|show|hide)[-_].*|.*[-_](?:enabled|disabled|open|closed)")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
CONTAINERS = frozenset(("article", "main"))

#: Points: one per paragraph, one per comma, one per this many characters up to the limit.
POINT_CHARS, POINT_LIMIT = 100, 3
PARAGRAPH_CHARS = 25
#: Siblings with this share of the best points, or paragraphs of this length with few links, are kept.
SIBLING_SHARE, SIBLING_CHARS, SIBLING_LINKS = 0.2, 80, 0.25
#: A list or section inside the article with more of its text in at least three links is a menu, unless most of the links lead
#: to other sites or their texts are as long as a paragraph's on average: such a list names sources.
MENU_LINKS = 0.6


EXACT, PART, TOPIC = 1, 2, 3


def _spaced(names: str) -> str:
    return re.sub(r"[_\s]+", " ", names).lower()


class Tree(HTMLParser):
    """Elements in page order with their parents, and their texts with block borders between them (``None``)."""

    def __init__(self, host: str = "") -> None:
        super().__init__(convert_charrefs=True)
        self.host = host
        self.tags, self.parents, self.dropped = ["#page"], [-1], [False]
        self.named, self.away = [0], [False]
        self.stack = [0]
        # where in the stack the open elements of a name stand, and those that are not inline: no search of a deep stack
        self.open: dict[str, list[int]] = {}
        self.blocks = [0]
        self.texts: list[tuple[int, str | None]] = []

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.tags[self.stack.pop()]
            self.open[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            self._border(tag)

    def _border(self, tag: str) -> None:
        if tag not in PHRASING and not self.dropped[self.stack[-1]]:
            self.texts.append((0, None))

    def _innermost(self, *tags: str) -> int:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _implied_ends(self, tag: str) -> None:
        """What a start tag ends: an open paragraph, or the previous item of the same list, row or table."""
        if tag in LISTED:
            ended, borders = LISTED[tag]
            depth = self._innermost(*ended)
            if depth > self._innermost(*borders):
                self._close_to(depth)
        elif tag not in PHRASING and tag != "br":
            depth = self.blocks[-1]
            if depth and self.tags[self.stack[depth]] == "p":
                self._close_to(depth)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._implied_ends(tag)
        if tag == "br":
            self.texts.append((self.stack[-1], " "))
        else:
            self._border(tag)
        if tag in VOID:
            return
        parent = self.stack[-1]
        at = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(self.dropped[parent] or self._is_boilerplate(tag, dict(attrs)))
        self.named.append(0 if self.dropped[at] else self._boilerplate_name(tag, dict(attrs)))
        self.away.append(tag == "a" and self._leads_away(dict(attrs).get("href") or ""))
        self.open.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(at)

    def _leads_away(self, href: str) -> bool:
        return re.match(r"\s*(?:https?:)?//", href, re.IGNORECASE) is not None and _host(href.strip()) != self.host

    def _is_boilerplate(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in SKIPPED and tag != "form" or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        if (attrs.get("role") or "").lower() in BOILERPLATE_ROLES or HIDDEN.search(attrs.get("style") or ""):
            return True
        # that of the article holds its headline
        return tag == "header" and not self._innermost(*CONTAINERS)

    def _boilerplate_name(self, tag: str, attrs: dict[str, str | None]) -> int:
        """Whether a name of the element is one of boilerplate (``EXACT``) or holds one (``PART``, so does a form), or 0;
        ``TOPIC`` if it stands in an article and its names may be those of a part of the text."""
        if tag == "header":
            return 0
        if tag in ("html", "body", "article", "main", *HEADINGS):
            names = attrs.get("class") or "" if tag == "article" else ""
        else:
            names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        found = PART if tag == "form" else 0
        if names.strip() and BOILERPLATE.search(_spaced(names)):
            tokens = [t for t in names.lower().split() if not STATE.fullmatch(t)]
            spaced = _spaced(" ".join(tokens))
            if tag != "form" and self._innermost(*CONTAINERS) and BOILERPLATE.search(spaced) and not PART_NAME.search(spaced):
                return TOPIC
            if any(BOILERPLATE.fullmatch(_spaced(t)) for t in tokens):
                return EXACT
            if BOILERPLATE.search(spaced):
                return PART
        return found

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self._innermost("svg", "math"):
            self._close_to(len(self.stack) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.texts.append((self.stack[-1], " "))
        depth = self._innermost(tag)
        # an inline element does not end the block inside which it was left open
        if depth and (tag not in INLINE or depth > self.blocks[-1]):
            self._close_to(depth)

    def handle_data(self, data: str) -> None:
        self.texts.append((self.stack[-1], data))


def _host(url: str) -> str:
    try:
        return (urlsplit(url).hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def _parse(html: str, url: str | None = None) -> Tree:
    tree = Tree(_host(url or ""))
    tree.feed(html)
    tree.close()
    return tree


def _sizes(tree: Tree) -> tuple[list[int], list[int], list[int], list[int], list[int]]:
    """Per element, with what stands in it: characters, characters in links, commas, links, and its own characters."""
    count = len(tree.tags)
    chars, linked, commas, links, own = ([0] * count for _ in range(5))
    in_link = [False] * count
    for i in range(1, count):
        in_link[i] = in_link[tree.parents[i]] or tree.tags[i] == "a"
        links[i] = tree.tags[i] == "a"
    for at, text in tree.texts:
        if text and not tree.dropped[at]:
            size = len(" ".join(text.split()))
            own[at] += size
            chars[at] += size
            linked[at] += size if in_link[at] else 0
            commas[at] += text.count(",") + text.count("、") + text.count("，")
    for i in range(count - 1, 0, -1):
        if not tree.dropped[i]:
            for values in (chars, linked, commas, links):
                values[tree.parents[i]] += values[i]
            if tree.tags[i] in INLINE:
                own[tree.parents[i]] += own[i]
    return chars, linked, commas, links, own


def _earned(tree: Tree, sizes: tuple[list[int], ...]) -> list[float]:
    """What each element that is a paragraph, or has text of its own like one, earns."""
    chars, _, commas, _, own = sizes
    earned = [0.0] * len(tree.tags)
    for i, tag in enumerate(tree.tags):
        if tree.dropped[i] or i == 0 or tag in INLINE or tag in HEADINGS:
            continue
        text = chars[i] if tag in PARAGRAPHS else own[i]
        if text < PARAGRAPH_CHARS:
            continue
        earned[i] = 1 + commas[i] * (1 if tag in PARAGRAPHS else own[i] / max(chars[i], 1)) + min(text / POINT_CHARS, POINT_LIMIT)
    return earned


def _drop_named(tree: Tree) -> None:
    """Drop the elements with names of boilerplate in which the page's article does not stand.

    It stands in one that has a main element, or the page's articles and most of its paragraph points. If the name only holds
    a word of boilerplate, most of the points are enough, or the page's only article. What the article holds under the name of
    a topic stays if it reads like prose: few links, and neither forms nor comments in it.
    """
    for kind in (EXACT, PART):
        if kind not in tree.named:
            continue
        count = len(tree.tags)
        inside = _earned(tree, _sizes(tree))
        real = [t in CONTAINERS and not tree.dropped[i] and not tree.named[i] for i, t in enumerate(tree.tags)]
        articles, mains = [int(x) for x in real], [int(x and t == "main") for x, t in zip(real, tree.tags, strict=True)]
        for i in range(count - 1, 0, -1):
            for values in (inside, articles, mains):
                values[tree.parents[i]] += values[i]
        for i in range(1, count):
            if tree.named[i] == kind and not tree.dropped[i]:
                most, whole = 2 * inside[i] > inside[0], articles[i] == articles[0] > 0
                held = most or whole and articles[i] == 1 if kind == PART else mains[i] > 0 or whole and most
                tree.dropped[i] = not held
            tree.dropped[i] = tree.dropped[i] or tree.dropped[tree.parents[i]]
    if TOPIC in tree.named:
        chars, linked = _sizes(tree)[:2]
        thread = [tree.dropped[i] and tree.named[i] in (EXACT, PART) for i in range(len(tree.tags))]
        for i in range(len(tree.tags) - 1, 0, -1):
            thread[tree.parents[i]] |= thread[i]
        for i in range(1, len(tree.tags)):
            if tree.named[i] == TOPIC:
                prose = chars[i] >= PARAGRAPH_CHARS and linked[i] <= SIBLING_LINKS * chars[i] and not thread[i]
                tree.dropped[i] = tree.dropped[i] or not prose
            tree.dropped[i] = tree.dropped[i] or tree.dropped[tree.parents[i]]


def _other_articles(tree: Tree, best: int, points: list[float], sizes: tuple[list[int], ...]) -> set[int]:
    """Articles beside the best one that read like it: with enough points, few links, and a headline that is no link."""
    chars, linked = sizes[:2]
    count = len(tree.tags)
    teaser = [
        t in HEADINGS and chars[i] > 0 and linked[i] == chars[i] and not tree.dropped[i] for i, t in enumerate(tree.tags)]
    for i in range(count - 1, 0, -1):
        teaser[tree.parents[i]] |= teaser[i]
    return {
        i for i in range(1, count)
        if i != best and tree.tags[i] == "article" and not (tree.dropped[i] or teaser[i])
        and points[i] >= SIBLING_SHARE * points[best] and linked[i] <= SIBLING_LINKS * chars[i]
    }


def _points(tree: Tree, sizes: tuple[list[int], ...]) -> list[float]:
    chars, linked = sizes[:2]
    points = [0.0] * len(tree.tags)
    for i, (tag, earned) in enumerate(zip(tree.tags, _earned(tree, sizes), strict=True)):
        if not earned:
            continue
        if tag not in PARAGRAPHS:
            points[i] += earned
        above, share = tree.parents[i], 1.0
        for level in range(1, 5):
            if above <= 0:
                break
            points[above] += earned * share
            above, share = tree.parents[above], 1.0 / (2 * level)
    return [x * (1 - linked[i] / max(chars[i], 1)) for i, x in enumerate(points)]


def main_text(html: str | None, url: str | None = None) -> str:
    """The article's blocks, one per line; empty if there is none. By ``url`` links to the page's own site are known."""
    if not html:
        return ""
    tree = _parse(html, url)
    _drop_named(tree)
    sizes = _sizes(tree)
    chars, linked, _, links, _ = sizes
    points = _points(tree, sizes)
    count = len(tree.tags)
    best = max((i for i in range(count) if not tree.dropped[i]), key=lambda i: (points[i], -i))
    if points[best] <= 0:
        kept = {0}
    else:
        above = best
        while above > 0 and tree.tags[above] not in CONTAINERS:
            above = tree.parents[above]
        if above > 0:
            best = above
        else:  # no article element: go up while other parts of the parent add as much as a sibling must have
            while (up := tree.parents[best]) > 0 and tree.tags[up] not in ("body", "html") and points[up] >= points[best] * (0.5 + SIBLING_SHARE):
                best = up
        kept = {best}
        if tree.tags[best] == "article":
            kept |= _other_articles(tree, best, points, sizes)
        if tree.tags[best] not in CONTAINERS and tree.parents[best] >= 0:
            for i in range(1, count):
                if tree.parents[i] == tree.parents[best] and not tree.dropped[i] and i != best:
                    few_links = linked[i] <= SIBLING_LINKS * chars[i]
                    if points[i] >= SIBLING_SHARE * points[best] or few_links and (
                            tree.tags[i] in HEADINGS or tree.tags[i] in PARAGRAPHS and chars[i] >= SIBLING_CHARS):
                        kept.add(i)
    away = [int(x and not tree.dropped[i]) for i, x in enumerate(tree.away)]
    for i in range(count - 1, 0, -1):
        away[tree.parents[i]] += away[i]
    inside = [False] * count
    for i in range(count):
        menu = (
            tree.tags[i] in ("ul", "ol", "div", "section", "table", "dl") and links[i] >= 3
            and linked[i] > MENU_LINKS * chars[i] and 2 * away[i] <= links[i] and linked[i] < PARAGRAPH_CHARS * links[i]
        )
        inside[i] = not tree.dropped[i] and (i in kept or i > 0 and inside[tree.parents[i]] and not menu)
    blocks, block = [], []
    for at, text in [*tree.texts, (0, None)]:
        if text is None:
            if words := " ".join("".join(block).split()):
                blocks.append(words)
            block = []
        elif inside[at]:
            block.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (``page_id, url, html``; other columns are ignored) ``page_id, url, text, n_chars``.

    ``text`` is empty for a null or empty html and for a page without text outside its menus and the like. Pages are taken
    one by one, so repeated rows give repeated results; an empty table gives none. Elements are kept in flat lists, so the depth
    of a page does not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, url) for html, url in rows_in(batch, "html", "url")]
            yield pa.record_batch([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(rows, run, "page_id bigint, url string, text string, n_chars bigint")
