"""One HTML page as containers and blocks of text; used inside tasks."""

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Fixed values of HTML: elements by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp template noembed noframes svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var br img wbr".split()
)
CONTAINERS = frozenset("html body main article section div center td table tbody tr blockquote".split())
# What a start tag ends if it is still open, up to the given limits.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# What is not article, by element, role and words of class and id.
DROPPED = frozenset("nav footer aside form button select dialog menu object canvas audio video head".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split()
)
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside footer masthead "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login "
    "share sharing social related recommended widget widgets toolbar "
    "comment comments commentlist disqus respond replies form search hidden skip".split()
)
# A page's header, as against that of an article: the word alone or with one of these before it.
HEADER_OF = frozenset("site page top main global".split())
WRAPPER_WORDS = frozenset({"has", "no", "with", "without"})
# Article elements are kept whatever their class says, and headers inside them.
ARTICLE = frozenset({"article", "main"})

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*?)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Containers that are nested deeper count as the one at this depth, which bounds paths.
DEEPEST = 200

# A winning path with less than this share of a strange container's text does not stand for the article.
LEAST_SHARE = 0.25
RIGHTS = re.compile(r"(?i)\s*(?:©|\(c\) |copyright\b|all rights reserved)")

WEIGHTS = {"article": 1.25, "main": 1.2, "body": 0.8, "html": 0.7}


def attributes(rest):
    found = {}
    for match in ATTRIBUTE.finditer(rest):
        name, *values = match.groups()
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v is not None), "")))
    return found


@dataclass
class Element:
    tag: str
    node: int
    dropped: bool
    in_article: bool
    in_link: bool


@dataclass
class Page:
    """`paths`, `parents`, `tags` by container; `blocks` as (container, text, characters in links, is the page's title)."""

    paths: list = field(default_factory=list)
    parents: list = field(default_factory=list)
    tags: list = field(default_factory=list)
    blocks: list = field(default_factory=list)

    def held(self):
        """Characters outside links in each container."""
        held = [0] * len(self.paths)
        for node, text, linked, _ in self.blocks:
            held[node] += max(0, len(text) - linked)
        for node in range(len(held) - 1, 0, -1):
            held[self.parents[node]] += held[node]
        return held

    def best(self):
        """Number and score of the container that holds most text outside links, by kind of element."""
        scores = [h * WEIGHTS.get(tag, 1.0) for h, tag in zip(self.held(), self.tags, strict=True)]
        # Of equal ones the innermost.
        node = max(range(len(scores)), key=lambda n: (scores[n], n))
        return node, scores[node]

    def _inside(self, chosen):
        """Whether each block stands below any of the chosen containers."""
        inside = [node in chosen for node in range(len(self.paths))]
        for node in range(1, len(inside)):
            inside[node] = inside[node] or inside[self.parents[node]]
        return [inside[block[0]] for block in self.blocks]

    def _ancestors(self, chosen):
        above = set()
        for node in chosen:
            while node:
                node = self.parents[node]
                if node in above:
                    break
                above.add(node)
        return above

    def text_under(self, chosen):
        """The chosen containers' blocks in page order, and those around that belong to the same run.

        That is text which stands next to them straight in an element around them, and titles just
        before, unless most of it is links or it names the holder of rights.
        """
        taken, above = self._inside(chosen), self._ancestors(chosen)

        def joins(place, title):
            node, text, linked, is_title = self.blocks[place]
            return (node in above or (title and is_title)) and 2 * linked <= len(text) and not RIGHTS.match(text)

        for place in range(len(taken) - 2, -1, -1):
            taken[place] = taken[place] or (taken[place + 1] and joins(place, title=True))
        for place in range(1, len(taken)):
            taken[place] = taken[place] or (taken[place - 1] and joins(place, title=False))
        return "\n\n".join(block[1] for block, keep in zip(self.blocks, taken, strict=True) if keep)

    def extract(self, paths=(), votes=(), losers=()):
        """The article by a host's winning paths.

        Of those on the page the one that holds most text outside links, weighed by votes. The page's
        own best container stands in where there is none, or where the winner holds little
        beside one that the host's other pages do not have; one that they have and that lost there
        (`losers`) is no article here either.
        """
        held, found = self.held(), []
        for rank, path in enumerate(paths):
            nodes = {n for n, own in enumerate(self.paths) if own == path}
            if any(self._inside(nodes)):
                outer = [n for n in nodes if not self._ancestors({n}) & nodes]
                size = sum(held[n] for n in outer)
                found.append((size * (votes[rank] if votes else 1), -rank, size, nodes))
        best, _ = self.best()
        if not found:
            return self.text_under({best})
        _, _, size, nodes = max(found, key=lambda f: f[:2])
        strange = self.paths[best] not in losers and self.paths[best] not in paths
        return self.text_under({best} if strange and size < LEAST_SHARE * held[best] else nodes)


def step_of(tag, given):
    """An element's part of a path: tag and classes, with numbers generalised."""
    classes = sorted({re.sub(r"[0-9]+", "N", c) for c in given.get("class", "").lower().split()})
    return ".".join([tag, *classes])


def is_dropped(tag, given, in_article):
    if tag in ARTICLE or tag in ("html", "body"):
        return False
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if "hidden" in given or given.get("aria-hidden") == "true" or HIDDEN_STYLE.search(given.get("style", "")):
        return True
    if given.get("role", "").lower() in DROPPED_ROLES:
        return True
    for name in [*given.get("class", "").split(), *given.get("id", "").split()]:
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[0] in WRAPPER_WORDS:
            continue
        if words[0] in DROPPED_WORDS or words[-1] in DROPPED_WORDS:
            return True
        if not in_article and words[-1] in ("header", "topbar") and set(words[:-1]) <= HEADER_OF:
            return True
    return False


def parse(source):
    """The page's containers and the text blocks that are not in dropped elements."""
    page = Page(["html"], [0], ["html"], [])
    root = Element("html", 0, False, False, False)
    stack, pieces, linked = [root], [], 0
    depths, still_open = [0], Counter()

    def flush(node):
        nonlocal linked
        if pieces:
            if text := " ".join("".join(pieces).split()):
                page.blocks.append((node, text, min(linked, len(text)), still_open["h1"] > 0))
            pieces.clear()
        linked = 0

    def close(at):
        """End the elements from place `at` of the stack on."""
        if any(e.tag not in INLINE for e in stack[at:]):
            flush(stack[-1].node)
        still_open.subtract(e.tag for e in stack[at:])
        del stack[at:]

    def text(raw):
        nonlocal linked
        if raw and not stack[-1].dropped:
            decoded = html.unescape(raw)
            pieces.append(decoded)
            if stack[-1].in_link:
                linked += len(decoded.strip())

    at = 0
    while True:
        begin = source.find("<", at)
        match = TOKEN.match(source, begin) if begin >= 0 else None
        if begin < 0:
            text(source[at:])
            break
        if match is None:
            # A lone sign is text; `</` before anything else is a comment.
            if source.startswith("</", begin):
                text(source[at:begin])
                after = source.find(">", begin)
                at = len(source) if after < 0 else after + 1
            else:
                text(source[at : begin + 1])
                at = begin + 1
            continue
        text(source[at:begin])
        at = match.end()
        tag = match["tag"]
        if tag is None or not match[0].endswith(">"):
            continue  # A comment, a declaration, or a tag cut off by the page's end.
        tag = tag.lower()
        if match["end"]:
            place = 0
            if still_open[tag]:
                place = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag)
            if place:
                close(place)
            elif tag == "p":
                flush(stack[-1].node)
            continue
        if tag in RAW and not match[0].endswith("/>"):
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag == "br":
            text(" ")
        if tag in VOID:
            if tag == "hr":
                flush(stack[-1].node)
            continue
        if tag not in INLINE:
            # A block ends an open paragraph.
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag in CONTAINERS), 0)
            if place and stack[place].tag == "p":
                close(place)
            if tag in ENDS:
                ended, limits = ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in limits:
                        break
                    if stack[i].tag in ended:
                        close(i)
            flush(stack[-1].node)
        if tag == "html":
            continue
        given, top = attributes(match["rest"]), stack[-1]
        dropped = top.dropped or is_dropped(tag, given, top.in_article)
        node = top.node
        if tag in CONTAINERS and not dropped and depths[node] < DEEPEST:
            depths.append(depths[node] + 1)
            page.paths.append(f"{page.paths[node]}>{step_of(tag, given)}")
            page.parents.append(node)
            page.tags.append(tag)
            node = len(page.paths) - 1
        in_link = top.in_link or tag == "a"
        stack.append(Element(tag, node, dropped, top.in_article or tag in ARTICLE, in_link))
        still_open[tag] += 1
    flush(stack[-1].node)
    return page
