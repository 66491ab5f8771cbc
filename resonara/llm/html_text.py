"""Main text of web pages by tree scoring.

Every block of text earns points for its length and its commas and passes them to
the elements around it, less with each level; an element's points are discounted
by the share of its text that is link text.  The best container is kept whole
with those siblings that read like part of it.  Elements whose tag, role or name
marks them as menus, headers, footers, adverts, forms, notices or reader comments
take no part.  Inside the article a name counts only for containers that are named after
comments or look like noise as well, never for headings and paragraphs.  Markup is repaired as browsers do: implied ends, stray ends,
unclosed elements, cut-off pages.  Walks keep their own stack, so depth is no limit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("""
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary
    table tbody td tfoot th thead tr ul
""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_BLOCKS = HEADINGS | frozenset("p li td th pre blockquote dd dt figcaption caption summary".split())
NEVER_TEXT = RAW | frozenset("""
    head nav footer aside form noscript template button input select option datalist label fieldset legend menu dialog search
    svg canvas math audio video object embed applet map
""".split())
#: Elements that are only a part of what reads as one: a list or a table stays whole.
PARTS = HEADINGS | frozenset("p pre tr tbody thead tfoot ul ol dl".split())
ENDED_BY = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "option": frozenset({"option"}),
    "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
    "tbody": frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), "thead": frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}),
    "tfoot": frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), "body": frozenset({"head"}),
}
SCOPES = {"li": frozenset({"ul", "ol", "menu", "dir"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}), "option": frozenset({"select", "datalist"}),
          **dict.fromkeys(("tr", "td", "th", "tbody", "thead", "tfoot"), frozenset({"table"}))}
#: Words in class names and ids, and roles, of what surrounds an article.
NOISE_WORDS = frozenset("""
    ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted
    nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc toolbar topbar masthead
    header footer foot colophon copyright sidebar side aside rail widget widgets
    cookie cookies consent gdpr notice notices notification popup modal overlay alert paywall
    newsletter subscribe subscription signup login register form search share sharing social
    related recommended recommendations recommendation trending popular
    comment comments commentlist commentarea usercomments disqus discussion respond reply replies responses hidden skip
""".split())
#: Of these, the class names that tell an advert whatever it looks like, and the names of what is not shown.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted".split())
UNSEEN = frozenset("hidden skip".split())
#: Names of readers' comments, and what stands beside them in an id that names nothing else.
COMMENTS = frozenset("comment comments commentlist commentarea usercomments disqus respond reply replies responses".split())
COMMENT_PARTS = COMMENTS | frozenset("user reader readers section area list thread form box container wrapper block body the".split())
SHORT_BLOCK, FORM_TEXT = 40, 400
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())

_token = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.DOTALL)
_attribute = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_states = re.compile(r"\b(?:has|with|without|no|is)[-_][\w-]+")
_name_words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = ("tag", "parent", "children", "noise", "sure_noise", "named_noise", "role_noise", "advert", "unseen", "comment",
                 "points", "chars", "link_chars")

    def __init__(self, tag: str, parent: Element | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.points, self.chars, self.link_chars = 0.0, 0, 0
        self.noise, self.named_noise, self.role_noise, self.advert, self.unseen, self.comment = tag in NEVER_TEXT, False, False, False, False, False
        if attributes and not self.noise:
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attribute.finditer(attributes)}
            style = found.get("style", "").replace(" ", "").lower()
            names = _states.sub(" ", f"{found.get('class', '')} {found.get('id', '')}")
            words = {word.lower() for word in _name_words.findall(names)}
            self.noise = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
            self.role_noise = found.get("role", "").lower() in NOISE_ROLES
            self.named_noise = self.role_noise or not words.isdisjoint(NOISE_WORDS)
            if self.named_noise:
                classes = {word.lower() for word in _name_words.findall(_states.sub(" ", found.get("class", "")))}
                self.advert, self.unseen = not classes.isdisjoint(ADVERTS), not classes.isdisjoint(UNSEEN)
                # the id of a section may be its heading, which may be about replies
                self.comment = not classes.isdisjoint(COMMENTS) or not words.isdisjoint(COMMENTS) and (tag != "section" or words <= COMMENT_PARTS)
        if tag == "header":
            self.named_noise = self.role_noise = True
        self.sure_noise = self.noise

    def above(self) -> Iterator[Element]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent


def _parse(html: str) -> Element:
    root = Element("html", None)
    stack, at = [root], 0
    opened: Counter[str] = Counter()

    def text(piece: str) -> None:
        if piece:
            stack[-1].children.append(unescape(piece) if "&" in piece else piece)

    def close(tags: frozenset[str], scope: frozenset[str]) -> None:
        if not any(opened[tag] for tag in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in scope:
                return
            if stack[depth].tag in tags:
                opened.subtract(element.tag for element in stack[depth:])
                del stack[depth:]
                return

    while True:
        match = _token.search(html, at)
        if match is None:
            text(html[at:])
            return root
        text(html[at:match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if match[1] or match[4]:
            if tag in BLOCKS and tag not in ("body", "html"):
                close(frozenset({tag}), SCOPES.get(tag, frozenset()))
            elif tag not in BLOCKS:
                close(frozenset({tag}), BLOCKS)
            continue
        attributes = match[3] or match[6] or ""
        if tag == "html":
            continue
        if tag in BLOCKS:
            if tag in ENDED_BY:
                for _ in range(3 if tag[0] == "t" else 1):
                    close(ENDED_BY[tag], SCOPES.get(tag, frozenset()))
            close(frozenset({"p"}), frozenset({"td", "th", "button", "object", "caption", "table"}))
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                opened[stack.pop().tag] -= 1
        elif tag == "a":
            close(frozenset({"a"}), BLOCKS)
        element = Element(tag, stack[-1], attributes)
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, at)
            at = len(html) if end is None else end.start()
            if end is not None:
                at = html.find(">", at) + 1 or len(html)
        elif tag not in VOID and not (attributes.endswith("/") and tag in ("svg", "math", "path")):
            stack.append(element)
            opened[tag] += 1


def _sums(order: list[Element]) -> dict[int, tuple[int, int, int, int, int, bool]]:
    """For each element: characters, those in links, those outside headings, blocks of these, named children, whether it holds a form."""
    found: dict[int, tuple[int, int, int, int, int, bool]] = {}
    for element in reversed(order):
        own = sum(len(child.strip()) for child in element.children if isinstance(child, str))
        chars, links, prose, blocks, named, form = own, 0, own, int(own > 0 and element.tag in BLOCKS), 0, element.tag == "form"
        for child in element.children:
            if isinstance(child, str):
                continue
            below = found[id(child)]
            form = form or below[5]
            named += child.named_noise and child.tag not in TEXT_BLOCKS
            if not child.sure_noise:
                chars, links = chars + below[0], links + below[1]
                if child.tag not in HEADINGS:
                    prose, blocks, named = prose + below[2], blocks + below[3], named + below[4]
        found[id(element)] = chars, chars if element.tag == "a" else links, prose, blocks, named, form
    return found


def _looks_like_noise(element: Element, sums: tuple[int, int, int, int, int, bool]) -> bool:
    """Whether an element with the name of noise inside the article is noise: never a heading, a paragraph or a part of one.

    A container named after readers' comments always is, however many or long they are.
    """
    if element.tag in TEXT_BLOCKS:
        return element.tag == "li" and element.comment
    if element.comment and element.tag in BLOCKS:
        return True
    if element.tag not in BLOCKS and (element.parent.tag in TEXT_BLOCKS or element.parent.tag not in BLOCKS):
        return element.unseen
    chars, links, prose, blocks, named, form = sums
    return (element.advert or element.unseen or links >= 0.5 * chars or prose < SHORT_BLOCK * max(blocks, 1)
            or form and prose < FORM_TEXT or named >= 2)


def _mark_noise(root: Element, best: Element | None = None) -> None:
    """A name marks an element as noise unless it holds the article or the main heading.

    Inside an article, ``main`` or ``best`` it must look like noise too, and link
    lists stay unless a name or role marks them.  The header of an article itself
    stays; ``_blocks`` takes only its headings.
    """
    order, stack = [], [root]
    while stack:
        element = stack.pop()
        order.append(element)
        stack.extend(child for child in element.children if isinstance(child, Element))
    holders = set()
    for element in reversed(order):
        if element.parent is not None and (element.tag in ("article", "main") and not element.named_noise
                                           or element.tag == "h1" and element.parent.tag != "header" or id(element) in holders):
            holders.add(id(element.parent))
    inside: set[int] = set()
    in_article: set[int] = set()
    sums: dict[int, tuple[int, int, int, int, int, bool]] = {}
    for element in order:
        element.noise, element.points, element.chars, element.link_chars = element.sure_noise, 0.0, 0, 0
        around = element.parent
        if around is not None and (id(around) in inside or around is best or around.tag in ("article", "main") and not around.named_noise):
            inside.add(id(element))
            if around.tag == "article" and not around.named_noise or id(around) in in_article:
                in_article.add(id(element))
        if element.tag == "header" and any(above.tag in ("article", "main") for above in element.above()):
            continue
        named = element.named_noise
        if named and not element.role_noise and id(element) in inside:
            sums = sums or _sums(order)
            named = _looks_like_noise(element, sums[id(element)])
        # comments may be articles themselves, so an article inside another does not shield them
        held = id(element) in holders and not (element.comment and id(element) in in_article)
        if named and (not held or element.tag == "header") and element.tag not in ("main", "body", "html"):
            element.noise = True
        if element.tag in ("ul", "ol", "table") and not element.noise and id(element) not in holders and id(element) not in inside:
            links, chars, link_chars = _link_share(element)
            element.noise = links >= 3 and link_chars >= 0.8 * chars


def _link_share(element: Element) -> tuple[int, int, int]:
    links = chars = link_chars = 0
    stack = [(element, False)]
    while stack:
        at, linked = stack.pop()
        for child in at.children:
            if isinstance(child, str):
                size = len(child.strip())
                chars += size
                link_chars += size * linked
            elif not child.noise:
                links += child.tag == "a"
                stack.append((child, linked or child.tag == "a"))
    return links, chars, link_chars


def _blocks(root: Element) -> list[tuple[Element, str, int]]:
    """(block element, text, characters of it in links), in page order, without noise."""
    found: list[tuple[Element, str, int]] = []
    parts: list[str] = []
    owner, linked_chars, link_depth = root, 0, 0

    def flush(then: Element) -> None:
        nonlocal owner, linked_chars
        text = " ".join("".join(parts).split())
        if text and (owner.tag in HEADINGS or not any(e.tag == "header" for e in (owner, *owner.above()))):
            found.append((owner, text, linked_chars))
        parts.clear()
        owner, linked_chars = then, 0

    stack: list[tuple[Element, Iterator]] = [(root, iter(root.children))]
    while stack:
        element, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            link_depth -= element.tag == "a"
            if element.tag in BLOCKS and stack:
                block = next((e for e, _ in reversed(stack) if e.tag in BLOCKS), root)
                flush(block)
        elif isinstance(child, str):
            parts.append(child)
            linked_chars += len(child.strip()) if link_depth else 0
        elif child.noise:
            if child.tag in BLOCKS:
                flush(owner)
        elif child.tag in VOID:
            parts.append(" ") if child.tag != "hr" else flush(owner)
        else:
            if child.tag in BLOCKS:
                flush(child)
            link_depth += child.tag == "a"
            stack.append((child, iter(child.children)))
    flush(root)
    return found


def _best(root: Element, blocks: list[tuple[Element, str, int]]) -> Element:
    scored: dict[int, Element] = {}
    for owner, text, linked in blocks:
        size = len(text)
        points = min(size / 25, 1) + min(size / 100, 3) + text.count(",")
        around = [owner, *owner.above()]
        holders = around[1:] if owner.tag in TEXT_BLOCKS and owner.parent is not None else around
        for level, holder in enumerate(holders):
            if level < 5:
                holder.points += points * (1, 0.5, 1 / 6, 1 / 9, 1 / 12)[level]
                scored.setdefault(id(holder), holder)
        for holder in around:
            holder.chars += size
            holder.link_chars += linked
    def score(element):
        return element.points * (1 - min(element.link_chars / max(element.chars, 1), 1)) * (1.5 if element.tag in ("article", "main") else 1)
    return max(scored.values(), key=score, default=root)


def _kept(best: Element, blocks: list[tuple[Element, str, int]]) -> list[Element]:
    """The best container, or the article around it, and the siblings that belong to it."""
    for element in (best, *best.above()):
        if element.tag in ("article", "main"):
            best = element
            break
    while best.tag in PARTS and best.parent is not None:
        best = best.parent
    kept = [best]
    for sibling in best.parent.children if best.parent is not None else ():
        if isinstance(sibling, Element) and sibling is not best and not sibling.noise and sibling.chars:
            density = sibling.link_chars / sibling.chars
            if sibling.tag in HEADINGS or sibling.tag == "p" and density < 0.25 \
                    or sibling.points * (1 - density) >= max(0.2 * best.points, 2):
                kept.append(sibling)
    if not any(owner.tag == "h1" and not {id(e) for e in (owner, *owner.above())}.isdisjoint(map(id, kept)) for owner, _, _ in blocks):
        titles = [owner for owner, _, _ in blocks if owner.tag == "h1"]
        kept.extend(titles[:1])
    return kept


def main_text(html: str) -> str:
    """The article of a page, one line for each block; empty if there is none."""
    root = _parse(html)
    _mark_noise(root)
    blocks = _blocks(root)
    if not blocks:
        return ""
    best = _best(root, blocks)
    if best.tag not in ("article", "main", "body", "html") and not any(e.tag in ("article", "main") for e in best.above()):
        while best.tag in PARTS and best.parent is not None:
            best = best.parent
        if best.tag not in ("body", "html"):
            _mark_noise(root, best)
            blocks = _blocks(root)
            best = _best(root, blocks)
    kept = {id(element) for element in _kept(best, blocks)}
    inside: dict[int, bool] = {}
    lines = []
    for owner, text, _ in blocks:
        if id(owner) not in inside:
            inside[id(owner)] = any(id(element) in kept for element in (owner, *owner.above()))
        if inside[id(owner)]:
            lines.append(text)
    return "\n".join(lines)


@F.arrow_udf(StringType())
def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Main text of each whole page; null and empty pages give the empty text."""
    for batch in batches:
        yield pa.array([main_text(value.as_py() or "") for value in batch], pa.string())
