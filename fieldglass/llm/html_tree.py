"""A forgiving HTML parser for main-text extraction: nested elements, marked as content or not, and blocks of text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape
from zlib import crc32

# Element names of HTML by their behaviour.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: An open element that the start of another one ends, and where the search for it stops.
ENDED_BY = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
NOT_CONTENT = frozenset("aside audio button canvas dialog footer form head iframe input menu nav noscript object option select svg template video".split()) | RAW
#: Words in a class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer foot comment comments respond reply "
    "replies disqus share sharing social related recommended widget toolbar pagination pager login signup search skip hidden complementary contentinfo".split()
)
#: Marks of a header: kept inside an article, where it holds the headline.
HEADER_MARKS = frozenset("header topbar".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Element:
    tag: str
    key: str = ""
    content: bool = True
    in_article: bool = False
    in_link: bool = False
    children: list = field(default_factory=list)  # elements and strings
    chars: int = 0
    link_chars: int = 0
    checksum: int = 0


def _attributes(source: str) -> tuple[str, set[str], bool]:
    """Class as written in a key, all words of class, id and role, and whether the element is hidden."""
    name, words, hidden = "", set(), False
    for kind, value in ATTRIBUTE.findall(source):
        kind, value = kind.lower(), value.strip("\"'").lower()
        if kind in ("class", "id", "role"):
            words.update(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", value)))
            if kind == "class" and value:
                name = "." + ".".join(sorted(re.sub(r"\d+", "", value).split()))
            elif kind == "id" and not name and value:
                name = "#" + re.sub(r"\d+", "", value)
        elif kind == "style":
            hidden |= "display:none" in value.replace(" ", "")
        else:
            hidden |= kind == "hidden" or value == "true"
    return name, words, hidden


def _element(tag: str, attributes: str, parent: Element) -> Element:
    name, words, hidden = _attributes(attributes) if len(attributes) > 5 else ("", set(), False)
    inside = parent.in_article or tag in ("article", "main") or "main" in words
    marked = bool(words & MARKS) and tag not in ("html", "body", "article", "main")
    heads = (tag == "header" or bool(words & HEADER_MARKS)) and not inside and tag not in ("html", "body")
    content = parent.content and not (tag in NOT_CONTENT or marked or heads or hidden)
    return Element(tag, tag + name, content, inside, parent.in_link or tag == "a")


def parse(html: str | None) -> Element:
    """The tree of a page. Anything is accepted; what is left open ends with its parent, stray ends are ignored."""
    html = html or ""
    root = Element("", "")
    stack, at = [root], 0
    while found := TOKEN.search(html, at):
        if found.start() > at:
            stack[-1].children.append(html[at : found.start()])
        at = found.end()
        tag = found["name"] and found["name"].lower()
        if not tag:
            continue
        if found["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break
            continue
        if tag in BLOCK:
            _close(stack, {"p"}, BLOCK - {"p"})
        if tag in ENDED_BY:
            names, stop = ENDED_BY[tag]
            _close(stack, set(names.split()), stop)
        new = _element(tag, found["attributes"], stack[-1])
        stack[-1].children.append(new)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID:
            stack.append(new)
    if at < len(html):
        stack[-1].children.append(html[at:])
    return root


def _close(stack: list[Element], names: set[str], stop: frozenset | set) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in names:
            del stack[i:]
            return
        if stack[i].tag in stop:
            return


def measure(root: Element) -> None:
    """Count the characters of content, and of those in links, below every element, with a checksum of the content; without recursion."""
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo += [c for c in element.children if not isinstance(c, str)]
    for element in reversed(order):
        own = sum(len(c.strip()) for c in element.children if isinstance(c, str)) if element.content else 0
        below = [c for c in element.children if not isinstance(c, str)]
        element.chars = own + sum(c.chars for c in below)
        element.link_chars = (own if element.in_link else 0) + sum(c.link_chars for c in below)
        parts = [" ".join(c.split()) if isinstance(c, str) else f"<{c.checksum}>" for c in element.children if isinstance(c, str) or (c.content and c.chars)]
        element.checksum = crc32("".join(parts).encode("utf-8", "replace"))


def blocks(region: Element) -> list[str]:
    """Texts of the blocks of a region in page order, references decoded and white space made one space."""
    found: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            found.append(text)

    todo: list = [region]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(unescape(item))
        elif item.content:
            if item.tag in ("br", "td", "th"):
                held.append(" ")
            if item.tag in BLOCK:
                flush()
                todo.append(None)
            todo += reversed(item.children)
    flush()
    return found
