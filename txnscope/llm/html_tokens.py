"""HTML cut into tokens and blocks; shared by the wrapper and the WARC operators."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

#: Elements whose content is no text of the page.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe")
#: Embedded elements and those of formulas and drawings, read like inline ones: they end no block and
#: need no closing tag, so a self-closed or unclosed one hides nothing.
EMBEDDED = frozenset(
    "svg math object canvas maction maligngroup malignmark menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn "
    "mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder "
    "munderover none semantics annotation annotation-xml g defs symbol use path rect circle ellipse line polyline polygon "
    "text tspan textpath image marker mask pattern clippath filter lineargradient radialgradient stop desc view switch "
    "foreignobject animate animatetransform animatemotion set mpath param".split())
#: Elements that do not end a block of text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark "
                   "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()) | EMBEDDED
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag of the same kind ends where the closing tag is left out.
SELF_CLOSING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Block elements that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main menu nav ol p pre section table ul".split())

_RAW = "|".join(RAW)
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))"
    rf"|<({_RAW})(?=[\s/>])((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|[^>]*>).*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', raw text, ''), ('open', name, attributes) and ('close', name, '') in page order; raw elements without
    their content."""
    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at:m.start()], ""
        at = m.end()
        name = m.group(4) or m.group(7)
        if m.group(1):
            yield "open", m.group(1).lower(), m.group(2)[:-1]
            yield "close", m.group(1).lower(), ""
        elif name:
            if m.group(3) or m.group(6):
                yield "close", name.lower(), ""
            else:
                yield "open", name.lower(), m.group(5) or m.group(8) or ""
    if at < len(page):
        yield "text", page[at:], ""


def clean(raw: str) -> str:
    """Character references decoded, white space as single spaces, ends cut."""
    return " ".join((html.unescape(raw) if "&" in raw else raw).split())


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(raw)}


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str]]:
    """(path, text) of each non-empty block: the labels of the open elements, outermost first, and the clean text.

    A label is the element's name, with its class, id and role where it has any.
    Inline elements do not end a block; left-out closing tags are supplied."""
    names: list[str] = []
    labels: list[str] = []
    held: list[str] = []

    def flush():
        text = clean("".join(held))
        held.clear()
        return text

    for kind, a, b in tokens(page):
        if kind == "text":
            held.append(a)
        elif a in INLINE or a in RAW:
            if a == "br":
                held.append(" ")
        else:
            if held and (text := flush()):
                yield tuple(labels), text
            if kind == "open":
                ends = SELF_CLOSING.get(a, ()) + (("p",) if a in ENDS_P else ())
                if names and names[-1] in ends:
                    names.pop(), labels.pop()
                if a not in VOID and not (a == "title" and b.endswith("/")):
                    names.append(a)
                    labels.append(label(a, b))
            elif a in names:
                k = len(names) - 1 - names[::-1].index(a)
                del names[k:], labels[k:]
    if held and (text := flush()):
        yield tuple(labels), text


def label(name: str, raw: str) -> str:
    if "=" not in raw:
        return name
    got = attributes(raw)
    more = [f"{k}={' '.join(got[k].lower().split())}" for k in ("class", "id", "role") if got.get(k)]
    if "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "").lower():
        more.append("hidden")
    return f"{name}[{';'.join(more)}]" if more else name
