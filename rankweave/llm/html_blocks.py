"""Text blocks of an HTML page, with the tags and names they stand under."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
# Elements whose text is never shown, or is a control.
HIDDEN = frozenset(
    "script style noscript template title textarea select button svg math iframe object audio video canvas "
    "datalist noframes noembed xmp".split()
)
# Hidden elements with no markup inside, and those that reach to the end of the page where no end tag comes.
RAW = frozenset("script style title textarea iframe noframes noembed xmp".split())
TO_END = frozenset("script style title textarea".split())
# What can stand in a head. Its end tag may be left out; then another tag ends it.
IN_HEAD = frozenset("head base basefont bgsound link meta title style script noscript noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open element of these ends where one of the others begins.
_CLOSED_BY = {"p": BLOCK, "li": {"li"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"},
              "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*+)(?:>|\Z)",
    re.S,
)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """Text of a leaf block, white space as single spaces, and what it stands under."""

    text: str
    path: tuple[str, ...]
    names: str
    linked: int = 0


@dataclass
class _Open:
    tag: str
    names: str = ""
    holds: list = field(default_factory=list)


def _marks(page: str) -> tuple[list[tuple], dict[int, int]]:
    """Markup of a page as (begin, end, slash, tag, rest), and where hidden elements end, by the number of their tag.

    An end tag belongs to the last open element of its name. Elements that are
    never closed are not listed, so that only their tag is hidden, but for those
    that reach to the end of the page.
    """
    marks: list[tuple] = []
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {tag: [] for tag in HIDDEN}
    never: set[str] = set()
    at = 0
    while found := _MARKUP.search(page, at):
        at = found.end()
        close, tag, rest = found[1], found[2], found[3]
        if tag is None:
            close, tag, rest = found[4], found[5], found[6]
        if tag is None:
            marks.append((found.start(), at, "", None, found[0]))
            continue
        tag = tag.lower()
        marks.append((found.start(), at, close, tag, rest))
        if tag not in HIDDEN:
            continue
        if close:
            if opened[tag]:
                ends[opened[tag].pop()] = at
        elif rest.endswith("/"):
            continue
        elif tag not in RAW:
            opened[tag].append(len(marks) - 1)
        elif tag not in never:
            end = _ENDS[tag].search(page, at)
            if end or tag in TO_END:
                at = ends[len(marks) - 1] = end.end() if end else len(page)
            else:
                never.add(tag)
    return marks, ends


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a whole page in order; unclosed and stray tags are let pass."""
    page = page or ""
    out: list[Block] = []
    stack: list[_Open] = []
    pieces: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            names = " ".join(o.names for o in stack if o.names)
            out.append(Block(text, tuple(o.tag for o in stack), names, min(linked, len(text))))
        pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                linked += len(text.strip())

    at, head = 0, None
    marks, ends = _marks(page)
    for i, (begin, end, close, tag, rest) in enumerate(marks):
        if begin < at:
            continue
        add(page[at:begin])
        at = end
        if tag is None:
            if rest.startswith("<![CDATA["):
                add(rest[9:].removesuffix("]]>"))
            continue
        if head is not None and tag not in IN_HEAD and (not close or tag in ("body", "html", "br")):
            head = None
        if tag == "head":
            if not close:
                head = len(pieces)
            elif head is not None:
                del pieces[head:]
                head = None
        elif tag in HIDDEN:
            # The text of a hidden element goes up to its end tag.
            at = ends.get(i, at)
        elif tag == "a":
            links = 0 if close else 1
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCK:
            flush()
            if close:
                if any(o.tag == tag for o in stack):
                    while stack.pop().tag != tag:
                        pass
                links = 0
            elif tag not in VOID:
                while stack and tag in _CLOSED_BY.get(stack[-1].tag, ()):
                    stack.pop()
                names = " ".join(a or b or c for a, b, c in _NAMES.findall(rest)) if "=" in rest else ""
                stack.append(_Open(tag, names.lower()))
    add(page[at:])
    flush()
    return out
