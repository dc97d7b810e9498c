"""Text blocks of a web page, in page order, with the tags they lie in.

The markup is scanned once, in time proportional to the page, whatever it holds
(unclosed quotes, elements and comments without end).
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

#: Buckets of the hashed tag-path tokens.
PATH_BUCKETS = 4096

#: Enclosing tags that a block's path names at most: the innermost ones.
DEPTH = 64

# Parts of the markup, each matched at one place and without backtracking. Quoted
# values may hold '>'; a quote that is still open at the next '<' is not one.
_OPEN = re.compile(r"<(/?)([a-z][a-z0-9:-]*+)", re.IGNORECASE)
_ATTRS = re.compile(r"""[^<>"']*+(?:(?:"[^"<]*+"|'[^'<]*+')[^<>"']*+)*+>""")
# Elements whose content is no text, up to their end tag or the page's end.
_RAW = {t: re.compile(rf"</{t}\s*+>", re.IGNORECASE) for t in ("script", "style", "template")}
# Page markup, before which a drawing that holds no text must have ended.
_PAGE_TAG = re.compile(
    r"<svg\b|</?(?:b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i"
    r"|img|li|menu|meta|nobr|ol|p|pre|ruby|s|section|article|small|span|strong|strike|sub|sup|table|td|tr|tt|u|ul|var)\b",
    re.IGNORECASE)
_MATH = re.compile(r"</?math\b", re.IGNORECASE)
# Hidden sources of formulas, and embedded elements, dropped if there is no text in them.
_NOTES = ("annotation", "annotation-xml")
_EMPTY = {t: re.compile(rf"(?:\s++|<(?!/?{t}\b)[^>]*+>)*+</{t}\s*+>", re.IGNORECASE)
          for t in ("noscript", "object", "audio", "video", "canvas", "iframe")}
_END = {t: re.compile(rf"</{t}\s*+>", re.IGNORECASE) for t in ("svg", *_NOTES)}
_NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")

# HTML's inline elements, elements without an end tag, and the
# elements that an opening tag ends implicitly.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr img svg math semantics mi mn mo ms mtext mspace mrow mfrac msqrt
mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mtable
mtr mtd""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6
header hr main nav ol pre section table ul""".split())
#: Elements that an implicit end does not reach through.
SCOPE = frozenset("html body table ul ol dl div section article aside main nav header footer form td th".split())


@dataclass
class Block:
    path: tuple[int, ...]  # hashed tokens of the enclosing tags, outermost first
    text: str
    link_chars: int
    tag: str               # the innermost enclosing block element


def _tokens(tag: str, attrs: str) -> tuple[int, ...]:
    names = [tag]
    if attrs:
        for m in _NAMES.finditer(attrs):
            names += [f".{t}" for t in _TOKEN.findall((m[2] or m[3] or m[4] or "").lower())]
    return tuple(zlib.crc32(n.encode()) % PATH_BUCKETS for n in names)


class _Ahead:
    """The first match of a pattern from a place on. Places only rise, and a match
    that still lies ahead is kept, so all searches together read the page once."""

    def __init__(self, page: str):
        self.page, self.known = page, {}

    def find(self, pattern: re.Pattern | str, at: int) -> tuple[int, int]:
        """Its begin and end; the page's length if there is none."""
        begin, end = self.known.get(pattern, (-1, -1))
        if begin < at:
            if isinstance(pattern, str):
                begin = self.page.find(pattern, at)
                end = begin + len(pattern)
            else:
                m = pattern.search(self.page, at)
                begin, end = m.span() if m else (-1, -1)
            if begin < 0:
                begin = end = len(self.page)
            self.known[pattern] = begin, end
        return begin, end


def _skipped(page: str, ahead: _Ahead, tag: str, at: int) -> int:
    """Where the element that is open at ``at`` ends, if its content is no text; else -1."""
    if tag in _RAW:
        return ahead.find(_RAW[tag], at)[1]
    if tag == "svg" or tag in _NOTES:
        begin, end = ahead.find(_END[tag], at)
        stop = ahead.find(_PAGE_TAG if tag == "svg" else _MATH, at)[0]
        return end if begin < min(stop, len(page)) else -1
    if tag in _EMPTY and (m := _EMPTY[tag].match(page, at)):
        return m.end()
    return -1


def markup(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """The page's tags in order: begin, end, ``/`` for an end tag, name (empty for
    what is neither text nor a tag: comments, declarations, elements without text)
    and attributes. Reads the page once, whatever it holds."""
    ahead, at = _Ahead(page), 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = end + 3 if end >= 0 else len(page)
            yield at, end, "", "", ""
        elif m := _OPEN.match(page, at):
            name = m[2].lower()
            if quoted := _ATTRS.match(page, m.end()):
                end = quoted.end()
            else:
                close, end = ahead.find(">", m.end())
                if close == len(page):
                    at += 1  # no tag: text
                    continue
            attrs = page[m.end():end - 1]
            # a raw element's first '>' ends its tag
            inside = ahead.find(">", m.end())[1] if name in _RAW or name == "svg" or name in _NOTES or name in _EMPTY else end
            empty = page.endswith("/", at, inside - 1)
            skip = -1 if m[1] or (empty and name not in _RAW) else _skipped(page, ahead, name, inside)
            if skip >= 0:
                yield at, (end := skip), "", "", ""
            else:
                yield at, end, m[1], name, attrs
        elif page.startswith(("<!", "<?", "</"), at):
            end = ahead.find(">", at)[1]
            yield at, end, "", "", ""
        else:
            at += 1
            continue
        at = end


def blocks_of(page: str) -> list[Block]:
    """Blocks of text between block-level tags; character references decoded,
    white space turned into single spaces; empty blocks left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    opened: Counter[str] = Counter()  # tags on the stack
    held: list[str] = []
    links, link_chars = 0, 0

    def flush() -> None:
        nonlocal link_chars
        if held:
            text = "".join(held)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                near = stack[-DEPTH:]
                block = next((t for t, _ in reversed(near) if t not in INLINE), "")
                out.append(Block(tuple(i for _, ids in near for i in ids), text, link_chars, block))
            held.clear()
        link_chars = 0

    def close(k: int) -> None:
        nonlocal links
        for t, _ in stack[k:]:
            opened[t] -= 1
        links = opened["a"]
        del stack[k:]

    at = 0
    for begin, end, closing, tag, attrs in markup(page):
        if begin > at:
            held.append(page[at:begin])
            if links:
                link_chars += begin - at
        at = end
        if not tag:
            continue
        if closing:
            if tag not in INLINE:
                flush()
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag not in INLINE:
            flush()
            ended = CLOSES.get(tag, frozenset()) | ({"p"} if tag in ENDS_P else frozenset())
            for k in range(len(stack) - 1, -1, -1) if any(opened[t] for t in ended) else ():
                if stack[k][0] in ended:
                    close(k)
                    break
                if stack[k][0] in SCOPE:
                    break
        if tag not in VOID and not attrs.rstrip().endswith("/"):
            stack.append((tag, _tokens(tag, attrs)))
            opened[tag] += 1
            links = opened["a"]
    if at < len(page):
        held.append(page[at:])
    flush()
    return out
