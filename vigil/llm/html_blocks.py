"""Blocks of a page: the leaf texts between block-level tags, with their paths."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

#: Formulas, tags that do not end a block, and tags without content.
MATH = frozenset((
    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom "
    "mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable "
    "mtr mlabeledtr mtd maction").split())
INLINE = MATH | frozenset((
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr").split())
VOID = frozenset(("area base br col embed hr img input link meta param source track wbr").split())

#: Elements whose content is no text of the page.  Those of ``NESTED`` may hold
#: others of their name, and one without an end tag is passed over by itself.
NESTED = frozenset("noscript template svg annotation annotation-xml".split())
RAW = NESTED | frozenset("script style iframe textarea title noframes".split())

#: A start of one of these ends an open element of the listed names.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select body html article section div main".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?>[\s/]++(?:[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|"""
                  r"""'[^']*+'|[^\s"'>][^\s>]*+))?+)?+)*+)\s*+>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # tags from the root, with class, id and role as tag.word
    linked: int  # characters inside links


def _names(tag: str, attributes: str) -> str:
    """``tag`` and the words of its class, id and role."""
    if not attributes:
        return tag
    words = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            words += re.findall(r"[a-z]+", (a or b or c).lower())
    return " ".join([tag, *words])


def _self_closed(attributes: str) -> bool:
    """True if a tag ends with a slash that is not part of a value."""
    if not attributes.endswith("/"):
        return False
    return not any(m[4] is not None and m.end() == len(attributes)
                   for m in _ATTRIBUTE.finditer(attributes))


def _ends(html: str, tag: str) -> dict[int, int]:
    """Place after the start tag -> place after the end tag of the elements."""
    out: dict[int, int] = {}
    opened: list[int] = []
    for found in re.finditer(rf"<(/?){tag}(?=[\s/>])", html, re.I):
        if found[1]:
            gt = html.find(">", found.end())
            if opened:
                out[opened.pop()] = len(html) if gt < 0 else gt + 1
        elif (start := _TAG.match(html, found.start())) and not _self_closed(start[3]):
            opened.append(start.end())
    return out


def blocks_of(html: str) -> list[Block]:
    """The non-empty blocks of a page in order.  White space within a block is
    one space.  A tag that the end of the page cuts off is dropped; an open
    element ends with its parent.  The text of formulas is text of their block,
    but for their annotations."""
    blocks: list[Block] = []
    stack: list[str] = []
    labels: list[str] = []
    parts: list[str] = []
    linked = 0
    depth_of_links = 0
    ends: dict[str, dict[int, int]] = {}

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                path = tuple(x for x, t in zip(labels, stack) if t not in INLINE)
                blocks.append(Block(text, path, linked))
            parts.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        if text:
            parts.append(text)
            if depth_of_links:
                linked += len(text)

    def leave(to: int):
        nonlocal depth_of_links
        depth_of_links -= sum(t == "a" for t in stack[to:])
        del stack[to:], labels[to:]

    at, end = 0, len(html)
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        add(html[at:lt])
        following = html[lt + 1:lt + 2]
        if following in ("!", "?"):
            comment = html.startswith("<!--", lt)
            close = html.find("-->" if comment else ">", lt + (4 if comment else 2))
            if close < 0:
                break
            at = close + (3 if comment else 1)
            continue
        letter = html[lt + 2:lt + 3] if following == "/" else following
        if not (letter.isascii() and letter.isalpha()):
            if following == "" or (following == "/" and letter == ""):
                break  # the page ends within a tag
            add("<")
            at = lt + 1
            continue
        found = _TAG.match(html, lt)
        if not found:
            close = html.find(">", lt)
            if close < 0:
                break
            at = close + 1  # a malformed tag
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE and tag not in ("annotation", "annotation-xml"):
            flush()
        if closing:
            if tag in stack:
                leave(len(stack) - 1 - stack[::-1].index(tag))
            continue
        if tag in VOID:
            continue
        if (tag in MATH or tag in NESTED) and tag not in ("noscript", "template") and (
                _self_closed(attributes)):
            continue
        if tag in NESTED:
            if tag not in ends:
                ends[tag] = _ends(html, tag)
            at = ends[tag].get(at, at)
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            if not close:
                break
            at = close.start()
            gt = html.find(">", at)
            at = end if gt < 0 else gt + 1
            continue
        if tag not in INLINE and "p" in stack:
            leave(len(stack) - 1 - stack[::-1].index("p"))
        for other in CLOSES.get(tag, ()):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in SCOPES:
                    break
                if stack[k] == other:
                    leave(k)
                    break
        stack.append(tag)
        labels.append(_names(tag, attributes))
        depth_of_links += tag == "a"
    flush()
    return blocks
