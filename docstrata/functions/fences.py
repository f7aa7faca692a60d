"""Fenced code: five grammars over one scan of the fence lines.

==========  ==============  ===========================================  =======================
grammar     before a fence  closer                                       unclosed opener
==========  ==============  ===========================================  =======================
title       nothing         exactly three signs, then blanks             text
block       nothing         a run equal to a prefix (3+) of the opener   text
indented    up to 3 blanks  as block                                     text
component   blanks, tabs    same sign, run at least as long              text
link        up to 3 blanks  same sign, run at least as long              code to the end
==========  ==============  ===========================================  =======================

Only lines that begin with a fence are looked at. They are gone through from the end, and each learns from what lies
behind it which line would close it; then a walk from the start takes an opener, jumps behind its closer, and goes on.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

Span = tuple[int, int]
_FENCE_LINE = re.compile(r"^(?P<pad>[ \t]*)(?P<run>`{3,}|~{3,})(?P<info>[^\n]*)$", re.M)


class Fence(NamedTuple):
    """A line that begins with a fence: where the line starts, what is before the run, the run, what is behind, where the line ends."""

    start: int
    pad: str
    run: str
    info: str
    end: int


class EqualRuns:
    """The next closer of every run. An opener takes the longest of its own prefixes that closes anything."""

    def __init__(self, longest: int | None = None) -> None:
        self.longest, self.behind = longest, {}

    def add(self, n: int, f: Fence) -> None:
        self.behind[f.run] = n

    def closer(self, f: Fence) -> int | None:
        prefixes = (f.run[:size] for size in range(min(len(f.run), self.longest or len(f.run)), 2, -1))
        return next((self.behind[p] for p in prefixes if p in self.behind), None)


class LongerRuns:
    """For each sign the closers that no longer one stands in front of, far and long ones first."""

    def __init__(self) -> None:
        self.sizes: dict[str, list[int]] = {"`": [], "~": []}  # negated, so that they ascend
        self.places: dict[str, list[int]] = {"`": [], "~": []}

    def add(self, n: int, f: Fence) -> None:
        sizes, places = self.sizes[f.run[0]], self.places[f.run[0]]
        while sizes and -sizes[-1] <= len(f.run):
            sizes.pop()
            places.pop()
        sizes.append(-len(f.run))
        places.append(n)

    def closer(self, f: Fence) -> int | None:
        k = bisect_right(self.sizes[f.run[0]], -len(f.run)) - 1
        return self.places[f.run[0]][k] if k >= 0 else None


@dataclass(frozen=True)
class Grammar:
    pad: re.Pattern[str]  # what may stand before a fence
    closers: Callable[[], EqualRuns | LongerRuns]
    blanks: str | None = " \t\r"  # what may stand behind a closer; None for all white space
    with_pad: bool = False  # a span begins with its line, not with its fence
    plain_info: bool = False  # an opener of backticks has none behind it
    to_the_end: bool = False  # an opener without a closer is code up to the end

    def spans(self, text: str) -> list[Span]:
        if "```" not in text and "~~~" not in text:
            return []
        fences = [Fence(m.start(), m["pad"], m["run"], m["info"], m.end()) for m in _FENCE_LINE.finditer(text) if self.pad.fullmatch(m["pad"])]
        closers, closed_by = self.closers(), [None] * len(fences)
        for n in range(len(fences) - 1, -1, -1):
            f = fences[n]
            if not (self.plain_info and f.run[0] == "`" and "`" in f.info):
                closed_by[n] = closers.closer(f)
                if closed_by[n] is None and self.to_the_end:
                    closed_by[n] = len(fences)
            if not f.info.strip(self.blanks):
                closers.add(n, f)
        found, n = [], 0
        while n < len(fences):
            f, last = fences[n], closed_by[n]
            if last is None:
                n += 1
                continue
            found.append((f.start if self.with_pad else f.start + len(f.pad), fences[last].end if last < len(fences) else len(text)))
            n = last + 1
        return found


_FLUSH, _UP_TO_THREE, _ANY = re.compile(""), re.compile(" {0,3}"), re.compile(r"[ \t]*")
GRAMMARS: dict[str, Callable[[str], list[Span]]] = {
    "title": Grammar(_FLUSH, lambda: EqualRuns(3)).spans,
    "block": Grammar(_FLUSH, EqualRuns).spans,
    "indented": Grammar(_UP_TO_THREE, EqualRuns).spans,
    "component": Grammar(_ANY, LongerRuns, blanks=None, with_pad=True, plain_info=True).spans,
    "link": Grammar(_UP_TO_THREE, LongerRuns, blanks=None, with_pad=True, to_the_end=True).spans,
}
title_spans, block_spans, indented_spans, component_spans, link_spans = GRAMMARS.values()


def outside(text: str, spans: list[Span], change: Callable[[str], str]) -> str:
    """The text with its parts outside the spans changed."""
    parts, at = [], 0
    for a, b in spans:
        parts += (change(text[at:a]), text[a:b])
        at = b
    parts.append(change(text[at:]))
    return "".join(parts)


def without(text: str, spans: list[Span]) -> str:
    """The text without the lines of the spans."""
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b + 1
    parts.append(text[at:] if at <= len(text) else "")
    return "".join(parts)


def shielded(text: str, grammar: str, token: str = "\x02{}\x03") -> tuple[str, list[str]]:
    """(text with a token for each block, the blocks). Tokens a text brings along are shielded as well."""
    lead, tail = token.split("{}")
    spans = GRAMMARS[grammar](text)
    own = [m.span() for m in re.finditer(re.escape(lead) + r"\d+" + re.escape(tail), text)]
    spans = sorted(spans + [s for s in own if not any(a <= s[0] < b for a, b in spans)]) if own else spans
    blocks, parts, at = [], [], 0
    for a, b in spans:
        parts += (text[at:a], token.format(len(blocks)))
        blocks.append(text[a:b])
        at = b
    parts.append(text[at:])
    return "".join(parts), blocks


def restored(text: str, blocks: list[str], token: str = "\x02{}\x03") -> str:
    """Tokens become their blocks in one pass; tokens without a block stay."""
    lead, tail = token.split("{}")
    return re.sub(re.escape(lead) + r"(\d+)" + re.escape(tail), lambda m: blocks[int(m[1])] if int(m[1]) < len(blocks) else m[0], text) if blocks else text
