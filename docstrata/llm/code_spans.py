"""Where a text is code: fences, inline code marks, pre/code elements, verbatim environments. All scanners are linear."""

from __future__ import annotations

import re

_RUN = re.compile(r"`+")
_OPEN = re.compile(r"<(pre|code|script|style|nowiki|syntaxhighlight|source|kbd|samp|tt)\b[^<>]*>|\\begin\{(verbatim|lstlisting|minted|Verbatim)\*?\}|\\(?:verb|lstinline)\*?([^\w\s*])", re.I)
_FENCE = re.compile(r"^([ >\t]*(?:[-*+] )?)(`{3,}|~{3,})([^\n]*)$", re.M)

Span = tuple[int, int]


def fence_spans(text: str) -> list[Span]:
    """Fenced blocks with their fences: closed by a run of the same sign at least as long; an unclosed one runs to the end."""
    if "```" not in text and "~~~" not in text:
        return []
    spans: list[Span] = []
    start, fence = -1, ""
    for m in _FENCE.finditer(text):
        run, info = m[2], m[3]
        if start < 0:
            if run[0] == "`" and "`" in info:
                continue
            start, fence = m.start(), run
        elif run[0] == fence[0] and len(run) >= len(fence) and not info.strip():
            spans.append((start, m.end()))
            start = -1
    if start >= 0:
        spans.append((start, len(text)))
    return spans


def element_spans(text: str) -> list[Span]:
    """Content of pre, code and the like and of verbatim environments; one without an end is no code."""
    spans: list[Span] = []
    if "<" not in text and "\\" not in text:
        return spans
    low, at, missing = None, 0, set()
    for m in _OPEN.finditer(text):
        if m.start() < at:
            continue
        if m[3]:
            end = text.find(m[3], m.end())
            line = text.find("\n", m.end())
            if end >= 0 and (line < 0 or end < line):
                spans.append((m.end(), end))
                at = end
            continue
        close = f"</{m[1].lower()}" if m[1] else f"\\end{{{m[2].lower()}"
        if close in missing:
            continue
        if low is None:
            low = text.lower()
            if len(low) != len(text):  # a few capitals change length
                low = text
        end = low.find(close, m.end())
        if end < 0:
            missing.add(close)
        else:
            spans.append((m.end(), end))
            at = end
    return spans


def inline_spans(text: str) -> list[Span]:
    """Inline code with its marks: a run of backticks up to the next run of that length in the same paragraph."""
    if "`" not in text:
        return []
    spans: list[Span] = []
    for base, part in _paragraphs(text):
        runs = [m.span() for m in _RUN.finditer(part)]
        partner, nearest = [], {}  # seen from the end of the paragraph
        for a, b in reversed(runs):
            partner.append(nearest.get(b - a))
            nearest[b - a] = b
        done = 0
        for (a, _), end in zip(runs, reversed(partner), strict=True):
            if end is not None and a >= done:
                spans.append((base + a, base + end))
                done = end
    return spans


def _paragraphs(text: str) -> list[tuple[int, str]]:
    found, at = [], 0
    for m in re.finditer(r"\n[ \t]*\n", text):
        found.append((at, text[at : m.start()]))
        at = m.end()
    found.append((at, text[at:]))
    return found


_WIKI = re.compile(r"^(={2,6})[^=\n]+\1[ \t]*$|'''|\[\[", re.M)
_SPACED = re.compile(r"(?:(?<=\n\n)|\A)(?: [^\n]*\S[^\n]*(?:\n|\Z))+")
_DEEP = re.compile(r"(?:(?<=\n\n)|\A)(?:(?: {4}|\t)[^\n]*\S[^\n]*(?:\n|\Z))+")


def indented_spans(text: str) -> list[Span]:
    """Paragraphs indented by four blanks; in wiki text, whose lines of code begin with a blank, by one."""
    if "\n " not in text and "\n\t" not in text and text[:1] not in " \t":
        return []
    return [m.span() for m in (_SPACED if _WIKI.search(text) else _DEEP).finditer(text)]


def cut(text: str, spans: list[Span], to: str = " ") -> str:
    """The text with each span replaced."""
    if not spans:
        return text
    parts, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            parts += (text[at:a], to)
        at = max(at, b)
    parts.append(text[at:])
    return "".join(parts)


def without_code(text: str) -> tuple[str, bool, bool]:
    """(text without code, has fences, has inline code marks). Tags of pre and code stay."""
    fences = fence_spans(text)
    bare = cut(text, fences)
    bare = cut(bare, element_spans(bare))
    bare = cut(bare, indented_spans(bare))
    marks = inline_spans(bare)
    return cut(bare, marks), bool(fences), bool(marks)
