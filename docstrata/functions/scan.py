"""Linear replacements for what a regular expression would do by trying every opener to the end."""

from __future__ import annotations

import re
from collections.abc import Callable


def between(text: str, opener: str, closer: str, change: Callable[[str], str]) -> str:
    """Each part from an opener to the next closer is replaced by change(what is between); an opener without one stays."""
    if opener not in text:
        return text
    parts, at = [], 0
    while (a := text.find(opener, at)) >= 0 and (b := text.find(closer, a + len(opener))) >= 0:
        parts += (text[at:a], change(text[a + len(opener) : b]))
        at = b + len(closer)
    parts.append(text[at:])
    return "".join(parts)


def elements(text: str, names: str, change: str) -> str:
    """Elements of those names (alternatives of a pattern) with all that is in them are replaced; unclosed ones stay."""
    lower, parts, at, missing = None, [], 0, set()
    for m in re.finditer(rf"<({names})\b[^<>]*>", text, re.I):
        name = m[1].lower()
        if m.start() < at or name in missing:
            continue
        if lower is None:
            lower = text.lower()
            if len(lower) != len(text):
                lower = text
        a = lower.find(f"</{name}", m.end())
        b = text.find(">", a) + 1 if a >= 0 else 0
        if not b:
            missing.add(name)
            continue
        parts += (text[at : m.start()], change)
        at = b
    parts.append(text[at:])
    return "".join(parts)
