"""Template slots that were never filled, and a program's empty values where text should be."""

from __future__ import annotations

import re

NAME = r"[A-Za-z_][\w.]*"
SLOT = re.compile(
    r"\{\{[#/^&>!]?\s*" + NAME + r"(?:\s*\|\s*\w+)*\s*\}\}"
    r"|[$#]\{\s*" + NAME + r"\s*\}"
    r"|<%[=-]?\s*" + NAME + r"[^%<>]{0,80}%>"
    r"|%%[A-Z][A-Z_ ]*%%|@@[A-Z][A-Z_ ]*@@|&&[A-Z][A-Z_ ]*&&|::[A-Z][A-Z_ ]*::"
    r"|\bXX_[A-Z_]+_XX\b"
    r"|\$[A-Z][A-Z_]+\$"
    r"|(?<![\\\w}$^*])\{(?:" + NAME + r"|\d)\}"
    r"|\[(?:YOUR|INSERT|ADD|ENTER) [A-Z][A-Z_ ]*\]"
    r"|\([A-Z][A-Z_ ]* to be filled in\)"
    r"|\{%-?\s*\w+ [^%{}]{0,80}%\}"
    r"|%\(" + NAME + r"\)[dsrif]"
    r"|\b(undefined|null|NaN|None) \1\b"
    r"|\[object Object\]"
)
#: What any slot has, for engines that look before parsing.
HINT = r"\{|<%|%%|@@|&&|::|XX_|\$[A-Z]|\[(?:YOUR|INSERT|ADD|ENTER) |filled in|%\(|undefined|null null|NaN|None None|\[object"


_SIGNS = ("{", "%%", "@@", "&&", "::", "XX_", "[YOUR ", "[INSERT ", "[ADD ", "[ENTER ", "filled in", "%(", "<%", "undefined", "null null", "NaN", "None None", "[object")


def _may_have(text: str) -> bool:
    return any(s in text for s in _SIGNS) or text.count("$") > 1


def has_slot(text: str) -> bool:
    return _may_have(text) and SLOT.search(text) is not None


def without_slots(text: str) -> str:
    return SLOT.sub(" ", text) if _may_have(text) else text
