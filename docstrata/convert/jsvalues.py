"""JavaScript literals as Python values: strings, templates, numbers, words, arrays, objects, markup kept as text."""

from __future__ import annotations

import re
from collections.abc import Mapping

WRAPPERS = 8
#: Levels of nesting that are read; a level takes up to three calls of the interpreter's thousand.
MOST_DEEP = 200
_SPACE = re.compile(r"(?:\s+|//[^\n]*|/\*(?:[^*]|\*(?!/))*\*/)*")
_NUMBER = re.compile(r"-?\d+(?:\.\d+)?")
_NAME = re.compile(r"[A-Za-z_$][\w$]*")
_KEY = re.compile(r"[A-Za-z_$][\w$-]*|\d+")
_WRAP = re.compile(r"(?:\([^()]*\)|[A-Za-z_$][\w$]*)\s*=>\s*|[A-Za-z_$][\w$.]*\s*\(\s*|\(\s*")
_QUOTED = re.compile(r"\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`((?:[^`\\]|\\.)*)`", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)
_WORDS = {"true": True, "false": False, "null": None, "undefined": None}
_PAIRS = {"(": ")", "[": "]", "{": "}"}
_SIGN = re.compile(r"[\"'`()\[\]{}]")


class Unreadable(ValueError):
    """The text is no literal this reads."""


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), text)


def bracket_end(text: str, at: int) -> int:
    """Behind the bracket that closes the one at this place; quoted text is skipped. -1 where none does."""
    open_, stack = at, []
    while m := _SIGN.search(text, open_):
        sign = m[0]
        open_ = m.end()
        if sign in _PAIRS:
            stack.append(_PAIRS[sign])
        elif sign in "\"'`":
            q = _QUOTED.match(text, m.start())
            if q is None:
                return -1
            open_ = q.end()
        elif not stack or stack.pop() != sign:
            return -1
        elif not stack:
            return m.end()
    return -1


def declarations(text: str) -> dict[str, int]:
    """Where the value of each top-level const, let or var begins."""
    return {m[1]: m.end() for m in re.finditer(r"^[ \t]*(?:export[ \t]+)?(?:const|let|var)[ \t]+([A-Za-z_$][\w$]*)[ \t]*=[ \t]*", text, re.M)}


class Reader:
    """Reads values of one source text; names stand for its declarations, and a cycle of them is unreadable."""

    def __init__(self, text: str, names: Mapping[str, int] | None = None) -> None:
        self.text, self.names = text, names or {}

    def _skip(self, at: int) -> int:
        return _SPACE.match(self.text, at).end()

    def value(self, at: int, resolving: frozenset[str] = frozenset(), depth: int = 0) -> tuple[object, int]:
        at = self._skip(at)
        if depth > MOST_DEEP or at >= len(self.text):
            raise Unreadable(at)
        sign = self.text[at]
        if sign in "\"'`":
            m = _QUOTED.match(self.text, at)
            if m is None or (sign == "`" and "${" in m[3]):
                raise Unreadable(at)
            return unescaped(next(g for g in m.groups() if g is not None)), m.end()
        if m := _NUMBER.match(self.text, at):
            return (float(m[0]) if "." in m[0] else int(m[0])), m.end()
        if sign == "[":
            return self._array(at, resolving, depth)
        if sign == "{":
            return self._object(at, resolving, depth)
        if sign == "<":
            return self._markup(at)
        for _ in range(WRAPPERS):
            m = _WRAP.match(self.text, at)
            if m is None:
                break
            inner = self.text[m.end() : m.end() + 1]
            if inner and inner in "\"'`[{<" or _WRAP.match(self.text, m.end()):
                value, end = self.value(m.end(), resolving, depth + 1)
                closed = self._skip(end)
                return value, closed + 1 if self.text[closed : closed + 1] == ")" and m[0].rstrip().endswith("(") else end
            break
        if m := _NAME.match(self.text, at):
            if m[0] in _WORDS:
                return _WORDS[m[0]], m.end()
            if m[0] in self.names and m[0] not in resolving:
                return self.value(self.names[m[0]], resolving | {m[0]}, depth + 1)[0], m.end()
        raise Unreadable(at)

    def _array(self, at: int, resolving: frozenset[str], depth: int) -> tuple[list, int]:
        found: list[object] = []
        at = self._skip(at + 1)
        while self.text[at : at + 1] != "]":
            value, at = self.value(at, resolving, depth + 1)
            found.append(value)
            at = self._skip(at)
            if self.text[at : at + 1] == ",":
                at = self._skip(at + 1)
            elif self.text[at : at + 1] != "]":
                raise Unreadable(at)
        return found, at + 1

    def _object(self, at: int, resolving: frozenset[str], depth: int) -> tuple[dict, int]:
        found: dict[str, object] = {}
        at = self._skip(at + 1)
        while self.text[at : at + 1] != "}":
            if q := _QUOTED.match(self.text, at):
                key, at = unescaped(next(g for g in q.groups() if g is not None)), q.end()
            elif m := _KEY.match(self.text, at):
                key, at = m[0], m.end()
            else:
                raise Unreadable(at)
            at = self._skip(at)
            if self.text[at : at + 1] != ":":
                raise Unreadable(at)
            found[key], at = self.value(at + 1, resolving, depth + 1)
            at = self._skip(at)
            if self.text[at : at + 1] == ",":
                at = self._skip(at + 1)
            elif self.text[at : at + 1] != "}":
                raise Unreadable(at)
        return found, at + 1

    def _markup(self, at: int) -> tuple[str, int]:
        """Markup is kept as text: fragment marks go, white space collapses."""
        depth, end = 0, at
        for m in re.finditer(r"<(/?)([A-Za-z][\w.-]*)?[^<>]*?(/?)>", self.text[at:]):
            depth += -1 if m[1] else 0 if m[3] else 1
            end = at + m.end()
            if depth <= 0:
                return " ".join(re.sub(r"</?>", "", self.text[at:end]).split()), end
        raise Unreadable(at)


def literal(text: str, names: Mapping[str, int] | None = None, source: str | None = None) -> object:
    """The value of a whole text, or Unreadable. names are declarations() of source, in which text may be looked up."""
    reader = Reader(text)
    try:
        value, end = reader.value(0)
    except Unreadable:
        if source is None or (word := text.strip()) not in (names or {}):
            raise
        return Reader(source, names).value(names[word], frozenset([word]))[0]
    if reader._skip(end) < len(text):
        raise Unreadable(end)
    return value


def exported(text: str) -> dict[str, object]:
    """The readable values of all declarations of a text."""
    names, found = declarations(text), {}
    reader = Reader(text, names)
    for name, at in names.items():
        try:
            found[name] = reader.value(at, frozenset([name]))[0]
        except Unreadable:
            continue
    return found
