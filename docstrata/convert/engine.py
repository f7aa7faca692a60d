"""Components in Markdown: one linear scan to a tree, and rendering by a registry of functions.

A tag ends outside quotes and braces. An opener without its closing tag stays text, as does a component whose renderer
gives None. Code fences are shielded before the scan and restored after rendering.
"""

from __future__ import annotations

import re
import textwrap
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from docstrata.convert.jsvalues import Unreadable, bracket_end, declarations, literal
from docstrata.functions import fences

TAG_LIMIT = 4000
_START = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9.-]*)")
_SIGN = re.compile(r"[\"'`{>]|\\.", re.S)
_ATTRIBUTE = re.compile(r"\s*(?:\{\s*\.\.\.|([A-Za-z_:@][\w:.-]*)(\s*=\s*)?)")
_BARE = re.compile(r"[^\s\"'`{}<>=]+")


@dataclass
class Component:
    name: str
    source: str
    start: int
    opened: int
    self_closing: bool
    end: int = -1
    body_end: int = -1
    children: list[Component] = field(default_factory=list)


Render = Callable[["Props", str, "Context"], "str | None"]


class Props(dict):
    """Attributes by name: text, a value, True without one, or Unreadable."""

    def text(self, name: str, default: str = "") -> str:
        v = self.get(name, default)
        return default if v is None or v is True or isinstance(v, (Unreadable, list, dict)) else str(v).strip()

    @property
    def readable(self) -> bool:
        return not any(isinstance(v, Unreadable) for v in self.values())

    def rows(self, name: str) -> list[dict]:
        v = self.get(name)
        return [x for x in v if isinstance(x, dict)] if isinstance(v, list) else []


@dataclass
class Context:
    """What rendering needs besides the component: how links resolve, and counters of the document."""

    resolve: Callable[[str], str] = lambda href: href
    source: str = ""
    counts: dict[str, int] = field(default_factory=dict)

    def number(self, name: str) -> int:
        self.counts[name] = self.counts.get(name, 0) + 1
        return self.counts[name]


def tag_end(text: str, at: int) -> int:
    """Behind the '>' that ends the tag at this place, or -1; a tag is at most TAG_LIMIT characters."""
    limit = min(len(text), at + TAG_LIMIT)
    while m := _SIGN.search(text, at, limit):
        sign = m[0]
        if sign == ">":
            return m.end()
        if sign == "{":
            at = bracket_end(text, m.start()) if m.start() < limit else -1
            if at < 0 or at > limit:
                return -1
        elif sign in "\"'`":
            at = text.find(sign, m.end(), limit) + 1
            if not at:
                return -1
        else:
            at = m.end()
    return -1


def attributes(source: str, document: str = "") -> Props:
    found, at, names = Props(), 0, None
    while (m := _ATTRIBUTE.match(source, at)) and m.end() > at:
        at = m.end()
        if m[1] is None:  # a spread
            end = bracket_end(source, source.index("{", m.start()))
            at = len(source) if end < 0 else end
            continue
        if not m[2]:
            found[m[1]] = True
            continue
        sign = source[at : at + 1]
        if sign and sign in "\"'":
            end = source.find(sign, at + 1)
            if end < 0:
                break
            found[m[1]], at = source[at + 1 : end], end + 1
        elif sign == "{":
            end = bracket_end(source, at)
            if end < 0:
                break
            if names is None:
                names = declarations(document) if document else {}
            try:
                found[m[1]] = literal(source[at + 1 : end - 1], names, document)
            except Unreadable as e:
                found[m[1]] = e
            at = end
        elif b := _BARE.match(source, at):
            found[m[1]], at = b[0], b.end()
        else:
            break
    return found


def components(text: str, wanted: Callable[[str], bool]) -> list[Component]:
    """The outermost complete components with such names, with theirs inside them."""
    root = Component("", "", 0, 0, False)
    stack = [root]
    at = 0
    for m in _START.finditer(text):
        if m.start() < at or not wanted(m[2]):
            continue
        if m[1]:
            end = text.find(">", m.end())
            if end < 0 or text[m.end() : end].strip():
                continue
            k = len(stack) - 1
            while k and stack[k].name != m[2]:
                k -= 1
            if k:
                for lost in stack[k + 1 :]:  # openers without an end are text; what they hold goes up
                    stack[k].children += lost.children
                done = stack[k]
                done.body_end, done.end = m.start(), end + 1
                done.children.sort(key=lambda c: c.start)
                del stack[k:]
                stack[-1].children.append(done)
                at = end + 1
            continue
        end = tag_end(text, m.end())
        if end < 0:
            continue
        source = text[m.end() : end - 1]
        closed = source.endswith("/")
        c = Component(m[2], source.removesuffix("/"), m.start(), end, closed)
        at = end
        if closed:
            c.end = c.body_end = end
            stack[-1].children.append(c)
        else:
            stack.append(c)
    for lost in stack[1:]:
        root.children += lost.children
    return sorted(root.children, key=lambda c: c.start)


def _column(text: str, at: int) -> str | None:
    """The blanks before a place when nothing else is on its line before it."""
    lead = text[text.rfind("\n", 0, at) + 1 : at]
    return lead if not lead.strip(" \t") else None


def dedented(body: str) -> str:
    return textwrap.dedent(body.expandtabs()).strip("\n").rstrip()


def _parts(text: str, found: list[Component], start: int, end: int, registry: Callable[[str], Render | None], context: Context) -> Iterator[str]:
    at = start
    for c in found:
        yield text[at : c.start]
        body = "".join(_parts(text, c.children, c.opened, c.body_end, registry, context)) if not c.self_closing else ""
        render = registry(c.name)
        done = render(attributes(c.source, context.source), body, context) if render else None
        if done is None:
            yield text[c.start : c.opened] + body + text[c.body_end : c.end]
        else:
            lead = _column(text, c.start)
            yield done.replace("\n", "\n" + lead) if lead else done
        at = c.end
    yield text[at:end]


def rendered(text: str, registry: Callable[[str], Render | None], context: Context) -> str:
    """The text with its components rendered, inner ones first."""
    found = components(text, lambda name: registry(name) is not None)
    return re.sub(r"(?m)^[ \t]+$", "", "".join(_parts(text, found, 0, len(text), registry, context))) if found else text


def by_name(table: dict[str, Render], suffixes: dict[str, Render] | None = None) -> Callable[[str], Render | None]:
    """A registry: exact names first, then endings of names, which covers a product's prefix."""
    ends = sorted((suffixes or {}).items(), key=lambda p: -len(p[0]))
    return lambda name: table.get(name) or next((r for s, r in ends if name.endswith(s)), None)


_LEAD = re.compile(r"[ \t]*")


def around_code(text: str, change: Callable[[str], str], grammar: str = "component") -> str:
    """The change applied to the text with a token for each fence; a block moves with its token's column, also into quotes."""
    parts, blocks, at = [], [], 0
    for a, b in fences.GRAMMARS[grammar](text):
        a = text.rfind("\n", 0, a) + 1
        lead = _LEAD.match(text, a)[0]
        parts += (text[at:a], lead, f"\x02{len(blocks)}\x03")
        blocks.append([x.removeprefix(lead) if x.startswith(lead) else x.lstrip(" \t") for x in text[a:b].split("\n")])
        at = b
    parts.append(text[at:])
    done = change("".join(parts))

    def restore(m: re.Match[str]) -> str:
        n = int(m[1])
        if n >= len(blocks):
            return m[0]
        lead = re.sub(r"[^>\s]", " ", done[done.rfind("\n", 0, m.start()) + 1 : m.start()])
        return ("\n" + lead).join(blocks[n])

    return re.sub(r"\x02(\d+)\x03", restore, done) if blocks else done


def alert(label: str, body: str, title: str = "") -> str:
    lines = [f"> [!{label}]", *([f"> **{title}**"] if title else [])]
    if body:
        lines += [">"] if title else []
        lines += [f"> {x}" if x.strip() else ">" for x in body.split("\n")]
    return "\n".join(lines)


def fenced(code: str, language: str = "") -> str:
    """A block whose fence is longer than any run of backticks in it."""
    marks = "`" * max(3, 1 + max((len(r) for r in re.findall("`+", code)), default=0))
    return f"{marks}{language}\n{code}\n{marks}"


def cell(value: object) -> str:
    return " ".join(str("" if value is None else value).split()).replace("|", "\\|")


def table(header: list[str], rows: list[list[str]], align: list[str] | None = None) -> str:
    """Ragged rows are filled up with empty cells."""
    width = max(len(header), *(len(r) for r in rows)) if rows else len(header)
    full = [r + [""] * (width - len(r)) for r in [header, *rows]]
    rule = (align or []) + ["---"] * (width - len(align or []))
    return "\n".join("| " + " | ".join(r) + " |" for r in [full[0], rule, *full[1:]])
