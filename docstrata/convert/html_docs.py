"""HTML documentation pages to Markdown: content root, code blocks, tab labels, then a writer over the tree."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

from docstrata.convert.engine import cell, fenced, table
from docstrata.functions.markdown import blank_runs_collapsed
from docstrata.functions.scan import between

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("nav footer aside script style head noscript template button svg".split())
DROPPED_CLASSES = ("pagination-nav", "breadcrumbs")
#: Where content is looked for, in this order; then article, then the whole body.
ROOTS = (("div", "theme-doc-markdown"), ("div", "PromptLibrary"))
_ENDED_BY = {"p": frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()), "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr"))}
_BLOCKS = frozenset("address article blockquote body details div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main ol p pre section summary table ul".split())


class Element:
    __slots__ = ("tag", "attrs", "items", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent, self.items = tag, attrs, parent, []

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()

    def walk(self):
        for i in self.items:
            if isinstance(i, Element):
                yield i
                yield from i.walk()

    def find(self, tag: str, class_: str | None = None) -> Element | None:
        return next((e for e in self.walk() if e.tag == tag and (class_ is None or e.has_class(class_))), None)

    def text(self) -> str:
        return "".join(i if isinstance(i, str) else "\n" if i.tag == "br" else i.text() for i in self.items)


_TOKEN = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:.-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<![^<>]*>")
_ATTRIBUTE = re.compile(r"([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?")
_RAW = ("script", "style")


def parsed(source: str) -> Element:
    """A forgiving tree: end tags without a start are ignored, comments dropped, depth bounded; signs that are no tag are text."""
    source = between(source, "<!--", "-->", lambda _: "")
    root = at = Element("#root", {}, None)
    depth, pos, raw = 0, 0, ""
    for m in _TOKEN.finditer(source):
        if raw and not (m[1] and m[2].lower() == raw):
            continue
        if m.start() > pos:
            at.items.append(html.unescape(source[pos : m.start()]))
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            raw = ""
            up, k = at, 0
            while up.parent is not None and up.tag != tag:
                up, k = up.parent, k + 1
            if up.parent is not None:
                at, depth = up.parent, depth - k - 1
            continue
        while tag in _ENDED_BY.get(at.tag, ()):
            at, depth = at.parent, depth - 1
        e = Element(tag, {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(m[3])}, at)
        at.items.append(e)
        if tag not in VOID and not m[3].endswith("/") and depth < 250:
            at, depth, raw = e, depth + 1, tag if tag in _RAW else ""
    at.items.append(html.unescape(source[pos:]))
    return root


def content_root(page: Element) -> tuple[Element, str]:
    """(the content, how it was found)."""
    for tag, class_ in ROOTS:
        if e := page.find(tag, class_):
            return e, class_
    if e := page.find("article"):
        return e, "article"
    return page.find("body") or page, "body"


def language(pre: Element) -> str:
    """From a language-* class of the block, its code or the container around it."""
    around = [pre, *(i for i in pre.items if isinstance(i, Element) and i.tag == "code")]
    if pre.parent is not None:
        around.append(pre.parent)
    for e in around:
        for c in e.attrs.get("class", "").split():
            if c.startswith("language-"):
                return re.sub(r"[^A-Za-z0-9_+#.-]", "", c[9:])
    return ""


def _labelled_tabs(root: Element) -> None:
    """Each panel of a tab strip begins with the bold label of its tab; nested strips label their own panels."""
    for strip in [e for e in root.walk() if e.attrs.get("role") == "tablist"]:
        labels = [" ".join(t.text().split()) for t in strip.walk() if t.attrs.get("role") == "tab"]
        holder = strip.parent
        panels: list[Element] = []

        def collect(e: Element) -> None:
            for i in e.items:
                if isinstance(i, Element):
                    if i.attrs.get("role") == "tabpanel":
                        panels.append(i)
                    elif not any(isinstance(x, Element) and x.attrs.get("role") == "tablist" for x in i.items):
                        collect(i)

        if holder is not None:
            collect(holder)
            for label, panel in zip(labels, panels, strict=False):
                head = Element("p", {}, panel)
                strong = Element("strong", {}, head)
                strong.items.append(label)
                head.items.append(strong)
                panel.items.insert(0, head)
        strip.items.clear()


def _inline(e: Element, link: Callable[[str], str]) -> str:
    out = []
    for i in e.items:
        if isinstance(i, str):
            out.append(re.sub(r"\s+", " ", i))
        elif i.tag in DROPPED or i.tag == "img":
            continue
        elif i.tag == "br":
            out.append("\n")
        elif i.tag == "code":
            code = i.text()
            marks = "`" * (1 + max((len(r) for r in re.findall("`+", code)), default=0)) if "`" in code else "`"
            out.append(f"{marks}{code}{marks}" if "`" not in code else f"{marks} {code} {marks}")
        else:
            inner = _inline(i, link)
            bare = inner.strip()
            if i.tag == "a" and i.attrs.get("href") and bare:
                target = link(i.attrs["href"])
                out.append(f"[{bare}](<{target}>)" if re.search(r"[\s()]", target) else f"[{bare}]({target})")
            elif i.tag in ("strong", "b") and bare:
                out.append(inner.replace(bare, f"**{bare}**", 1))
            elif i.tag in ("em", "i") and bare:
                out.append(inner.replace(bare, f"*{bare}*", 1))
            else:
                out.append(inner)
    return "".join(out)


def _indent(block: str, lead: str) -> str:
    return block.replace("\n", "\n" + lead).replace("\n" + lead + "\n", "\n\n")


def _blocks(e: Element, link: Callable[[str], str]) -> list[str]:
    out: list[str] = []
    line = Element("span", {}, e)

    def flush() -> None:
        text = re.sub(r" *\n *", "\n", _inline(line, link)).strip()
        line.items.clear()
        if text:
            out.append(text)

    for i in e.items:
        if isinstance(i, str) or (i.tag not in _BLOCKS and i.tag not in DROPPED and not any(x.tag in _BLOCKS for x in i.walk())):
            line.items.append(i)
            continue
        flush()
        if i.tag in DROPPED or any(i.has_class(c) for c in DROPPED_CLASSES):
            continue
        if i.tag == "pre":
            out.append(fenced(i.text().strip("\n"), language(i)))
        elif re.fullmatch(r"h[1-6]", i.tag):
            if title := " ".join(_inline(i, link).split()):
                out.append("#" * int(i.tag[1]) + " " + title)
        elif i.tag in ("ul", "ol"):
            items = []
            for n, x in enumerate((x for x in i.items if isinstance(x, Element)), 1):
                mark = f"{n}. " if i.tag == "ol" else "- "
                body = _blocks(x, link)
                tight = len(body) < 2 or all(b.startswith(("- ", "1. ")) for b in body[1:])
                items.append(mark + _indent(("\n" if tight else "\n\n").join(body), " " * len(mark)))
            out.append("\n".join(items))
        elif i.tag == "table":
            rows = [r for r in i.walk() if r.tag == "tr"]
            cells = [[cell(_inline(c, link)) for c in r.items if isinstance(c, Element) and c.tag in ("td", "th")] for r in rows]
            if cells:
                out.append(table(cells[0], cells[1:]))
        elif i.tag == "blockquote":
            out.append("\n".join("> " + x if x else ">" for x in "\n\n".join(_blocks(i, link)).split("\n")))
        elif i.tag == "hr":
            out.append("* * *")
        else:
            out += _blocks(i, link)
    flush()
    return out


def html_to_markdown(page: str, link: Callable[[str], str] = lambda href: href) -> str:
    """The content of a page as Markdown; links outside code go through link(). Control and format characters go."""
    root, _ = content_root(parsed(page))
    _labelled_tabs(root)
    text = "\n\n".join(_blocks(root, link))
    text = "".join(c for c in text if c in "\t\n\r" or unicodedata.category(c) not in ("Cf", "Cc"))
    return blank_runs_collapsed(text).strip() + "\n"
