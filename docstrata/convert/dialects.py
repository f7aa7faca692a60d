"""Component dialects to Markdown: VitePress, Starlight MDX, component MDX, Astro MDX. Each is a registry and a few passes."""

from __future__ import annotations

import re
from collections.abc import Callable

from docstrata.convert.engine import Context, Props, Render, alert, around_code, by_name, cell, dedented, fenced, rendered, table
from docstrata.convert.jsvalues import Reader, Unreadable, bracket_end, declarations
from docstrata.functions.markdown import has_h1, split_front
from docstrata.functions.scan import between

# Labels of alerts by what the dialects call them.
ALERTS = {"note": "NOTE", "tip": "TIP", "important": "IMPORTANT", "info": "NOTE", "warning": "WARNING", "caution": "CAUTION", "danger": "CAUTION", "callout": "NOTE"}
_CONTAINER = re.compile(r"^([ \t]*)(:{3,})[ \t]*([A-Za-z][A-Za-z-]*)[ \t]*(?:\[([^\]\n]*)\]|([^\n]*?))[ \t]*$")
_CONTAINER_END = re.compile(r"^[ \t]*(:{3,})[ \t]*$")
_LAYOUT = re.compile(r"\b(?:class|className|style|data-path)\s*=")
_LAYOUT_TAG = re.compile(r"<(/?)(div|span|p)\b((?:[^<>\"'{}]|\"[^\"]*\"|'[^']*'|\{\{[^{}]*\}\}|\{[^{}]*\})*)>")


def _spaced(text: str) -> str:
    """Blank lines without blanks, at most one in a row."""
    text = re.sub(r"(?m)^[ \t]+$", "", text) if " \n" in text or "\t\n" in text else text
    return (re.sub(r"\n{3,}", "\n\n", text) if "\n\n\n" in text else text).strip(" \t\n")


def containers(text: str) -> str:
    """':::type title' blocks as alerts, or bare content for other types. Inner ones are done first; one without an end stays."""
    if ":::" not in text:
        return text
    stack: list[tuple[re.Match[str], list[str]]] = []
    out: list[str] = []
    for line in text.split("\n"):
        end, start = _CONTAINER_END.match(line), _CONTAINER.match(line)
        if end and stack and len(end[1]) >= len(stack[-1][0][2]):
            m, body = stack.pop()
            title = (m[4] or m[5] or "").strip().strip("\"'")
            inner = dedented("\n".join(body))
            label = ALERTS.get(m[3].lower())
            done = alert(label, inner, title) if label else "\n\n".join(x for x in (title, inner) if x)
            (stack[-1][1] if stack else out).extend(m[1] + x if x else x for x in done.split("\n"))
        elif start and not end:
            stack.append((start, []))
        else:
            (stack[-1][1] if stack else out).append(line)
    for m, body in stack:
        out += [m[0], *body]
    return "\n".join(out)


def unwrapped(text: str) -> str:
    """Presentational wrappers go, with the end tags that belong to them; others stay."""
    dropped: list[bool] = []

    def change(m: re.Match[str]) -> str:
        if m[1]:
            return "" if dropped and dropped.pop() else m[0]
        if m[3].endswith("/"):
            return "" if _LAYOUT.search(m[3]) else m[0]
        dropped.append(_LAYOUT.search(m[3]) is not None)
        return "" if dropped[-1] else m[0]

    return _LAYOUT_TAG.sub(change, text) if "<" in text else text


def _below_heading(fields: dict[str, str], body: str, about: bool = True) -> str:
    title = fields.get("title") or fields.get("hero.name") or ""
    if not title or has_h1(body):
        return body.strip() + "\n"
    more = (fields.get("description") or fields.get("hero.text") or "") if about else ""
    return "\n\n".join(x for x in (f"# {title}", more, body.strip()) if x) + "\n"


# --- shared renderers: (props, rendered body, context) -> text


def _alert(label: str) -> Render:
    return lambda p, body, c: alert(ALERTS.get(p.text("type").lower(), label), dedented(body), p.text("title"))


def _bare(p: Props, body: str, c: Context) -> str:
    return dedented(body)


def _nothing(p: Props, body: str, c: Context) -> str:
    return ""


def _labelled(name: str = "title") -> Render:
    return lambda p, body, c: "\n\n".join(x for x in (f"**{p.text(name)}**" if p.text(name) else "", dedented(body)) if x)


def _card(p: Props, body: str, c: Context) -> str:
    title, href = p.text("title"), p.text("href")
    head = f"**[{title}]({c.resolve(href)})**" if title and href else f"**{title}**" if title else f"[{c.resolve(href)}]({c.resolve(href)})" if href else ""
    return "\n\n".join(x for x in (head, dedented(body)) if x)


STEP = "\x04"


def _step(p: Props, body: str, c: Context) -> str:
    """A step is marked; its number depends on the group around it, which is rendered after it."""
    title, inner = p.text("title"), dedented(body)
    lines = [f"{STEP}**{title}**" if title else STEP]
    if inner:
        lines += ["", *("\x05" + x if x else x for x in inner.split("\n"))]
    return "\n".join(lines)


def _numbered(text: str) -> str:
    n = 0

    def number(m: re.Match[str]) -> str:
        nonlocal n
        if m[0] == STEP:
            n += 1
            return f"{n}. "
        return " " * (len(str(n)) + 2)

    return re.sub(r"[\x04\x05]", number, text)


def _steps(p: Props, body: str, c: Context) -> str:
    return _numbered(re.sub(r"\n{2,}(?=\x04)", "\n", dedented(body)))


def _update(p: Props, body: str, c: Context) -> str:
    tags = p.get("tags")
    tags = [str(t) for t in tags] if isinstance(tags, list) else re.findall(r"[\"']([^\"']+)[\"']", str(tags or ""))
    head = (p.text("label") or "Update") + (f" ({', '.join(tags)})" if tags else "")
    return "\n\n".join(x for x in (f"## {head}", f"*{p.text('description')}*" if p.text("description") else "", dedented(body)) if x)


def _video(p: Props, body: str, c: Context) -> str:
    src = p.text("src") or (m[1] if (m := re.search(r"src=[\"']([^\"']+)", body)) else "")
    return f"[Video]({c.resolve(src)})" if src else ""


# --- VitePress


def _badge(p: Props, body: str, c: Context) -> str:
    return p.text("text") or body.strip()


def vitepress(text: str) -> str:
    """Badges become text, layout wrappers go, containers become alerts; the title heads a page without a heading."""
    fields, body = split_front(text.lstrip("﻿"))
    body = around_code(body, lambda t: containers(unwrapped(rendered(t, by_name({"Badge": _badge}), Context()))), "indented")
    return _below_heading(fields, body)


# --- Starlight MDX

_IMPORT = re.compile(r"^(?:import|export)[ \t]+[^\n]*$\n?", re.M)
_LOOSE = re.compile(r"</?[A-Z][\w.-]*(?:\s(?:[^<>\"'{}]|\"[^\"]*\"|'[^']*'|\{[^{}]*\})*)?/?>")


def mdx(text: str) -> str:
    """Comments become HTML ones, callouts alerts, tab items labelled blocks; other components lose their tags."""
    fields, body = split_front(text.lstrip("﻿"))
    registry = by_name({"Callout": _alert("NOTE"), "Aside": _alert("NOTE"), "TabItem": _labelled("label"), "Tabs": _bare})

    def passes(t: str) -> str:
        t = between(t, "{/*", "*/}", lambda c: f"<!-- {c.strip().replace('--', '==')} -->")
        t = rendered(containers(t), registry, Context())
        t = _IMPORT.sub("", t) if "import" in t or "export" in t else t
        return _spaced(_LOOSE.sub("", t) if "<" in t else t)

    return _below_heading(fields, around_code(body, passes, "indented"), about=False)


# --- component MDX

_CALLOUTS = {n.capitalize(): _alert(label) for n, label in ALERTS.items()}
_ENDS_WIDGET: dict[str, Render] = {"Icon": _nothing, "Explorer": _nothing, "SalesCard": _nothing, "BackToIndex": _nothing, "Experiment": _nothing}
_COMPONENTS: dict[str, Render] = {
    **_CALLOUTS, "Step": _step, "Steps": _steps, "Tab": _labelled(), "Tabs": _bare, "Accordion": _labelled(), "AccordionGroup": _bare, "Expandable": _labelled(),
    "Card": _card, "CardGroup": _bare, "Columns": _bare, "CodeGroup": _bare, "Frame": _bare, "Update": _update, "video": _video, "script": _nothing,
    "C": lambda p, body, c: f"`{body}`", "B": lambda p, body, c: f"**{body}**", "A": lambda p, body, c: f"[{body}]({c.resolve(p.text('href'))})",
}
_PRESENTATION = re.compile(r"\s+(?:style|className|class|data-path)=(?:\"[^\"]*\"|'[^']*'|\{\{[^{}]*\}\}|\{[^{}]*\})")
_HTML_TAG = re.compile(r"<(?:a|br|button|code|div|em|h[1-6]|hr|img|input|kbd|li|ol|p|path|pre|small|span|strong|sub|sup|svg|table|tbody|td|th|thead|tr|ul)\b[^<>]*>")


def _shown(value: object) -> str | None:
    rows = [r for r in value if isinstance(r, dict)] if isinstance(value, list) else []
    if rows:
        keys = list(dict.fromkeys(k for r in rows for k in r))
        return table([cell(k) for k in keys], [[cell(r.get(k)) for k in keys] for r in rows])
    if isinstance(value, list):
        return "\n".join(f"- {cell(v)}" for v in value)
    if isinstance(value, dict):
        return "\n\n".join(f"## {k}\n\n{_shown(v) if isinstance(v, (list, dict)) else v}" for k, v in value.items())
    return None


def data_sections(text: str) -> str:
    """Exported data as Markdown: lists of records become tables, other readable collections sections; unreadable ones stay as code."""
    if "export" not in text:
        return text
    names, out, at, closed = declarations(text), [], 0, True
    reader = Reader(text, names)
    for m in re.finditer(r"^[ \t]*export[ \t]+(?:const|let|var)[ \t]+([A-Za-z_$][\w$]*)[ \t]*=[ \t]*", text, re.M):
        if m.start() < at:
            continue
        try:
            value, end = reader.value(m.end(), frozenset([m[1]]))
            done = _shown(value)
        except Unreadable:
            opens = re.compile(r"[\[{(]").search(text, m.end())
            end = bracket_end(text, opens.start()) if opens and closed else -1
            closed = closed and end >= 0
            end = end if end > 0 else text.find("\n", m.end()) % (len(text) + 1)
            done = None
        end += text[end : end + 1] == ";"
        out += (text[at : m.start()], fenced(text[m.start() : end].strip(), "jsx") if done is None else done)
        at = end
    return "".join(out) + text[at:]


def components(text: str, resolve: Callable[[str], str] = lambda href: href) -> str:
    """Callouts, steps, tabs, accordions, cards, updates and data as Markdown; scripts, widgets and presentation go."""
    context = Context(resolve=resolve, source=text)

    def passes(t: str) -> str:
        t = unwrapped(data_sections(between(t, "{/*", "*/}", lambda c: "")))
        t = _numbered(rendered(t, by_name(_COMPONENTS, _ENDS_WIDGET), context))
        return _spaced(_HTML_TAG.sub(lambda m: _PRESENTATION.sub("", m[0]), t))

    return around_code(text.lstrip("﻿"), passes) + "\n"


# --- Astro MDX


def _readable(render: Render) -> Render:
    return lambda p, body, c: render(p, body, c) if p.readable else None


def _link(label: str, href: str, c: Context) -> str:
    return f"[{cell(label)}]({c.resolve(href)})" if href else cell(label)


def _toggle(p: Props, body: str, c: Context) -> str:
    return f"<details>\n<summary>{p.text('title')}</summary>\n\n{dedented(body)}\n\n</details>"


def _tree(p: Props, body: str, c: Context) -> str:
    def lines(items: list, depth: int) -> list[str]:
        found = []
        for i in (x for x in items if isinstance(x, dict)):
            note = f"  # {i['comment']}" if i.get("comment") else ""
            found.append("  " * depth + str(i.get("name", "")) + note)
            found += lines(i["children"], depth + 1) if isinstance(i.get("children"), list) else []
        return found

    return fenced("\n".join(lines(p.get("tree") if isinstance(p.get("tree"), list) else [], 0)), "text")


def _pricing(p: Props, body: str, c: Context) -> str:
    price = f" ({p.text('price')}{p.text('interval')})" if p.text("price") else ""
    action = f"[{p.text('ctaLabel')}]({c.resolve(p.text('ctaHref'))})" if p.text("ctaLabel") and p.text("ctaHref") else ""
    return "\n\n".join(x for x in (f"### {p.text('name') or 'Plan'}{price}", p.text("subtitle"), action, dedented(body)) if x)


def _model(p: Props, body: str, c: Context) -> str:
    data = p.get("data")
    shown = {True: "Supported", False: "Not supported"}
    facts = [(str(f.get("title", "")), f.get("value")) for f in Props(data if isinstance(data, dict) else {}).rows("features")]
    items = [f"- **{t}**: {shown.get(v, v) if isinstance(v, bool) else v}" for t, v in facts if v not in (None, "")]
    return "\n\n".join(x for x in (f"### `{p.text('name')}`" if p.text("name") else "", p.text("description"), "\n".join(items)) if x)


def _options(p: Props, body: str, c: Context) -> str:
    rows = [[f"`{cell(o.get('key'))}`", f"`{cell(o.get('type'))}`", cell(o.get("description"))] for o in p.rows("options")]
    return table(["Key", "Type", "Description"], rows) if rows else ""


def _glossary(p: Props, body: str, c: Context) -> str:
    rows = [[_link(str(o.get("key", "")), str(o.get("href") or ""), c), cell(o.get("appliesTo")), cell(o.get("description"))] for o in p.rows("options")]
    return table(["Term", "Applies to", "Definition"], rows) if rows else ""


def _matrix(p: Props, body: str, c: Context) -> str:
    data = Props(p["data"]) if isinstance(p.get("data"), dict) else Props()
    plans = data.rows("plans")
    shown = {True: "Supported", False: "Not supported", None: "—"}
    out = []
    for s in map(Props, data.rows("sections")):
        rows = []
        for f in s.rows("features"):
            has = f.get("availability") if isinstance(f.get("availability"), dict) else {}
            values = [has.get(plan.get("id")) for plan in plans]
            rows.append([_link(str(f.get("name", "")), str(f.get("href") or ""), c), *(cell(shown[v] if v is None or isinstance(v, bool) else v) for v in values)])
        if s.text("title"):
            out.append(f"### {s.text('title')}")
        if rows and plans:
            out.append(table(["Feature", *(cell(x.get("label") or x.get("id")) for x in plans)], rows))
    return "\n\n".join(out)


def _collection(base: str) -> Render:
    return lambda p, body, c: "\n".join(f"- [{str(s).replace('-', ' ').replace('/', ' ').strip().capitalize()}]({base}/{s})" for s in (p.get("slugs") if isinstance(p.get("slugs"), list) else []) if s)


def _overview(p: Props, body: str, c: Context) -> str:
    out = [f"# {p.text('title')}" if p.text("title") and not has_h1(c.source) else "", p.text("description"), p.text("intro") if p.text("intro") != p.text("description") else ""]
    action = p.get("primaryCta")
    if isinstance(action, dict) and action.get("href"):
        out.append(f"> **Recommended:** [{action.get('label', 'Primary guide')}]({c.resolve(str(action['href']))})")
    for s in map(Props, p.rows("sections")):
        out += [f"## {s.text('title')}", s.text("description")]
        out.append("\n".join(f"- [{x.get('title', '')}]({c.resolve(str(x.get('href', '')))})" + (f": {x['description']}" if x.get("description") else "") for x in s.rows("pages")))
    return "\n\n".join(x for x in out if x)


def _surface(p: Props, body: str, c: Context) -> str:
    """A part for some surfaces, under an anchor that is numbered when it comes again."""
    names = [p.text("id")] if p.text("id") else [s.strip() for s in p.text("ids").split(",") if s.strip()]
    anchors = []
    for s in names:
        n = c.number(f"surface {s}")
        anchors.append(f'<a id="{s}{"" if n == 1 else f"-{n}"}"></a>')
    return "\n\n".join(x for x in ("".join(anchors), f"**{', '.join(names)}**" if names else "", dedented(body)) if x)


_CELL = re.compile(r"<(t[hd])\b([^<>]*)>((?:[^<]|<(?!/?t[hdr]\b))*)(?:</\1\s*>)?", re.I)


def html_table(source: str) -> str | None:
    """An HTML table as a Markdown one: ragged rows are filled up, alignment is kept. None without rows."""
    rows, align = [], []
    for r in re.findall(r"<tr\b[^<>]*>((?:[^<]|<(?!/?tr\b))*)", source, re.I):
        cells = _CELL.findall(r)
        rows.append([cell(re.sub(r"<[^<>]*>", "", x)) for _, _, x in cells])
        if len(rows) == 1:
            sides = [m[1].lower() if (m := re.search(r"(?:align=[\"']?|text-align:\s*)(left|right|center)", a, re.I)) else "" for _, a, _ in cells]
            align = [{"left": ":---", "right": "---:", "center": ":---:"}.get(s, "---") for s in sides]
    return table(rows[0], rows[1:], align) if rows else None


def _callout_link(p: Props, body: str, c: Context) -> str:
    return f"> **[{p.text('title')}]({c.resolve(p.text('href'))})**\n>\n> {p.text('description')}" if p.text("title") and p.text("href") else ""


def astro(text: str, resolve: Callable[[str], str] = lambda href: href, collections: str = "/collections") -> str:
    """Page components as Markdown; one with properties that cannot be read stays as it is, decoration goes."""
    context = Context(resolve=resolve, source=text)
    named: dict[str, Render] = {
        "ToggleSection": _toggle, "FileTree": _tree, "PricingCard": _pricing, "ModelDetails": _model, "ConfigTable": _options, "GlossaryTable": _glossary, "PlanFeatureMatrix": _matrix,
        "PromptComponent": lambda p, body, c: fenced(p.text("prompt")) if p.text("prompt") else "", "TableWrapper": lambda p, body, c: html_table(body) or dedented(body),
        "WarningTip": lambda p, body, c: alert("WARNING", dedented(body)), "Alert": lambda p, body, c: alert("NOTE", p.text("description")) if p.text("description") else "",
        "CtaPillLink": lambda p, body, c: _link(p.text("label"), p.text("href"), c) if p.text("href") and p.text("label") else "", "ButtonLink": lambda p, body, c: _link(body.strip(), p.text("href"), c),
        "VideoPlayer": lambda p, body, c: f"[Video Demo]({c.resolve(p.text('src'))})" if p.text("src") else "", "ContentModeSwitch": _surface, "ContentSwitcher": _bare, "OverviewLanding": _overview,
    }
    ends: dict[str, Render] = {
        "Overview": _overview, "Callout": _callout_link, "CollectionList": _collection(collections), "Keycap": lambda p, body, c: f"**{p.text('label')}**" if p.text("label") else "",
        "Screenshot": lambda p, body, c: f"![{p.text('alt') or 'Screenshot'}]({c.resolve(p.text('src'))})" if p.text("src") else "", "Container": _bare, "Grid": _bare, "Wrapper": _bare,
        "Icon": _nothing, "Illustration": _nothing, "Animation": _nothing, "Hero": _nothing, "Divider": _nothing, "Carousel": _nothing,
    }
    registry = by_name({k: _readable(v) for k, v in named.items()}, {k: _readable(v) for k, v in ends.items()})
    _, body = split_front(text.lstrip("﻿"))
    return around_code(body, lambda t: _spaced(rendered(_IMPORT.sub("", between(t, "{/*", "*/}", lambda c: "")), registry, context))) + "\n"
