"""Which markup languages a text uses: constructs outside code."""

from __future__ import annotations

import re

HTML = re.compile(r"<!--|<!doctype\b|</?[A-Za-z][A-Za-z0-9.:-]*(?:\s+[^<>]*)?/?>|&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z]{2,8}[0-9]{0,2});", re.I)
LATEX = re.compile(
    r"\\(?:begin|end|(?:sub)*section|chapter|paragraph|emph|text(?:bf|it|tt|sc)|cite[pt]?|ref|href|url|label|item|footnote|caption|usepackage|documentclass|includegraphics|title|author|maketitle)\b\*?\s*[\[{ \n]?"
    r"|\\\[|\\\(|\\(?:frac|sqrt|sum|lfloor|rfloor|cdot|cdots|ldots|leq|geq|times|alpha|beta|left|right)\b"
    r"|\$\$[^$]+\$\$|(?<![\\\w$])\$(?=[^\s$])(?:[^$\n]*[\\^_=+*/<>][^$\n]*|[a-zA-Z])(?<!\s)\$(?![\w$])"
)
WIKI_HEADING = re.compile(r"^(={2,6})[ \t]*[^=\s](?:[^\n]*[^=\s])?[ \t]*\1[ \t]*$|^=[ \t]+[^=\s][^\n]*[ \t]=[ \t]*$", re.M)
WIKI_LINK = re.compile(r"\[\[[^\[\]\n]+\]\]")
WIKI_EXTERNAL = re.compile(r"\[(?:https?:)?//[^\s\]]+ [^\]\n]+\](?!\()")
WIKI_ITALIC = re.compile(r"(?<!['\w])''(?=[^\s'])[^'\n]*(?:'[^'\n]+)*''(?!')")
WIKI_TABLE = re.compile(r"^(?:\{\||\|\}|\|-)", re.M)
WIKI_ITEM = re.compile(r"^(?:[*#:;]+[^\s*#:;`=\-!/|<>][^\n*#]*|\*{2,}[ \t]+[^\n*]+|[:;][ \t]+\S[^\n]*)$", re.M)
WIKI_REST = re.compile(r"__(?:NO)?(?:TOC|EDITSECTION)__|<ref\b")
ATX = re.compile(r"^ {0,3}#{1,6}[ \t]+\S", re.M)
SETEXT = re.compile(r"^[^\s\-=|>][^\n]*\n {0,3}(?:={2,}|-{2,})[ \t]*$", re.M)
LINK = re.compile(r"\[[^\[\]\n]+\]\([^()\s]+(?:\([^()\s]*\)[^()\s]*)*(?:\s+\"[^\"\n]*\")?\)")
REFERENCE = re.compile(r"\[[^\[\]\n]+\]\[[^\[\]\n]*\]|^ {0,3}\[[^\[\]\n]+\]:\s+\S", re.M)
STRONG = re.compile(r"(?<![*\w\\])\*\*(?=[^\s*])[^*\n]+(?<=\S)\*\*(?![\w*])|(?<![_\w\\])__(?=[^\s_])[^_\n]+(?<=\S)__(?![\w_])|~~(?=\S)[^~\n]+~~")
EMPHASIS = re.compile(r"(?<![*\w\\])\*(?=[^\s*])[^*\n]+(?<=[^\s*])\*(?![\w*])|(?<![_\w\\/])_(?=[^\s_])[^_\n]+(?<=[^\s_])_(?![\w_])")
TABLE = re.compile(r"^ {0,3}\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)+\|?[ \t]*$", re.M)
QUOTE = re.compile(r"^ {0,3}> ?\S", re.M)
AUTOLINK = re.compile(r"<https?://[^<>\s]+>")
RULE = re.compile(r"^ {0,3}(?:(?:\*[ \t]*){3,}|(?:_[ \t]*){3,}|-{3,}[ \t]*)$", re.M)
LIST = re.compile(r"^ {0,3}(?:[-+]|\d{1,9}[.)])[ \t]+\S", re.M)
STARS = re.compile(r"^ {0,3}\*[ \t]+\S", re.M)
FRONT = re.compile(r"\A---[ \t]*\n(?:[^\n]*\n)*?---[ \t]*(?:\n|\Z)")


def is_wiki(t: str) -> tuple[bool, bool]:
    """(has a wiki construct, has one that is no list item)."""
    sure = ("'" in t and ("\'\'\'" in t or "\'\'" in t and WIKI_ITALIC.search(t) is not None)) or ("[[" in t and WIKI_LINK.search(t) is not None) or ("==" in t and WIKI_HEADING.search(t) is not None)
    sure = sure or ("[http" in t or "[//" in t) and WIKI_EXTERNAL.search(t) is not None or ("|-" in t or "{|" in t) and "{|" in t and WIKI_TABLE.search(t) is not None or ("__" in t or "<ref" in t) and WIKI_REST.search(t) is not None
    return bool(sure or WIKI_ITEM.search(t)), bool(sure)


def is_markdown(t: str, wiki: bool) -> bool:
    """Has a Markdown construct other than front matter and code. In wiki text a line's first '#', '*' is a list item."""
    if "](" in t and LINK.search(t) or "]" in t and ("][" in t or "]:" in t) and REFERENCE.search(t):
        return True
    if "#" in t and ATX.search(t) and not (wiki and not re.search(r"^ {0,3}#{2,6}[ \t]", t, re.M)):
        return True
    if ("**" in t or "__" in t or "~~" in t) and STRONG.search(t):
        return True
    if ("*" in t or "_" in t) and EMPHASIS.search(t):
        return True
    if ("--" in t or "==" in t) and (SETEXT.search(t) or RULE.search(t) or "|" in t and TABLE.search(t)):
        return True
    if ">" in t and (QUOTE.search(t) or "<http" in t and AUTOLINK.search(t)):
        return True
    return bool(LIST.search(t) or not wiki and "*" in t and STARS.search(t))


def plain_lines(body: str) -> str:
    """Without byte order mark, with LF line ends."""
    return body.lstrip("\ufeff").replace("\r\n", "\n").replace("\r", "\n")
