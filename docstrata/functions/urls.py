"""URLs, slugs and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docstrata.functions.canonical import stripped

MAX_SLUG = 200
# Signs that would end a Markdown link destination, and what stands for them.
URL_ESCAPES = {"<": "%3C", ">": "%3E", "\n": "%0A", "\r": "%0D", "|": "%7C"}


def clean_url(url: Column) -> Column:
    """Without surrounding blanks, query, fragment and trailing slashes."""
    return F.rtrim(F.regexp_replace(stripped(url), r"(?s)[?#].*\z", ""), F.lit("/"))


def same_origin(url: Column, site: Column) -> Column:
    """The URL is the site or below it; 'https://a.b' does not contain 'https://a.bc'."""
    base = F.rtrim(site, F.lit("/"))
    return (url == base) | F.startswith(url, F.concat(base, F.lit("/")))


def safe_url(url: Column) -> Column:
    """Escapes what would break out of an angle-bracketed link destination, and nothing else."""
    for sign, code in URL_ESCAPES.items():
        url = F.replace(url, F.lit(sign), F.lit(code))
    return url


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def slug_below(url: Column, site: Column, prefix: str = "", root: str = "index") -> Column:
    """The path of a page below the site and prefix; the root page gets its own slug. Null outside of them."""
    clean = clean_url(url)
    base = F.concat(F.rtrim(site, F.lit("/")), F.lit(prefix.rstrip("/")))
    rest = F.substr(clean, F.length(base) + 2)
    return F.when(clean == base, root).when(F.startswith(clean, F.concat(base, F.lit("/"))) & (rest != ""), rest)


def parent_group(slug: Column) -> Column:
    """The directory of a slug; '' for a page of the top level."""
    return F.regexp_replace(slug, r"/?[^/]*\z", "")


def first_group(slug: Column, root: str = "root") -> Column:
    """The first path segment, or root for a page of the top level."""
    return F.when(F.contains(slug, F.lit("/")), F.split_part(slug, F.lit("/"), F.lit(1))).otherwise(root)


def without_anchor(url: Column) -> Column:
    return F.regexp_replace(url, r"(?s)#.*\z", "")


def markdown_twin(url: Column) -> Column:
    """The address of the Markdown form of a page."""
    clean = clean_url(url)
    return F.when(clean.rlike(r"\.mdx?\z"), clean).otherwise(F.concat(clean, F.lit(".md")))


def page_url(site: Column, slug: Column) -> Column:
    """The human-facing address of a slug: no final index or README."""
    return F.concat_ws("/", F.rtrim(site, F.lit("/")), F.nullif(F.regexp_replace(slug, r"(?:^|/)(?:index|README)\z", ""), F.lit("")))


def slug_violation(slug: Column) -> Column:
    """The first rule a slug breaks, or null: blank, padded, long, sign, absolute, parent, trailing, empty."""
    parts = F.split(slug, "/")
    return (
        F.when(slug.isNull() | (stripped(slug) == ""), "blank")
        .when(slug != stripped(slug), "padded")
        .when(F.length(slug) > MAX_SLUG, "long")
        .when(~slug.rlike(r"^[A-Za-z0-9._/-]+\z"), "sign")
        .when(F.startswith(slug, F.lit("/")), "absolute")
        .when(F.array_contains(parts, ".."), "parent")
        .when(F.endswith(slug, F.lit("/")), "trailing")
        .when(F.array_contains(parts, ""), "empty")
    )


def page_violations(slug: Column, source_url: Column, source_md_url: Column, source_id: Column) -> Column:
    """array of the rules a page record breaks; empty for a valid one."""
    blank = lambda c: c.isNull() | (stripped(c) == "")
    return F.array_compact(F.array(
        F.concat(F.lit("slug "), slug_violation(slug)),
        F.when(blank(source_id), "source_id blank").when(source_id != stripped(source_id), "source_id padded"),
        F.when(blank(source_url), "source_url blank"),
        F.when(blank(source_md_url), "source_md_url blank"),
    ))


def relative_path(target: Column, page: Column) -> Column:
    """The link from one slug to another: './' leads unless it goes up."""
    here, there = F.slice(F.split(page, "/"), 1, F.size(F.split(page, "/")) - 1), F.split(target, "/")
    both = F.least(F.size(here), F.size(there) - 1)
    same = F.aggregate(F.sequence(F.lit(1), F.greatest(both, F.lit(1))), F.lit(0), lambda n, k: F.when((n == k - 1) & (k <= both) & (F.try_element_at(here, k) == F.try_element_at(there, k)), k).otherwise(n))
    up, down = F.array_repeat(F.lit(".."), F.size(here) - same), F.slice(there, same + 1, F.size(there))
    return F.concat(F.when(F.size(here) == same, "./").otherwise(""), F.array_join(F.concat(up, down), "/"))


def unescaped_path(destination: Column) -> Column:
    """The path of a link destination: no angle brackets, query and anchor, percent signs decoded ('+' stays)."""
    bare = stripped(F.regexp_replace(F.regexp_replace(stripped(destination), r"(?s)^<(.*)>\z", "$1"), r"(?s)[?#].*\z", ""))
    return F.when(F.contains(bare, F.lit("%")), F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)).otherwise(bare)


def asset_path(rest: Column) -> Column:
    """A normal relative path below the assets, or null where it leads out of them or holds a backslash."""
    bare = F.regexp_replace(rest, r"(?s)[?#].*\z", "")
    steps = F.aggregate(
        F.split(bare, "/"), F.array().cast("array<string>"),
        lambda acc, s: F.when(acc.isNull() | s.isin("", "."), acc).when(s != "..", F.concat(acc, F.array(s))).when(F.size(acc) == 0, F.lit(None)).otherwise(F.slice(acc, 1, F.size(acc) - 1)),
    )
    bad = F.contains(rest, F.lit("\\")) | F.startswith(bare, F.lit("/")) | steps.isNull() | (F.size(steps) == 0)
    return F.when(~bad, F.array_join(steps, "/"))
