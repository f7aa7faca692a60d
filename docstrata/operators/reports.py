"""Indexes, change logs and issue reports as ordered lines. Order is a column; rendering sorts within one document only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docstrata.functions.canonical import stripped
from docstrata.functions.text import code_safe, log_escaped, title_escaped
from docstrata.functions.urls import safe_url
from docstrata.runtime import small

DEFAULT_GROUP = "Documentation"


def group_name(column: str = "page_group"):
    return F.coalesce(F.nullif(stripped(F.col(column)), F.lit("")), F.lit(DEFAULT_GROUP))


def group_counts(pages: DataFrame) -> DataFrame:
    """(source, page_group, pages): blank groups go to the default one."""
    return pages.groupBy("source", group_name().alias("page_group")).agg(F.count("*").alias("pages"))


def index_lines(pages: DataFrame) -> DataFrame:
    """(source, page_group, group_pos, slug, line): table rows of each source's index; the group 'root' comes first, then by name and slug.

    group_pos is ranked over the groups of a source, not over its pages.
    """
    rows = pages.withColumn("page_group", group_name())
    groups = rows.select("source", "page_group").distinct()
    pos = F.row_number().over(Window.partitionBy("source").orderBy(F.col("page_group") != "root", "page_group")).cast("long")
    line = F.concat(F.lit("| "), title_escaped(F.coalesce("title", F.lit(""))), F.lit(" | ["), "slug", F.lit(".md](./"), "slug", F.lit(".md) | [source](<"), safe_url(F.coalesce("source_url", F.lit(""))), F.lit(">) |"))
    return rows.join(groups.withColumn("group_pos", pos), ["source", "page_group"]).select("source", "page_group", "group_pos", "slug", line.alias("line"))


def rendered_index(pages: DataFrame, sources: DataFrame, source: str, updated: str) -> str:
    """The index document of one source; an export of one source's pages, read in order."""
    info = sources.where(F.col("source") == source).first()
    out = [f"# {info.title} — Documentation Index", ""]
    if info.version and info.version != "—":
        out.append(f"- **Version:** {info.version}")
    out += [f"- **Last updated:** {updated}", f"- **Official docs:** {info.home_url}", ""]
    group = None
    for r in index_lines(pages.where(F.col("source") == source)).orderBy("group_pos", "slug").toLocalIterator():
        if r.page_group != group:
            out += ([""] if group is not None else []) + [f"## {info.title if r.page_group == 'root' else ' '.join(r.page_group.split())}", "", "| Page | Local | Source |", "| --- | --- | --- |"]
            group = r.page_group
        out.append(r.line)
    return "\n".join(out).rstrip() + "\n"


def index_parts(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, group_pos, text): the index of every source in parts, its head as part 0 and then a part for each group.

    Parts are made in tasks and put one after the other by whoever reads them in order; the largest is one group's.
    """
    lines = index_lines(pages)
    by = lines.groupBy("source", "group_pos", "page_group").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("slug", "line"))), lambda x: x["line"]), "\n").alias("rows"))
    titled = by.join(small(sources.select("source", F.coalesce("title", "source").alias("title"))), "source")
    name = F.when(F.col("page_group") == "root", F.col("title")).otherwise(F.trim(F.regexp_replace("page_group", r"\s+", " ")))
    groups = titled.select("source", "group_pos", F.concat(F.lit("## "), name, F.lit("\n\n| Page | Local | Source |\n| --- | --- | --- |\n"), "rows", F.lit("\n")).alias("text"))
    heads = sources.join(small(lines.select("source").distinct()), "source", "left_semi").select("source", F.lit(0).cast("long").alias("group_pos"), F.concat(F.lit("# "), F.coalesce("title", "source"), F.lit(" — Documentation Index\n")).alias("text"))
    return heads.unionByName(groups)


SECTIONS = ("added", "modified", "renamed", "removed")


def log_lines(changes: DataFrame) -> DataFrame:
    """(source, change_type, section_pos, sort_slug, line): the bullets of a change log; renames sort by their old slug, ids before titles."""
    kind = F.col("change_type")
    pos = F.array_position(F.array(*map(F.lit, SECTIONS)), kind)
    link = F.concat(F.lit("[source](<"), safe_url(F.coalesce("source_url", F.lit(""))), F.lit(">)"))
    name = F.concat(F.lit("- **"), log_escaped(F.coalesce("title", F.lit(""))), F.lit("**"))
    code = lambda c: F.concat(F.lit("`"), code_safe(F.col(c)), F.lit("`"))
    moved = F.concat(name, F.lit(" moved "), code("old_slug"), F.lit(" → "), code("slug"), F.lit(" (matched by "), "matched_by", F.lit(") — "), link)
    plain = F.concat(name, F.lit(" — "), code("slug"), F.lit(" — "), link, F.when(kind == "removed", " (no longer in the source; possibly deprecated)").otherwise(""))
    order = F.when(kind == "renamed", F.concat(F.when(F.col("matched_by") == "source_id", "0").otherwise("1"), "old_slug")).otherwise(F.col("slug"))
    return changes.select("source", "change_type", pos.alias("section_pos"), order.alias("sort_slug"), F.when(kind == "renamed", moved).otherwise(plain).alias("line"))


def rendered_log(changes: DataFrame, stamp: str) -> str:
    """One section of a change log, for the changes of one source and run."""
    rows = log_lines(changes).orderBy("section_pos", "sort_slug").toLocalIterator()
    title = {"added": "➕ Added", "modified": "✏️ Modified", "renamed": "🔀 Renamed / Moved", "removed": "➖ Removed"}
    sections: dict[str, list[str]] = {}
    for r in rows:
        sections.setdefault(r.change_type, []).append(r.line)
    total = sum(map(len, sections.values()))
    out = [f"## {stamp} — {total} change{'' if total == 1 else 's'}", ""]
    for kind in SECTIONS:
        if kind in sections:
            out += [f"### {title[kind]} ({len(sections[kind])})", *sections[kind], ""]
    return "\n".join(out).rstrip() + "\n"


def source_stats(sources: DataFrame, pages: DataFrame, runs: DataFrame) -> DataFrame:
    """(source, title, pages, last_completed, version) for every source, also those without pages or runs."""
    counts = pages.groupBy("source").agg(F.count("*").alias("pages"))
    last = runs.where("outcome = 'ok'").groupBy("source").agg(F.max("completed").alias("last_completed"))
    rows = sources.select("source", "title", "version").join(counts, "source", "left").join(last, "source", "left")
    return rows.select("source", "title", F.coalesce("pages", F.lit(0)).alias("pages"), "last_completed", F.coalesce(F.nullif(stripped(F.col("version")), F.lit("")), F.lit("—")).alias("version"))


def with_total(stats: DataFrame) -> DataFrame:
    """(source, pages), and a row of the total with source null."""
    return stats.rollup("source").agg(F.sum("pages").alias("pages"))


def aligned_table(header: list[str], rows: list[list[str]]) -> list[str]:
    """A Markdown table with columns as wide as their widest cell on a terminal, for a few rows of a report."""
    from docstrata.functions.text import width_of

    widths = [max(3, *(width_of(r[k]) for r in [header, *rows])) for k in range(len(header))]
    draw = lambda r: "| " + " | ".join(c + " " * (w - width_of(c)) for c, w in zip(r, widths, strict=True)) + " |"
    return [draw(header), "| " + " | ".join("-" * w for w in widths) + " |", *map(draw, rows)]


def between_markers(document: str, name: str, lines: list[str]) -> str:
    """The document with what stands between its two markers replaced; without them it is as it was."""
    start, end = f"<!-- {name}:start -->", f"<!-- {name}:end -->"
    a, b = document.find(start), document.find(end)
    return document if a < 0 or b < a else document[: a + len(start)] + "\n" + "\n".join(lines) + "\n" + document[b:]


def issues_by_file(issues: DataFrame) -> DataFrame:
    """(file, issues, first_line): per file; blank files are left out."""
    return issues.where(stripped(F.col("file")) != "").groupBy("file").agg(F.count("*").alias("issues"), F.min("line").alias("first_line"))


def occurrence_anchors(headings: DataFrame, doc: str, anchor: str, pos: str) -> DataFrame:
    """Adds unique_anchor: the second time an anchor occurs in a document it is 'anchor-2', and so on."""
    n = F.row_number().over(Window.partitionBy(doc, anchor).orderBy(pos))
    return headings.withColumn("unique_anchor", F.when(n == 1, F.col(anchor)).otherwise(F.concat(F.col(anchor), F.lit("-"), n)))


def heading_changes(rows: DataFrame, doc: str, header: str, pos: str) -> DataFrame:
    """Adds starts_group: the header differs from the row before."""
    before = F.lag(header).over(Window.partitionBy(doc).orderBy(pos))
    return rows.withColumn("starts_group", ~F.col(header).eqNullSafe(before) | before.isNull())


def feature_matrix(options: DataFrame, plans: list[str]) -> DataFrame:
    """(section, feature, one column a plan): the pivot of (section, feature, plan, value)."""
    return options.groupBy("section", "feature").pivot("plan", plans).agg(F.first("value", ignorenulls=True))
