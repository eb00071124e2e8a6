"""Markdown clean-up.

Two forms with one meaning. Over a relation of lines (doc_id, pos, line) each rule is a projection, a filter or a
window over one document, so rules can be used, and checked, one by one. `clean` runs all of them over one text
in order, for use inside the Arrow function that turns pages into markdown, where no shuffle is needed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

IMAGE_MARK = "<!-- image -->"
# Words of section titles, captions, numbered titles and the appendix that ends a report.
SECTION_WORDS = ["前言", "结语", "摘要", "介绍", "结论", "方法", "分析", "总结", "附录"]
CAPTIONS = [r"^(##\s*)?图\d+\.\d+\s+.+", r"^(##\s*)?表\d+\.\d+\s+.+", r"^Table\s+\d+\.\s+.+", r"^Figure\s+\d+\.\s+.+"]
NUMBERED_TITLE = r"^[（(][一二三四五六七八九十\d]+[）)]\s*.+"
LAST_SECTION = ["## 附录4  参考链接", "## 附录4 参考链接"]
_DIGITS = "[一二三四五六七八九十0-9]"


def number_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line")).withColumn("pos", F.col("pos").cast("long"))


def join_lines(rows: DataFrame, into: str = "text") -> DataFrame:
    """One text for each document again."""
    held = F.sort_array(F.collect_list(F.struct("pos", "line")))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(held, lambda x: x["line"]), "\n").alias(into))


def _of_doc() -> Window:
    return Window.partitionBy("doc_id").orderBy("pos")


def drop_marks(rows: DataFrame) -> DataFrame:
    """Without image marks, and without single letters or digits between blank lines (or the ends)."""
    bare = strip(F.col("line"))
    blank = lambda c: F.coalesce(strip(c) == "", F.lit(True))
    lone = bare.rlike(r"^[\p{L}\p{N}]$") & blank(F.lag("line").over(_of_doc())) & blank(F.lead("line").over(_of_doc()))
    return rows.withColumn("_lone", lone).filter((bare != IMAGE_MARK) & ~F.col("_lone")).drop("_lone")


def drop_captions(rows: DataFrame) -> DataFrame:
    bare = strip(F.col("line"))
    hit = bare.rlike(CAPTIONS[0])
    for pattern in CAPTIONS[1:]:
        hit = hit | bare.rlike(pattern)
    return rows.filter(~hit)


def fix_headings(rows: DataFrame) -> DataFrame:
    """Headings that are body text lose their mark; numbered titles get one."""
    bare = strip(F.col("line"))
    body = strip(F.substring(bare, F.lit(4), F.length(bare)))
    title = body.rlike(_DIGITS) | (F.length(body) < 20)
    for word in SECTION_WORDS:
        title = title | F.contains(body, F.lit(word))
    false = F.startswith(bare, F.lit("## ")) & ~(title & ~F.endswith(body, F.lit("。")))
    numbered = bare.rlike(NUMBERED_TITLE) & ~F.startswith(bare, F.lit("#"))
    return rows.withColumn("line", F.when(false, body).when(numbered, F.concat(F.lit("## "), bare)).otherwise(F.col("line")))


def drop_fences(rows: DataFrame) -> DataFrame:
    """Without fenced blocks. Fences pair up in order; one that is left over goes alone."""
    fence = (strip(F.col("line")) == "```").cast("int")
    all_of = Window.partitionBy("doc_id")
    out = rows.withColumn("_fence", fence).withColumn("_n", F.sum("_fence").over(_of_doc())).withColumn("_all", F.sum("_fence").over(all_of))
    inside = (F.col("_n") % 2 == 1) & (F.col("_n") < F.col("_all"))
    return out.filter((F.col("_fence") == 0) & ~inside).drop("_fence", "_n", "_all")


def setext_to_atx(rows: DataFrame) -> DataFrame:
    """A line over === or --- becomes a heading and the underline goes; an underline under nothing takes both lines along.

    Where underlines follow one another, the first that serves as an underline can't serve as a title, and so on
    down the run: every second line of a run of underlines is one.
    """
    bare = strip(F.col("line"))
    kind = F.when(bare.rlike("^=+$"), 1).when(bare.rlike("^-{3,}$"), 2).otherwise(0)
    w = _of_doc()
    out = rows.withColumn("_kind", kind).withColumn("_row", F.row_number().over(w))
    # an underline's place in its run of underlines; the first line of a document can't be one
    run = F.max(F.when(F.col("_kind") == 0, F.col("_row"))).over(w)
    out = out.withColumn("_place", F.col("_row") - F.greatest(F.coalesce(run, F.lit(0)), F.when(F.min("_kind").over(w.rowsBetween(Window.unboundedPreceding, 0)) > 0, 1).otherwise(0)))
    used = (F.col("_kind") > 0) & (F.col("_place") % 2 == 1)
    out = out.withColumn("_used", used)
    out = out.withColumn("_under", F.when(F.lead("_used").over(w), F.lead("_kind").over(w)).otherwise(0))
    marked = F.when(F.col("_under") == 1, F.concat(F.lit("# "), bare)).when(F.col("_under") == 2, F.concat(F.lit("## "), bare)).otherwise(F.col("line"))
    out = out.withColumn("_new", marked).filter(~F.col("_used") & ~((F.col("_under") > 0) & (bare == "")))
    return out.select("doc_id", "pos", F.col("_new").alias("line"))


def is_table_row(line: Column) -> Column:
    return strip(line).rlike(r"(?s)^\|.*\|$")


def is_separator(line: Column) -> Column:
    """A table row whose cells are empty or made of dashes and colons."""
    return strip(line).rlike(r"^\|[-:|\s]*\|$") | (strip(line) == "|")


def clean_tables(rows: DataFrame) -> DataFrame:
    """Runs of table rows and blank lines become one table: no blanks, and one separator, its own first one after the first row or a made one."""
    w = _of_doc()
    row, blank = is_table_row(F.col("line")), strip(F.col("line")) == ""
    out = rows.withColumn("_row", row).withColumn("_run", F.sum((~row & ~blank).cast("int")).over(w))
    in_run = Window.partitionBy("doc_id", "_run").orderBy("pos")
    # blanks count as part of a table only after its first row
    out = out.withColumn("_seen", F.sum(F.col("_row").cast("int")).over(in_run)).filter(~(blank & (F.col("_seen") > 0)))
    out = out.withColumn("_sep", F.col("_row") & is_separator(F.col("line")))
    out = out.withColumn("_nth_sep", F.sum((F.col("_sep") & (F.col("_seen") > 1)).cast("int")).over(in_run))
    out = out.filter(~F.col("_sep") | ((F.col("_seen") > 1) & (F.col("_nth_sep") == 1)))
    whole = Window.partitionBy("doc_id", "_run")
    out = out.withColumn("_has", F.max(F.col("_sep").cast("int")).over(whole)).withColumn("_nth", F.sum(F.col("_row").cast("int")).over(in_run))
    columns = F.length("line") - F.length(F.replace("line", F.lit("|"), F.lit(""))) - 1
    made = F.when(F.col("_row") & (F.col("_nth") == 1) & (F.col("_has") == 0), F.array("line", F.concat(F.lit("|"), F.repeat(F.lit("------|"), columns))))
    out = out.select("doc_id", "pos", F.posexplode(F.coalesce(made, F.array("line"))).alias("_k", "line"))
    return out.select("doc_id", (F.col("pos") * 2 + F.col("_k")).alias("pos"), "line")


def collapse_blanks(rows: DataFrame, most: int = 2) -> DataFrame:
    blank = strip(F.col("line")) == ""
    out = rows.withColumn("_run", F.sum((~blank).cast("int")).over(_of_doc()))
    nth = F.sum(blank.cast("int")).over(Window.partitionBy("doc_id", "_run").orderBy("pos"))
    return out.withColumn("_nth", nth).filter(~blank | (F.col("_nth") <= most)).drop("_run", "_nth")


def drop_after_last_section(rows: DataFrame) -> DataFrame:
    seen = F.max(strip(F.col("line")).isin(LAST_SECTION).cast("int")).over(_of_doc())
    return rows.withColumn("_seen", seen).filter("_seen = 0").drop("_seen")


def clean_lines(rows: DataFrame) -> DataFrame:
    """All rules. Fences go first: what they hold is not seen by any other rule."""
    out = fix_headings(drop_captions(drop_fences(drop_marks(rows))))
    return drop_after_last_section(collapse_blanks(clean_tables(setext_to_atx(out))))


# -- one text at a time, inside Arrow functions -------------------------------------------------

_SEPARATOR = re.compile(r"\|[-:|\s]*\|$|\|$")
_UNDERLINES = (("# ", re.compile("=+$")), ("## ", re.compile("-{3,}$")))


def _row(line: str) -> bool:
    return len(line) > 1 and line[0] == line[-1] == "|"


def _kept_lines(lines: list[str]) -> list[str]:
    bare, out, at = [x.strip() for x in lines], [], 0
    fences = [k for k, x in enumerate(bare) if x == "```"]
    ends = dict(zip(fences[::2], fences[1::2], strict=False))
    while at < len(lines):
        x, here = bare[at], at
        at += 1
        around = (bare[here - 1] if here else "") + (bare[at] if at < len(bare) else "")
        if x == "```":
            at = ends.get(here, here) + 1
        elif x == IMAGE_MARK or (len(x) == 1 and x.isalnum() and not around) or any(re.match(p, x) for p in CAPTIONS):
            continue
        elif x.startswith("## "):
            body = x[3:].strip()
            title = not body.endswith("。") and (re.search(_DIGITS, body) or len(body) < 20 or any(w in body for w in SECTION_WORDS))
            out.append(lines[here] if title else body)
        else:
            out.append(f"## {x}" if re.match(NUMBERED_TITLE, x) else lines[here])
    return out


def _headings(lines: list[str]) -> list[str]:
    out, at = [], 0
    while at < len(lines):
        under = lines[at + 1].strip() if at + 1 < len(lines) else ""
        mark = next((m for m, pattern in _UNDERLINES if pattern.match(under)), None)
        if mark is None:
            out.append(lines[at])
        elif lines[at].strip():
            out.append(mark + lines[at].strip())
        at += 1 if mark is None else 2
    return out


def _tables(lines: list[str]) -> list[str]:
    out, table = [], []

    def flush() -> None:
        if table:
            own = next((k for k, x in enumerate(table) if k and _SEPARATOR.match(x.strip())), None)
            rows = [x for k, x in enumerate(table) if k == own or not _SEPARATOR.match(x.strip())]
            if own is None and rows:
                rows.insert(1, "|" + "------|" * (rows[0].count("|") - 1))
            out.extend(rows)
            table.clear()

    for line in lines:
        if _row(line.strip()):
            table.append(line)
        elif line.strip() or not table:
            flush()
            out.append(line)
    flush()
    return out


def clean(text: str) -> str:
    """All rules over one text."""
    out, blanks = [], 0
    for line in _tables(_headings(_kept_lines(text.split("\n")))):
        if line.strip() in LAST_SECTION:
            break
        blanks = 0 if line.strip() else blanks + 1
        if blanks <= 2:
            out.append(line)
    return "\n".join(out)
