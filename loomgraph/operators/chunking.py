"""Cutting markdown into chunks of bounded token length that keep their headings.

Over lines (doc_id, pos, line): sections, the headings in force, runs of tables and of text, and packing of table
rows into bins, as windows over one document and folds over arrays. `chunk` cuts one text, for use inside the
Arrow function that turns pages into chunks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .markdown import is_table_row

HEADING = r"^#{1,4} "
#: Tokens kept free in a table chunk, and the least room for rows that makes cutting by rows worth while.
SPARE, LEAST_ROOM = 20, 50


def tokens(text: Column) -> Column:
    """Estimated tokens: a quarter of the characters."""
    return F.floor(F.length(text) / 4).cast("long")


def _of_doc() -> Window:
    return Window.partitionBy("doc_id").orderBy("pos")


def headings(rows: DataFrame) -> DataFrame:
    """rows with section_no and h1 ... h4: the headings in force, a higher one ending those below it."""
    w = _of_doc()
    bare = strip(F.col("line"))
    out = rows.withColumn("_level", F.when(bare.rlike(HEADING), F.length(F.regexp_extract(bare, "^(#+)", 1))).otherwise(0))
    out = out.withColumn("section_no", F.sum((F.col("_level") > 0).cast("long")).over(w))
    for k in range(1, 5):
        at = F.max(F.when(F.col("_level") == k, F.col("pos"))).over(w)
        above = F.max(F.when((F.col("_level") > 0) & (F.col("_level") < k), F.col("pos"))).over(w)
        last = F.last(F.when(F.col("_level") == k, bare), ignorenulls=True).over(w)
        out = out.withColumn(f"h{k}", F.when(above.isNull() | (at > above), last))
    return out.drop("_level")


def main_title(rows: DataFrame) -> DataFrame:
    """doc_id, title: the first `# x`, or line over ==, else the first `## x` of the first ten lines, else null."""
    w = _of_doc()
    bare = strip(F.col("line"))
    under = F.startswith(strip(F.lead("line").over(w)), F.lit("=="))
    kind = F.when(bare.rlike(r"^# "), strip(F.substring(bare, F.lit(3), F.length(bare)))).when((bare != "") & under, bare)
    second = F.when((F.col("pos") < 10) & bare.rlike("^## "), strip(F.substring(bare, F.lit(4), F.length(bare))))
    found = rows.select("doc_id", "pos", kind.alias("a"), second.alias("b"))
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("pos", c)))[c]
    return found.groupBy("doc_id").agg(F.coalesce(first("a"), first("b")).alias("title"))


def is_heading_only(content: Column) -> Column:
    """Whether every line is blank, a heading or an underline."""
    return F.forall(F.split(content, "\n"), lambda x: strip(x).rlike(r"^$|^#{1,4}([^#]|$)|^[-=]{3,}$"))


def segments(rows: DataFrame) -> DataFrame:
    """doc_id, seg_no, content_type, n_lines, content: runs of table rows and of other lines; empty and heading-only text runs go."""
    w = _of_doc()
    out = rows.withColumn("_table", is_table_row(F.col("line"))).withColumn("_new", F.coalesce(F.col("_table") != F.lag("_table").over(w), F.lit(True)))
    out = out.withColumn("_run", F.sum(F.col("_new").cast("long")).over(w))
    held = F.sort_array(F.collect_list(F.struct("pos", "line")))
    out = out.groupBy("doc_id", "_run").agg(
        F.any_value("_table").alias("_table"), F.count(F.lit(1)).alias("n_lines"), strip(F.array_join(F.transform(held, lambda x: x["line"]), "\n")).alias("content")
    )
    out = out.filter(F.col("_table") | ((F.col("content") != "") & ~is_heading_only(F.col("content"))))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("_run")).cast("long") - 1
    return out.select("doc_id", number.alias("seg_no"), F.when(F.col("_table"), "table").otherwise("text").alias("content_type"), "n_lines", "content")


def numbered(chunks: DataFrame, order: str) -> DataFrame:
    """chunk_id from 0 and total_chunks for each document."""
    whole = Window.partitionBy("doc_id")
    return chunks.withColumn("chunk_id", F.row_number().over(whole.orderBy(order)).cast("long") - 1).withColumn("total_chunks", F.count(F.lit(1)).over(whole))


def pack_rows(tables: DataFrame, most: int, header_tokens: int, sizes: str = "sizes") -> DataFrame:
    """tables with bins: for each row size, the bin that greedy packing puts it in; null where the header leaves no room.

    A fold over the array of a table's row sizes: a row that doesn't fit opens a bin, unless the bin is empty.
    """
    room = most - header_tokens - SPARE
    state = F.struct(F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("used"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, v: Column) -> Column:
        new = (a["used"] + v > room) & (a["used"] > 0)
        bin_ = F.when(new, a["bin"] + 1).otherwise(a["bin"])
        return F.struct(bin_.alias("bin"), F.when(new, v).otherwise(a["used"] + v).alias("used"), F.concat(a["out"], F.array(bin_)).alias("out"))

    bins = F.aggregate(F.col(sizes), state, step, lambda a: a["out"])
    return tables.withColumn("bins", bins if room >= LEAST_ROOM else F.lit(None).cast("array<bigint>"))


# -- one text at a time -------------------------------------------------------------------------


@dataclass
class Chunk:
    content: str
    content_type: str
    headings: list[str] = field(default_factory=list)


def _size(text: str) -> int:
    return len(text) // 4


def _in_force(lines: list[str], held: list[str] | None = None) -> list[str]:
    levels = dict(enumerate(held or [], 1))
    for line in lines:
        if m := re.match(r"(#{1,4}) ", line.strip()):
            n = len(m[1])
            levels = {k: v for k, v in levels.items() if k < n} | {n: line.strip()}
    return [levels.get(k, "") for k in range(1, 5)]


def _context(content: str, title: str, held: list[str]) -> str:
    """The title and headings that content lacks."""
    own = [x.strip() for x in content.split("\n") if x.strip().startswith("#")]
    levels = {len(x.split(" ")[0]) for x in own}
    parts = [] if not title or any(title in x for x in own) else [f"# {title}"]
    for n, x in enumerate(held, 1):
        if x and n not in levels and not (n == 1 and title and title in x):
            parts.append(x)
    return "\n".join(parts)


def _split(text: str, most: int, overlap: int, marks: tuple[str, ...] = ("\n\n", "\n", " ", "")) -> list[str]:
    """Cut by the coarsest mark that occurs, pieces too long by the next one, then pack pieces up to `most` tokens."""
    mark = next(m for m in marks if not m or m in text)
    finer = marks[marks.index(mark) + 1 :]
    pieces = text.split(mark) if mark else [text[k : k + 4 * most] for k in range(0, len(text), 4 * most)]
    out, held = [], []

    def close() -> None:
        if joined := mark.join(held).strip():
            out.append(joined)

    for piece in (p for p in pieces if p):
        if _size(piece) > most and finer:
            close()
            held = []
            out += _split(piece, most, overlap, finer)
            continue
        if held and _size(mark.join([*held, piece])) > most:
            close()
            while held and (_size(mark.join(held)) > overlap or _size(mark.join([*held, piece])) > most):
                held.pop(0)
        held.append(piece)
    close()
    return out


def _split_table(lines: list[str], title: str, most: int) -> list[str] | None:
    rows = [x for x in lines if _cells(x)]
    at = next((k for k, x in enumerate(rows) if re.fullmatch(r"\|\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|", x.strip())), None)
    if at is None:
        head, mark, data = rows[:1], "|" + "|".join("---" for _ in rows[0].split("|")[1:-1]) + "|" if rows else "", rows[1:]
    elif at == 0:
        head, mark, data = rows[1:2], rows[0], rows[2:]
    else:
        head, mark, data = rows[:at], rows[at], rows[at + 1 :]
    top = "\n".join([*head, mark])
    room = most - _size(top) - SPARE
    if not head or not data or room < LEAST_ROOM:
        return None
    bins, used = [[]], 0
    for row in data:
        if used + _size(row) + 1 > room and bins[-1]:
            bins.append([])
            used = 0
        bins[-1].append(row)
        used += _size(row) + 1
    return [f"# {title}\n{top}\n" + "\n".join(b) for b in bins]


def _cells(line: str) -> bool:
    line = line.strip()
    return len(line) > 1 and line[0] == line[-1] == "|"


def title_of(text: str) -> str | None:
    lines = [x.strip() for x in text.split("\n")]
    for k, x in enumerate(lines):
        if x.startswith("# "):
            return x[2:].strip()
        if x and k + 1 < len(lines) and lines[k + 1].startswith("=="):
            return x
    return next((x[3:].strip() for x in lines[:10] if x.startswith("## ")), None)


def chunk(text: str, title: str | None = None, most: int = 500, overlap: int = 50) -> list[Chunk]:
    """Chunks of one markdown text, with the headings in force."""
    title = title or title_of(text) or ""
    runs: list[tuple[bool, list[str], list[str]]] = []
    held = ["", "", "", ""]
    for line in text.split("\n"):
        opens = bool(re.match(HEADING, line.strip()))
        table = _cells(line)
        if not runs or opens or runs[-1][0] != table:
            runs.append((table, [], held))
        runs[-1][1].append(line)
        if opens:
            held = _in_force([line], held)
            runs[-1] = (runs[-1][0], runs[-1][1], held)
    out = []
    for table, lines, levels in runs:
        content = "\n".join(lines).strip()
        if not content or (not table and all(re.fullmatch(r"|#{1,4}([^#].*)?|[-=]{3,}", x.strip()) for x in lines)):
            continue
        kind = "table" if table else "text"
        if _size(content) <= most:
            lead = _context(content, title, levels)
            out.append(Chunk(f"{lead}\n\n{content}" if lead else content, kind, levels))
            continue
        parts = _split_table(lines, title, most) if table else None
        if parts is None:
            parts = [f"{lead}\n\n{p}" if (lead := _context(p, title, levels)) else p for p in _split(content, most, overlap)]
        out += [Chunk(p, kind, levels) for p in parts]
    return out
