"""Column expressions over text that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A link in markdown, its text as group 1.
LINK = r"\[([^\]]+)\]\([^)]+\)"
#: Edges of a word, for letters of any script.
BEFORE, AFTER = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def filled_lines(text: Column) -> Column:
    """Stripped lines that aren't empty."""
    return F.filter(F.transform(lines(text), strip), lambda x: x != "")


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def share(text: Column, pattern: str) -> Column:
    """Matches of a one-character pattern per character; 0 for an empty text."""
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(count(text, pattern) / F.length(text))


def occurrences(text: Column, piece: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / F.lit(len(piece))).cast("int")


def shortened(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def char_set(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))


def initials(text: Column) -> Column:
    return F.array_join(F.transform(words(F.lower(text)), lambda w: F.substring(w, 1, 1)), "")


def capitalized(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, F.lit(2), F.length(text))))


def slug(text: Column) -> Column:
    """Lower case, letters, digits, underscores and full stops only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_.]", "")


def file_type(path: Column) -> Column:
    """pdf or html; null for what no converter takes."""
    low = F.lower(path)
    remote = low.rlike("^https?://")
    return F.when(F.endswith(low, F.lit(".pdf")), "pdf").when(remote | low.rlike(r"\.html?$"), "html")


def image_url(src: Column, base: Column) -> Column:
    """src as an absolute address; null if it is relative and base isn't absolute. Dot segments stay as they are."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]+)?(/?)[^/]*$", "$1$2")
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return F.when(src.rlike("^https?://"), src).when(root == "", None).when(F.startswith(src, F.lit("/")), F.concat(root, src)).otherwise(F.concat(folder, src))


def image_file_name(url: Column, number: Column) -> Column:
    name = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    suffixed = name.rlike(r"[^.]\.[^.]+$")
    known = F.lower(url).rlike(r"\.(jpg|jpeg|png|gif|webp)")
    name = F.when(suffixed, name).when(F.contains(F.lower(url), F.lit("svg")), F.concat(name, F.lit(".svg"))).when(known, name).otherwise(F.concat(name, F.lit(".jpg")))
    return F.concat(F.format_string("image_%03d_", number), F.regexp_replace(name, r'[<>:"/\\|?*]', "_"))
