"""Line dedup by distinct-site spread, in DataFrame expressions only.

A line is boilerplate when it stands on at least min_sites distinct sites. Per line hash a HyperLogLog sketch of
the sites merges by aggregation, with the number of rows beside it. Fewer rows than min_sites settle a line as
ordinary; an estimate over what min_sites filled registers give settles it as boilerplate, since a filled
register needs a site of its own. Lines between the two get exact distinct counts, so the verdict is exact.
Boilerplate goes from every document, however large a part of it that is. A document of boilerplate lines alone is
itself a copy that lies on many sites; spare_copies, off unless asked for, leaves such a document whole for a later
near-duplicate stage to judge.

Lines are compared without outer ASCII white space; lines of white space alone always stay, and what stays keeps
its own spelling. Defined results: a null text stays null and has no lines; a null site is no site; a null doc_id
is a document like any other; a repeated row is treated like its twin; columns beside doc_id, text and
source stay untouched (n_chars is refreshed if there); an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bundled, materialise, row_key, table

MIN_SITES = 8
#: Largest number of boilerplate lines (two hashes each, 16 bytes) that is broadcast; more are shuffled.
BROADCAST_LINES = 100_000


def _registers(relative_sd: float) -> int:
    return 1 << max(4, math.ceil(2 * math.log2(1.106 / relative_sd)))


def _lines(docs: DataFrame, text: str, site: str) -> DataFrame:
    """A row for each line with a character: key of the row, position, line hashes."""
    line = F.btrim(F.col("_line"), F.lit(SPACES))
    return (
        docs.select(
            F.col("doc_id").alias("_doc"), row_key("doc_id", text).alias("_row"), F.col(site).alias("_site"),
            F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_line"),
        )
        .filter(line != "")
        .select("_doc", "_row", "_site", "_pos", F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(7), line).alias("_h2"))
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, relative_sd: float = 0.1) -> DataFrame:
    """_h1, _h2 of the lines on at least min_sites sites, exactly."""
    m = _registers(relative_sd)
    sure = round(m * math.log(m / (m - min_sites))) if min_sites < m / 2 else m * 1000
    spread = (
        lines.groupBy("_h1", "_h2")
        .agg(F.count("_site").alias("_n"), F.approx_count_distinct("_site", relative_sd).alias("_est"))
        .filter(F.col("_n") >= min_sites)
    )
    spread = materialise(spread, "line-spread")
    near = spread.filter(F.col("_est") < sure).select("_h1", "_h2")
    exact = (
        lines.filter(F.col("_site").isNotNull())
        .join(_checked(near), ["_h1", "_h2"], "left_semi")
        .groupBy("_h1", "_h2", "_site")
        .agg(F.count(F.lit(1)).alias("_c"))
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_sites"))
        .filter(F.col("_sites") >= min_sites)
        .select("_h1", "_h2")
    )
    settled = spread.filter(F.col("_est") >= sure).select("_h1", "_h2").unionByName(exact)
    return materialise(settled, "line-boilerplate")


def _checked(small: DataFrame) -> DataFrame:
    """Broadcast where a count shows that it is small, else joined by shuffle, where adaptive execution splits a line that most rows have."""
    return F.broadcast(small) if small.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES else small


def removed_lines(docs: DataFrame, min_sites: int, text: str, site: str) -> DataFrame:
    """_row, _doc, _gone: positions of the boilerplate lines, for rows that have any."""
    lines = _lines(docs, text, site)
    found = _checked(boilerplate(lines, min_sites))
    hit = lines.drop("_site").join(found, ["_h1", "_h2"], "left_semi")
    return hit.groupBy("_row", "_doc").agg(F.array_distinct(F.collect_list("_pos")).alias("_gone"))


def _kept(text: Column) -> Column:
    """The text without the lines at the positions in _gone; positions are told apart by a hash set, so a long text costs no more a line."""
    stay = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("_gone"))
    return F.when(F.col("_goes"), F.array_join(F.transform(stay, lambda i: F.get(F.col("_all"), i)), "\n")).otherwise(text)


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, text: str = "text", site: str = "source", count: bool = False, spare_copies: bool = False) -> DataFrame:
    """docs with cross-site boilerplate lines gone from text; count adds _n_removed."""
    gone = removed_lines(docs, min_sites, text, site).withColumnsRenamed({"_row": "_gone_row", "_doc": "_gone_doc"})
    rows = docs.select(bundled(docs, docs.columns).alias("_in"), row_key("doc_id", text).alias("_key"), F.col("doc_id").alias("_doc"), F.col(text).alias("_text"))
    joined = rows.join(gone, (F.col("_key") == F.col("_gone_row")) & F.col("_doc").eqNullSafe(F.col("_gone_doc")), "left")
    joined = joined.withColumn("_all", F.when(F.col("_gone").isNotNull(), F.split("_text", "\n")))
    own = F.size(F.filter("_all", lambda x: F.btrim(x, F.lit(SPACES)) != "")) > F.size("_gone")
    joined = joined.withColumn("_goes", F.coalesce(own if spare_copies else F.col("_gone").isNotNull(), F.lit(False)))
    joined = joined.withColumn("_new", _kept(F.col("_text")))
    shown = {text: F.col("_new")}
    if "n_chars" in docs.columns:
        shown["n_chars"] = F.coalesce(F.length("_new"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    columns = [shown.get(c, F.col(f"_in.`{c}`")).alias(c) for c in docs.columns if not (count and c == "_n_removed")]
    if count:
        columns.append(F.when(F.col("_goes"), F.size("_gone")).otherwise(0).cast("long").alias("_n_removed"))
    return joined.select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = drop_boilerplate(docs, count=True)
    return out.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_kept_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


SQL = rf"""
WITH l AS (
  SELECT doc_id, source, text, i, string_split(text, chr(10))[i] AS line,
    trim(string_split(text, chr(10))[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT doc_id, source, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)
), b AS (
  SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}
), h AS (
  SELECT l.*, b.k IS NOT NULL AS found FROM l LEFT JOIN b USING (k)
), p AS (
  SELECT doc_id, coalesce(count(*) FILTER (NOT found), 0) AS kept, count(*) FILTER (found) AS n,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT found), '') AS t FROM h GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE greatest(kept, 1) END::BIGINT AS n_kept_lines,
  coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN p USING (doc_id)
"""
