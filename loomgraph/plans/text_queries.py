"""Queries over documents and pages: quality, selection, markdown lines, chunks, pages, prompts and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chunking, extraction, html, markdown, quality
from ..operators.quality import CHINESE, ENGLISH, INDICATORS, MARKETING, MENU_LINE, PRODUCT_SIGNS
from .tables import ANSWERS_SQL, LINES_SQL, answers, marked_lines, table

LEAST = 75
#: Frequent words of the test corpus, as a keyword list that some of its documents have several of.
CORPUS_WORDS = ["erthes", "thethe", "ererth", "schung", "tionle", "ciónes", "and", "der", "les", "que"]


def _docs(spark, d) -> DataFrame:
    return table(spark, d, "documents")


def _list(items) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _without(x: str, pattern: str) -> str:
    return f"(length({x}) - length(regexp_replace({x}, '{pattern}', '', 'g')))"


def _any(x: str, patterns, flags: str = "") -> str:
    return " + ".join(f"regexp_matches({x}, '{flags}{p}')::INT" for p in patterns)


_LOW = [k.lower() for k in ENGLISH]
_TWICE = [k for n, k in enumerate(_LOW) if k in _LOW[:n]]
_QUALITY = rf"""base AS (
  SELECT *, {_strip("text")} AS bare, lower(text) AS low,
    list_filter(list_transform(string_split(text, chr(10)), lambda x: {_strip("x")}), lambda x: x <> '') AS filled,
    regexp_replace(regexp_replace(text, '{tx.LINK}', '\1', 'g'), '[+*-]\s*', '', 'g') AS pure,
    len(regexp_extract_all(text, '{tx.LINK}')) AS links FROM documents
), parts AS (
  SELECT doc_id, source, text, bare,
    regexp_matches(text, '[a-zA-Z0-9+/=]{{50,}}') OR (length(text) > 100 AND 20 * {_without("text", " ")} < length(text)
      AND 50 * {_without("text", '[.,;:!?()' + chr(92) + '[' + chr(92) + ']{}"]')} < length(text)) AS garbled,
    len(filled) <= 2 AND (regexp_matches(bare, '(?m)^#+\s+') OR regexp_matches(bare, '(?m)^.*\n[-=]+$') OR regexp_matches(bare, '(?m)^\s*[A-Z][^.!?]*$')
      OR (length(bare) < 100 AND NOT contains(bare, '.'))) AS title_only,
    (CASE WHEN length(text) = 0 THEN -30 WHEN {_without("text", "[" + chr(92) + "x{4e00}-" + chr(92) + "x{9fff}]")} < 0.1 * length(text) AND {_without("text", "[a-zA-Z]")} < 0.3 * length(text) THEN -25
      WHEN {_without("text", "[0-9|" + chr(92) + "-+." + chr(92) + "s]")} > 0.6 * length(text) THEN -15 ELSE 0 END)::BIGINT AS lang_pts,
    len(list_intersect(list_distinct(regexp_extract_all(low, '[\p{{L}}\p{{N}}_]+')), {_list(sorted(set(_LOW)))}))
      + len(list_intersect(list_distinct(regexp_extract_all(low, '[\p{{L}}\p{{N}}_]+')), {_list(_TWICE)}))
      + {" + ".join(f"contains(low, '{k.lower()}')::INT" for k in CHINESE)} AS keywords,
    {_without("pure", "[" + chr(92) + "p{L}" + chr(92) + "p{N}" + chr(92) + "s]")} AS substance,
    least(10, 2 * ({_any("text", [tx.BEFORE + p + tx.AFTER for p in INDICATORS.values()])}))::BIGINT AS bonus,
    len(filled) > 0 AND (links > 0.6 * len(filled) OR len(list_filter(filled, lambda x: regexp_matches(x, '{MENU_LINE}'))) > 8
      OR ({" + ".join(f"len(list_filter(filled, lambda x: regexp_matches(x, '(?i){p}')))" for p in PRODUCT_SIGNS)} >= 2 AND links > 5)) AS navigation,
    {_any("text", MARKETING, "(?i)")} >= 2 AS marketing FROM base
), points AS (
  SELECT *, (CASE WHEN keywords < 2 THEN -15 WHEN keywords < 4 THEN -5 ELSE 5 END)::BIGINT AS kw_pts,
    (CASE WHEN substance < 100 THEN -20 WHEN substance < 200 THEN -10 ELSE 5 END)::BIGINT AS substance_pts FROM parts
), scored AS (
  SELECT *, (CASE WHEN length(bare) < 50 THEN 60 WHEN garbled THEN 20
    ELSE greatest(0, least(100, 100 - CASE WHEN title_only THEN 40 ELSE 0 END + lang_pts + kw_pts + substance_pts + bonus)) END)::BIGINT AS score FROM points
), judged AS (
  SELECT *, CASE WHEN navigation THEN 'navigation' WHEN marketing THEN 'marketing' WHEN score < {LEAST} THEN 'low_quality' ELSE 'kept' END AS reject_type FROM scored
)"""


def chunk_quality_topk(spark, d):
    scored = _docs(spark, d).select("source", "doc_id", quality.score(F.col("text")).cast("long").alias("score"))
    rk = F.row_number().over(Window.partitionBy("source").orderBy(F.col("score").desc(), "doc_id")).cast("long")
    return scored.withColumn("rk", rk).filter("rk <= 5").select("source", "rk", "doc_id", "score")


def quality_components(spark, d):
    t = F.col("text")
    long = lambda c: c.cast("long")
    return _docs(spark, d).select(
        "doc_id", quality.is_garbled(t).alias("garbled"), quality.is_title_only(t).alias("title_only"), long(quality.language_points(t)).alias("lang_pts"),
        long(quality.keyword_points(t)).alias("kw_pts"), long(quality.substance_points(t)).alias("substance_pts"), long(quality.technical_bonus(t)).alias("bonus"),
    )


def quality_reject_counts(spark, d):
    kind = F.coalesce(quality.reject_type(F.col("text"), LEAST), F.lit("kept"))
    return _docs(spark, d).groupBy(kind.alias("reject_type")).agg(F.count(F.lit(1)).alias("n"))


def quality_vs_labels(spark, d):
    scored = _docs(spark, d).select("doc_id", quality.score(F.col("text")).alias("s"))
    out = scored.join(table(spark, d, "labels"), "doc_id").groupBy(F.col("quality").cast("long").alias("quality"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("s"), 6).alias("avg_score"))


def quality_keywords_of_list(spark, d):
    n = quality.keyword_count(F.col("text"), CORPUS_WORDS, [])
    return _docs(spark, d).groupBy(n.cast("long").alias("keywords")).agg(F.count(F.lit(1)).alias("n"))


def length_distribution(spark, d):
    t = _docs(spark, d)
    return t.groupBy(quality.length_bucket(F.col("text")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.length("text")), 6).alias("avg_length"), F.min(F.length("text")).cast("long").alias("min_length"), F.max(F.length("text")).cast("long").alias("max_length")
    )


def content_class(spark, d):
    return _docs(spark, d).groupBy(quality.content_class(F.col("text")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def selection_first(spark, d):
    return quality.select_chunks(_docs(spark, d).select("doc_id", "text"), "first", 25, "doc_id", "text").select("doc_id", "rk")


def selection_quality(spark, d):
    return quality.select_chunks(_docs(spark, d).select("doc_id", "text"), "quality", 25, "doc_id", "text").select("doc_id", "rk")


def selection_random(spark, d):
    return quality.select_chunks(_docs(spark, d).select("doc_id", "text"), "random", 25, "doc_id", "text", seed=7).select("doc_id", "rk")


def selection_info(spark, d):
    return quality.selection_info(_docs(spark, d), "quality", 40, LEAST, "doc_id", "text")


def token_length(spark, d):
    return _docs(spark, d).select("doc_id", chunking.tokens(F.col("text")).alias("tokens"))


# -- lines --------------------------------------------------------------------------------------


def _on_lines(rule):
    return lambda spark, d: rule(marked_lines(spark, d)).select("doc_id", "pos", "line")


def section_headers(spark, d):
    out = chunking.headings(marked_lines(spark, d))
    return out.groupBy("doc_id", "section_no").agg(*[F.max_by(f"h{k}", "pos").alias(f"h{k}") for k in range(1, 5)])


def main_titles(spark, d):
    return chunking.main_title(marked_lines(spark, d))


def line_segments(spark, d):
    return chunking.segments(marked_lines(spark, d)).select("doc_id", "seg_no", "content_type", "n_lines", F.md5("content").alias("content_md5"))


def chunk_numbering(spark, d):
    return chunking.numbered(chunking.segments(marked_lines(spark, d)), "seg_no").select("doc_id", "chunk_id", "total_chunks")


ROOM = 120


def table_row_packing(spark, d):
    size = F.floor(F.length(F.concat(F.lit("| "), F.col("l_partkey").cast("string"), F.lit(" | "), F.repeat(F.col("l_returnflag"), F.col("l_quantity").cast("int")), F.lit(" |"))) / 4) + 1
    rows = table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", size.cast("long").alias("n")).alias("r"))
    tables = rows.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list("r")), lambda x: x["n"]).alias("sizes"))
    packed = chunking.pack_rows(tables, ROOM, 20)
    each = packed.select(F.col("l_orderkey").alias("orderkey"), F.inline(F.arrays_zip("bins", "sizes")))
    return each.groupBy("orderkey", F.col("bins").alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sizes").alias("tokens"))


_BARE = _strip("line")
_BLANK = f"({_BARE} = '')"
_W = "(PARTITION BY doc_id ORDER BY pos)"
_ROW = rf"regexp_matches({_BARE}, '(?s)^\|.*\|$')"
_SEP = rf"(regexp_matches({_BARE}, '^\|[-:|\s]*\|$') OR {_BARE} = '|')"
_WORDS = " OR ".join(f"contains(body, '{w}')" for w in markdown.SECTION_WORDS)
_LINE_SQL = {
    "lone_characters": rf"""SELECT doc_id, pos, line FROM (SELECT *, {_BARE} AS b, coalesce({_strip(f"lag(line) OVER {_W}")} = '', true) AS pb, coalesce({_strip(f"lead(line) OVER {_W}")} = '', true) AS nb FROM lines)
      WHERE b <> '<!-- image -->' AND NOT (regexp_matches(b, '^[\p{{L}}\p{{N}}]$') AND pb AND nb)""",
    "caption_filter": f"SELECT doc_id, pos, line FROM lines WHERE NOT ({' OR '.join(f'regexp_matches({_BARE}, {chr(39)}{p}{chr(39)})' for p in markdown.CAPTIONS)})",
    "heading_demote": rf"""SELECT doc_id, pos, CASE WHEN b LIKE '## %' AND NOT ((regexp_matches(body, '[一二三四五六七八九十0-9]') OR length(body) < 20 OR {_WORDS}) AND body NOT LIKE '%。') THEN body
      WHEN regexp_matches(b, '{markdown.NUMBERED_TITLE}') AND b NOT LIKE '#%' THEN '## ' || b ELSE line END AS line
      FROM (SELECT *, {_strip("substring(b, 4)")} AS body FROM (SELECT *, {_BARE} AS b FROM lines))""",
    "fence_removal": f"""SELECT doc_id, pos, line FROM (SELECT *, sum(f) OVER {_W} AS n, sum(f) OVER (PARTITION BY doc_id) AS a FROM (SELECT *, ({_BARE} = '```')::INT AS f FROM lines))
      WHERE f = 0 AND NOT (n % 2 = 1 AND n < a)""",
    "blank_collapse": f"""SELECT doc_id, pos, line FROM (SELECT *, sum(b) OVER (PARTITION BY doc_id, run ORDER BY pos) AS nth FROM (SELECT *, {_BLANK}::INT AS b, sum((NOT {_BLANK})::INT) OVER {_W} AS run FROM lines))
      WHERE b = 0 OR nth <= 2""",
    "last_section": f"SELECT doc_id, pos, line FROM lines l WHERE NOT EXISTS (SELECT 1 FROM lines m WHERE m.doc_id = l.doc_id AND m.pos <= l.pos AND {_strip('m.line')} IN ('## 附录4  参考链接', '## 附录4 参考链接'))",
    "table_separator_clean": rf"""SELECT doc_id, pos * 2 + k AS pos, CASE WHEN k = 1 THEN '|' || repeat('------|', (length(line) - length(replace(line, '|', '')) - 1)::INT) ELSE line END AS line FROM (
      SELECT *, unnest(CASE WHEN row AND nth = 1 AND has = 0 THEN [0, 1] ELSE [0] END) AS k FROM (
        SELECT *, max(sep::INT) OVER (PARTITION BY doc_id, run) AS has, sum(row::INT) OVER (PARTITION BY doc_id, run ORDER BY pos) AS nth FROM (
          SELECT * FROM (SELECT *, sum((sep AND seen > 1)::INT) OVER (PARTITION BY doc_id, run ORDER BY pos) AS ns FROM (
            SELECT *, row AND {_SEP} AS sep FROM (SELECT *, sum(row::INT) OVER (PARTITION BY doc_id, run ORDER BY pos) AS seen FROM (
              SELECT *, {_ROW} AS row, {_BLANK} AS blank, sum((NOT {_ROW} AND NOT {_BLANK})::INT) OVER {_W} AS run FROM lines)) WHERE NOT (blank AND seen > 0)))
          WHERE NOT sep OR (seen > 1 AND ns = 1))))""",
}
_LINE_RULES = {
    "lone_characters": markdown.drop_marks,
    "caption_filter": markdown.drop_captions,
    "heading_demote": markdown.fix_headings,
    "fence_removal": markdown.drop_fences,
    "blank_collapse": markdown.collapse_blanks,
    "last_section": markdown.drop_after_last_section,
    "table_separator_clean": markdown.clean_tables,
    "setext_headings": markdown.setext_to_atx,
    "markdown_cleaned": markdown.clean_lines,
}
_SETEXT = f"""u AS (
  SELECT *, CASE WHEN regexp_matches({_BARE}, '^=+$') THEN 1 WHEN regexp_matches({_BARE}, '^-{{3,}}$') THEN 2 ELSE 0 END AS kind, row_number() OVER {_W} AS n,
    lead(line) OVER {_W} AS nl FROM lines
), walk AS (
  SELECT doc_id, n, kind, pos, line, false AS used FROM u WHERE n = 1
  UNION ALL SELECT u.doc_id, u.n, u.kind, u.pos, u.line, u.kind > 0 AND NOT w.used FROM walk w JOIN u ON u.doc_id = w.doc_id AND u.n = w.n + 1
), told AS (SELECT *, lead(used) OVER {_W} AS nu, lead(kind) OVER {_W} AS nk, {_BARE} AS b FROM walk)"""
_HEADS = rf"""h AS (
  SELECT *, CASE WHEN regexp_matches({_BARE}, '{chunking.HEADING}') THEN length(regexp_extract({_BARE}, '^(#+)', 1)) ELSE 0 END AS lv, {_BARE} AS b FROM lines
), s AS (SELECT *, sum((lv > 0)::INT) OVER {_W} AS section_no FROM h)"""


def _in_force(k: int) -> str:
    at, above = f"max(CASE WHEN lv = {k} THEN pos END) OVER {_W}", f"max(CASE WHEN lv > 0 AND lv < {k} THEN pos END) OVER {_W}"
    return f"CASE WHEN {above} IS NULL OR {at} > {above} THEN last_value(CASE WHEN lv = {k} THEN b END IGNORE NULLS) OVER {_W} END AS h{k}"


_SEGMENTS = rf"""g AS (
  SELECT *, sum(new) OVER {_W} AS run FROM (SELECT *, coalesce(t <> lag(t) OVER {_W}, true)::INT AS new FROM (SELECT *, {_ROW} AS t FROM lines))
), seg AS (
  SELECT doc_id, run, bool_or(t) AS t, count(*) AS n_lines, {_strip("string_agg(line, chr(10) ORDER BY pos)")} AS content FROM g GROUP BY doc_id, run
), kept AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS seg_no FROM seg
  WHERE t OR (content <> '' AND len(list_filter(string_split(content, chr(10)), lambda x: NOT regexp_matches({_strip("x")}, '^$|^#{{1,4}}([^#]|$)|^[-=]{{3,}}$'))) > 0)
)"""


# -- pages --------------------------------------------------------------------------------------


def url_file_type(spark, d):
    return table(spark, d, "pages").select("page_id", tx.file_type(F.col("url")).alias("file_type"))


def page_titles(spark, d):
    """Titles by pattern, from the first h1 or else the title."""
    inner = lambda tag: tx.strip(F.replace(F.regexp_replace(F.regexp_extract("html", rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1), "<[^>]*>", ""), F.lit("&amp;"), F.lit("&")))
    good = lambda c: F.when(F.length(c) > 5, html.clean_title(c))
    return table(spark, d, "pages").select("page_id", F.coalesce(good(inner("h1")), good(inner("title"))).alias("title"))


def pages_to_markdown(spark, d):
    out = table(spark, d, "pages").select("page_id", html.markdown_of(F.col("html")).alias("p"))
    return out.select("page_id", F.col("p.title").alias("title"), F.size(F.split("p.markdown", "\n")).cast("long").alias("n_lines"), F.size("p.images").cast("long").alias("n_images"), F.col("p.markdown").alias("markdown"))


def page_chunks(spark, d):
    return html.page_chunks(table(spark, d, "pages")).select("page_id", "chunk_id", "total_chunks", "content_type", "tokens", F.md5("content").alias("content_md5"))


def flagship_pages_to_chunks(spark, d):
    """Pages to markdown to chunks, each with its score and why it would be dropped."""
    out = html.page_chunks(table(spark, d, "pages"))
    out = out.withColumn("_q", quality.judged(F.col("content"), F.col("content_type")))
    return out.select("page_id", "chunk_id", "content_type", "tokens", F.col("_q.score").cast("long").alias("score"), F.coalesce("_q.reject_type", F.lit("kept")).alias("verdict"))


_NAME = "'/wp/' || CAST(page_id AS STRING) || CASE page_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '' WHEN 2 THEN '-svg' ELSE '.jpg' END"


def image_files(spark, d):
    src = F.expr(_NAME)
    out = table(spark, d, "pages").select("page_id", tx.image_url(src, F.col("url")).alias("url"))
    return out.select("page_id", "url", tx.image_file_name(F.col("url"), F.col("page_id")).alias("file_name"))


# -- prompts and answers ------------------------------------------------------------------------


def prompt_features(spark, d):
    told = extraction.prompt_features(F.col("text"))
    return _docs(spark, d).select("doc_id", *[told[k].alias(k) for k in ("lang_guidance", "length_guidance", "technique_guidance", "few_shot")])


def ioc_entities(spark, d):
    return extraction.iocs(_docs(spark, d), ["doc_id"], "text")


def ioc_cooccurrence(spark, d):
    rules = extraction.RuleExtractor()
    found = rules.relationships(rules.entities(_docs(spark, d), ["doc_id"], "text"), ["doc_id"])
    return found.groupBy("source", "target").agg(F.count(F.lit(1)).alias("cnt"))


def failure_classes(spark, d):
    answer = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, '{"entities": [] and so on').otherwise('"entities" "relationships" {')
    return _docs(spark, d).groupBy(extraction.failure_class(F.col("text"), answer).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_PROPS = "CASE event_id % 7 WHEN 0 THEN left(props, length(props) - 1) WHEN 1 THEN props || ' x' WHEN 2 THEN 'Answer: ' || props ELSE props END"


def json_parse_rate(spark, d):
    rows = table(spark, d, "events").select("event_type", extraction.is_json_object(F.expr(_PROPS)).alias("ok"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok"), F.round(F.count_if("ok") / F.count(F.lit(1)), 6).alias("rate"))


def json_expected_key(spark, d):
    """Answers cut off or whole, as objects that have the expected key: mended by a call that adds it, by rules, or {}."""
    mend = lambda t: '{"k": 0, "mended": true}' if t.startswith("{") and len(t) % 2 else None
    raw = table(spark, d, "events").select("event_id", F.expr("CASE event_id % 4 WHEN 0 THEN '{\"k\": ' || event_id || '}' WHEN 1 THEN '{\"k\": ' || event_id WHEN 2 THEN '{\"other\": 1}' ELSE 'none' END").alias("t"))
    return raw.select("event_id", F.get_json_object(extraction.parsed(F.col("t"), "k", mend), "$.k").alias("k"))


def json_repaired(spark, d):
    rows = table(spark, d, "events").select("event_id", extraction.repaired(F.expr(_PROPS)).alias("j"))
    return rows.select("event_id", F.get_json_object("j", "$.k").alias("k"))


def valid_entities(spark, d):
    good = answers(spark, d).filter(extraction.is_json_object(F.col("response")))
    return extraction.entities_of(good).select("k", "id", "type", "name", "description")


def valid_relationships(spark, d):
    good = answers(spark, d).filter(extraction.is_json_object(F.col("response")))
    return extraction.relationships_of(good).select("k", "source", "target", "type", "confidence")


def merge_group_validation(spark, d):
    text = F.concat(F.lit("[["), F.col("p_partkey").cast("string"), F.lit(",1],[2],["), (F.col("p_partkey") % 5 - 1).cast("string"), F.lit(",7]]"))
    rows = table(spark, d, "part").select("p_partkey", extraction.merge_groups(text).alias("g"))
    return rows.select(F.col("p_partkey").alias("k"), F.size("g").cast("long").alias("n_groups"), F.coalesce(F.aggregate(F.flatten("g"), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).alias("positions"))


_CALLS = """SELECT CASE WHEN k % 9 = 0 THEN 'failed' ELSE 'success' END AS status, k % 4 AS attempts, CAST(length(response) AS BIGINT) AS input_tokens, k % 100 AS output_tokens,
  CAST(k % 17 AS DOUBLE) / 4 AS duration FROM answers"""


def call_stats(spark, d):
    answers(spark, d).createOrReplaceTempView("answers")
    return extraction.call_stats(spark.sql(_CALLS))


_ZH, _EN = _without("text", r"[\x{4e00}-\x{9fff}]"), _without("text", "[a-zA-Z]")
_IOC = " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS kind, unnest(regexp_extract_all(regexp_replace(text, '([^\\p{{L}}\\p{{N}}_.@-])', '\\1\\1', 'g'), '{tx.BEFORE}({p})(?:$|[^\\p{{L}}\\p{{N}}_])', 1)) AS value FROM documents"
    for k, p in extraction.IOC.items()
)

QUERIES = {
    "chunk_quality_topk": chunk_quality_topk, "quality_components": quality_components, "quality_reject_counts": quality_reject_counts, "quality_vs_labels": quality_vs_labels,
    "quality_keywords_of_list": quality_keywords_of_list, "length_distribution": length_distribution, "content_class": content_class, "selection_first": selection_first,
    "selection_quality": selection_quality, "selection_random": selection_random, "selection_info": selection_info, "token_length": token_length,
    **{name: _on_lines(rule) for name, rule in _LINE_RULES.items()},
    "section_headers": section_headers, "main_titles": main_titles, "line_segments": line_segments, "chunk_numbering": chunk_numbering, "table_row_packing": table_row_packing,
    "url_file_type": url_file_type, "page_titles": page_titles, "pages_to_markdown": pages_to_markdown, "page_chunks": page_chunks, "flagship_pages_to_chunks": flagship_pages_to_chunks,
    "image_files": image_files, "prompt_features": prompt_features, "ioc_entities": ioc_entities, "ioc_cooccurrence": ioc_cooccurrence, "failure_classes": failure_classes,
    "json_parse_rate": json_parse_rate, "json_repaired": json_repaired, "json_expected_key": json_expected_key, "valid_entities": valid_entities, "valid_relationships": valid_relationships,
    "merge_group_validation": merge_group_validation, "call_stats": call_stats,
}

_RANKED = "SELECT doc_id, row_number() OVER (ORDER BY {by}) AS rk FROM {rows} ORDER BY {by} LIMIT 25"
SQL = {
    "chunk_quality_topk": f"WITH {_QUALITY} SELECT source, rk, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rk FROM scored) WHERE rk <= 5",
    "quality_components": f"WITH {_QUALITY} SELECT doc_id, garbled, title_only, lang_pts, kw_pts, substance_pts, bonus FROM scored",
    "quality_reject_counts": f"WITH {_QUALITY} SELECT reject_type, count(*) AS n FROM judged GROUP BY 1",
    "quality_vs_labels": f"WITH {_QUALITY} SELECT quality::BIGINT AS quality, count(*) AS n, round(avg(score), 6) AS avg_score FROM scored JOIN labels USING (doc_id) GROUP BY 1",
    "quality_keywords_of_list": f"SELECT len(list_intersect(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')), {_list(CORPUS_WORDS)}))::BIGINT AS keywords, count(*) AS n FROM documents GROUP BY 1",
    "length_distribution": """SELECT CASE WHEN length(text) <= 500 THEN '0-500' WHEN length(text) <= 1000 THEN '500-1000' WHEN length(text) <= 2000 THEN '1000-2000' ELSE '2000+' END AS bucket,
      count(*) AS n, round(avg(length(text)), 6) AS avg_length, min(length(text))::BIGINT AS min_length, max(length(text))::BIGINT AS max_length FROM documents GROUP BY 1""",
    "content_class": """SELECT CASE WHEN contains(lower(text), 'def ') OR contains(lower(text), 'class ') OR contains(lower(text), 'import ') OR contains(text, '{') OR contains(text, '}') OR contains(text, ';') THEN 'code_like'
      WHEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) > 50 THEN 'text_heavy' ELSE 'mixed' END AS class, count(*) AS n FROM documents GROUP BY 1""",
    "selection_random": _RANKED.format(by="md5('7:' || doc_id)", rows="documents"),
    "selection_first": _RANKED.format(by="doc_id", rows="documents"),
    "selection_quality": f"WITH {_QUALITY} " + _RANKED.format(by="score DESC, doc_id", rows="scored"),
    "selection_info": f"""WITH {_QUALITY}, top AS (SELECT score FROM judged WHERE reject_type = 'kept' ORDER BY score DESC, doc_id LIMIT 40)
      SELECT 'quality' AS strategy, (SELECT count(*) FROM judged) AS original, (SELECT count(*) FROM judged WHERE reject_type = 'kept') AS filtered, count(*) AS selected,
        round(avg(score), 1) AS avg_score, min(score) AS min_score, max(score) AS max_score, round(count(*) / (SELECT count(*) FROM judged), 6) AS selection_ratio FROM top""",
    "token_length": "SELECT doc_id, (length(text) // 4)::BIGINT AS tokens FROM documents",
    **{name: f"WITH {LINES_SQL} {body}" for name, body in _LINE_SQL.items()},
    "setext_headings": f"""WITH RECURSIVE {LINES_SQL}, {_SETEXT} SELECT doc_id, pos, CASE WHEN nu AND nk = 1 THEN '# ' || b WHEN nu AND nk = 2 THEN '## ' || b ELSE line END AS line FROM told
      WHERE NOT used AND NOT (coalesce(nu, false) AND b = '')""",
    "section_headers": f"""WITH {LINES_SQL}, {_HEADS}, f AS (SELECT doc_id, section_no, pos, {", ".join(map(_in_force, range(1, 5)))} FROM s)
      SELECT doc_id, section_no::BIGINT AS section_no, h1, h2, h3, h4 FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY pos DESC) AS rn FROM f) WHERE rn = 1""",
    "main_titles": f"""WITH {LINES_SQL}, t AS (SELECT doc_id, pos, CASE WHEN {_BARE} LIKE '# %' THEN {_strip("substring(" + _BARE + ", 3)")} WHEN {_BARE} <> '' AND {_strip(f"lead(line) OVER {_W}")} LIKE '==%' THEN {_BARE} END AS a,
      CASE WHEN pos < 10 AND {_BARE} LIKE '## %' THEN {_strip("substring(" + _BARE + ", 4)")} END AS b FROM lines)
      SELECT doc_id, coalesce(arg_min(a, pos) FILTER (a IS NOT NULL), arg_min(b, pos) FILTER (b IS NOT NULL)) AS title FROM t GROUP BY doc_id""",
    "line_segments": f"WITH {LINES_SQL}, {_SEGMENTS} SELECT doc_id, seg_no, CASE WHEN t THEN 'table' ELSE 'text' END AS content_type, n_lines, md5(content) AS content_md5 FROM kept",
    "chunk_numbering": f"WITH {LINES_SQL}, {_SEGMENTS} SELECT doc_id, seg_no AS chunk_id, count(*) OVER (PARTITION BY doc_id) AS total_chunks FROM kept",
    "table_row_packing": f"""WITH RECURSIVE r AS (
        SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, n) AS i, n FROM (SELECT l_orderkey, l_linenumber,
          (length('| ' || l_partkey::VARCHAR || ' | ' || repeat(l_returnflag, l_quantity::INT) || ' |') // 4 + 1)::BIGINT AS n FROM lineitem)
      ), p AS (
        SELECT o, i, n, 0::BIGINT AS bin, n AS used FROM r WHERE i = 1
        UNION ALL SELECT r.o, r.i, r.n, CASE WHEN p.used + r.n > {ROOM - 40} THEN p.bin + 1 ELSE p.bin END, CASE WHEN p.used + r.n > {ROOM - 40} THEN r.n ELSE p.used + r.n END FROM p JOIN r ON r.o = p.o AND r.i = p.i + 1
      ) SELECT o AS orderkey, bin, count(*) AS n_rows, sum(n)::BIGINT AS tokens FROM p GROUP BY 1, 2""",
    "url_file_type": "SELECT page_id, CASE WHEN lower(url) LIKE '%.pdf' THEN 'pdf' WHEN regexp_matches(lower(url), '^https?://|\\.html?$') THEN 'html' END AS file_type FROM pages",
    "page_titles": rf"""WITH t AS (SELECT page_id, unnest([1, 2]) AS n, unnest([regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)]) AS x FROM pages
      ), u AS (SELECT page_id, n, {_strip("replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&amp;', '&')")} AS x FROM t
      ), v AS (SELECT page_id, n, x, regexp_replace(regexp_replace(regexp_replace(x, '{html.SITE_SUFFIX}', ''), '\s+', ' ', 'g'), '^ | $', '', 'g') AS y FROM u
      ) SELECT page_id, arg_min(y, n) FILTER (length(x) > 5 AND length(y) BETWEEN 5 AND 200 AND NOT ({" OR ".join(f"regexp_matches(y, '(?i){p}')" for p in html.NO_TITLES)})) AS title FROM v GROUP BY page_id""",
    "image_files": f"""WITH s AS (SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) || {_NAME.replace("STRING", "VARCHAR")} AS url FROM pages)
      SELECT page_id, url, 'image_' || printf('%03d', page_id) || '_' || page_id || CASE page_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '-svg.svg' ELSE '.jpg' END AS file_name FROM s""",
    "prompt_features": rf"""SELECT doc_id, CASE WHEN {_ZH} > 0.6 * length(text) THEN 'zh' WHEN {_EN} > 0.6 * length(text) THEN 'en' ELSE 'mixed' END AS lang_guidance,
      CASE WHEN length(text) > 3000 THEN 'long' WHEN length(text) < 500 THEN 'short' ELSE 'none' END AS length_guidance,
      regexp_matches(text, '(?s)###\s+[^#\n]+?\s*\n.*?\*\*[^–]+?–\s*T\.?\d+') AS technique_guidance, CASE WHEN {_ZH} > 0.5 * length(text) THEN 'chinese' ELSE 'english' END AS few_shot FROM documents""",
    "failure_classes": f"""SELECT CASE WHEN length({_strip("text")}) < 100 THEN 'too_short' WHEN {" + ".join(f"contains(lower(text), '{k.lower()}')::INT" for k in (*CHINESE, *ENGLISH))} < 2 THEN 'no_keywords'
      WHEN {" + ".join(f"contains(lower(text), '{k}')::INT" for k in extraction.MENU_WORDS)} >= 2 THEN 'navigation' WHEN doc_id % 3 = 0 THEN 'no_response' WHEN doc_id % 3 = 1 THEN 'bad_format' ELSE 'not_parsed' END AS reason,
      count(*) AS n FROM documents GROUP BY 1""",
    "json_parse_rate": f"""SELECT event_type, count(*) AS n, count(*) FILTER (ok) AS ok, round(count(*) FILTER (ok) / count(*), 6) AS rate FROM (
      SELECT event_type, json_valid(p) AND regexp_matches(p, '^\\{{.*\\}}$') AS ok FROM (SELECT event_type, {_PROPS} AS p FROM events)) GROUP BY 1""",
    "json_expected_key": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN CASE WHEN length('{"k": ' || event_id) % 2 = 1 THEN '0' ELSE event_id::VARCHAR END
      WHEN 2 THEN CASE WHEN length('{"other": 1}') % 2 = 1 THEN '0' END END AS k FROM events""",
    "json_repaired": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "valid_entities": f"""WITH {ANSWERS_SQL.replace("STRING", "VARCHAR")}, e AS (SELECT k, json_extract(response, '$.entities[0]') AS e FROM answers WHERE k % 7 <> 0)
      SELECT k, coalesce(json_extract_string(e, '$.id'), json_extract_string(e, '$.properties.id')) AS id, json_extract_string(e, '$.labels') AS type,
        coalesce(json_extract_string(e, '$.name'), json_extract_string(e, '$.properties.name')) AS name, coalesce(json_extract_string(e, '$.description'), '') AS description FROM e WHERE k % 5 <> 0""",
    "valid_relationships": f"""WITH {ANSWERS_SQL.replace("STRING", "VARCHAR")}, r AS (SELECT k, json_extract(response, '$.relationships[0]') AS r FROM answers WHERE k % 7 <> 0)
      SELECT k, json_extract_string(r, '$.source') AS source, json_extract_string(r, '$.target') AS target, json_extract_string(r, '$.type') AS type,
        CASE k % 6 WHEN 0 THEN 0.88 WHEN 3 THEN 1.0 WHEN 4 THEN 0.12 ELSE 0.7 END::DOUBLE AS confidence FROM r WHERE json_extract_string(r, '$.type') IS NOT NULL""",
    "merge_group_validation": """SELECT p_partkey AS k, (1 + (p_partkey % 5 <> 0)::INT)::BIGINT AS n_groups,
      (p_partkey + 1 + CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 5 - 1 + 7 ELSE 0 END)::BIGINT AS positions FROM part""",
    "call_stats": f"""WITH {ANSWERS_SQL.replace("STRING", "VARCHAR")}, c AS ({_CALLS})
      SELECT count(*) AS total, count(*) FILTER (status = 'success') AS ok, count(*) FILTER (status = 'failed') AS failed, round(100.0 * count(*) FILTER (status = 'success') / count(*), 6)::DOUBLE AS success_rate,
        round(avg(greatest(attempts - 1, 0)), 6) AS avg_retries, round(avg(duration), 6) AS avg_duration, sum(input_tokens + output_tokens)::BIGINT AS tokens FROM c""",
    "ioc_entities": f"SELECT doc_id, kind, value, count(*) AS n FROM ({_IOC}) GROUP BY 1, 2, 3",
    "ioc_cooccurrence": f"""WITH e AS (SELECT doc_id, kind, value FROM ({_IOC}) GROUP BY 1, 2, 3), n AS (
      SELECT kind || '--' || lower(value) AS source, lead(kind || '--' || lower(value)) OVER (PARTITION BY doc_id ORDER BY kind, value) AS target FROM e)
      SELECT source, target, count(*) AS cnt FROM n WHERE target IS NOT NULL GROUP BY 1, 2""",
}
