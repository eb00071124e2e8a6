"""Inputs of the registered queries: the driver's tables, and what is derived from them the same way in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- markdown lines -----------------------------------------------------------------------------

# Every third text stays as it is but for what stands around it, one of each thing that a rule looks for; in the others
# whole lines are made into headings, rows, captions and marks.
_TEXT = """CASE WHEN doc_id % 3 = 0 THEN '<!-- image -->' || chr(10) || chr(10) || '7' || chr(10) || chr(10) || 'Table 2 of many' || chr(10) || '表1 事件' || chr(10) || text
    || chr(10) || chr(10) || chr(10) || chr(10) || chr(10) || 'after the gap' || chr(10) || '## 附录4 参考链接' || chr(10) || 'link' ELSE text END"""
_LINE = r"""CASE WHEN doc_id % 3 = 0 THEN raw ELSE CASE (doc_id + pos) % 11
  WHEN 0 THEN '' WHEN 1 THEN '## ' || CASE WHEN pos % 2 = 0 THEN raw ELSE 'Part ' || CAST(pos AS STRING) END WHEN 2 THEN '# ' || raw
  WHEN 3 THEN '| ' || raw || ' | ' || CAST(pos AS STRING) || ' |' WHEN 4 THEN '| --- | --- |'
  WHEN 5 THEN CASE WHEN pos % 3 = 0 THEN '```' ELSE '====' END
  WHEN 6 THEN 'Table ' || CAST(pos AS STRING) || '. ' || raw WHEN 7 THEN CASE WHEN pos % 2 = 0 THEN '' ELSE '---' END
  WHEN 8 THEN '（' || CAST(pos AS STRING) || '）' || raw WHEN 9 THEN '图1.' || CAST(pos AS STRING) || ' ' || raw
  ELSE raw END END"""


def marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, line: the whole lines of documents, with what markdown rules look for planted among them."""
    raw = table(spark, sf_dir, "documents").select("doc_id", F.expr(_TEXT).alias("text"))
    raw = raw.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    return raw.withColumn("pos", F.col("pos").cast("long")).select("doc_id", "pos", F.expr(_LINE).alias("line"))


LINES_SQL = f"""raw_lines AS (
  SELECT doc_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos, unnest(string_split(text, chr(10))) AS raw FROM (SELECT doc_id, {_TEXT} AS text FROM documents)
), lines AS (SELECT doc_id, pos, {_LINE} AS line FROM raw_lines)"""

# -- a graph over the star schema ---------------------------------------------------------------

_KINDS = (("region", "r_regionkey", "r_name"), ("nation", "n_nationkey", "n_name"), ("supplier", "s_suppkey", "s_name"), ("customer", "c_custkey", "c_name"), ("part", "p_partkey", "p_name"))
ENTITIES_SQL = "entities AS (" + " UNION ALL ".join(
    f"SELECT '{t}--' || CAST({k} AS STRING) AS id, '{t.capitalize()}' AS type, {n} AS name, CAST({k} AS BIGINT) * 5 + {at} AS ord FROM {t}" for at, (t, k, n) in enumerate(_KINDS)
) + ")"
EDGES_SQL = """edges AS (
  SELECT 'nation--' || CAST(n_nationkey AS STRING) AS source, 'region--' || CAST(n_regionkey AS STRING) AS target, 'BELONG' AS type, CAST(n_nationkey AS BIGINT) * 4 AS ord FROM nation
  UNION ALL SELECT 'supplier--' || CAST(s_suppkey AS STRING), 'nation--' || CAST(s_nationkey AS STRING), 'BELONG', s_suppkey * 4 + 1 FROM supplier
  UNION ALL SELECT 'customer--' || CAST(c_custkey AS STRING), 'nation--' || CAST(c_nationkey AS STRING), 'BELONG', c_custkey * 4 + 2 FROM customer WHERE c_custkey % 3 <> 0
  UNION ALL SELECT 'part--' || CAST(l_partkey AS STRING),
    CASE WHEN l_orderkey % 97 = 0 THEN 'part--' || CAST(l_partkey AS STRING) WHEN l_orderkey % 83 = 0 THEN 'supplier--none' ELSE 'supplier--' || CAST(l_suppkey AS STRING) END,
    CASE WHEN l_orderkey % 89 = 0 THEN 'ZZZ' ELSE 'USE' END, (l_orderkey * 8 + l_linenumber) * 4 + 3 FROM lineitem
)"""
SCHEMA = [("Nation", "Region", "BELONG"), ("Supplier", "Nation", "BELONG"), ("Part", "Supplier", "USE")]
SCHEMA_SQL = "allowed(source_type, target_type, type) AS (VALUES " + ", ".join(str(x) for x in SCHEMA) + ")"


def _from_sql(spark: SparkSession, sf_dir: str, body: str, name: str, tables: list[str]) -> DataFrame:
    for t in tables:
        body = body.replace(f"FROM {t}", f"FROM parquet.`{sf_dir}/{t}.parquet`")
    return spark.sql(f"WITH {body} SELECT * FROM {name}")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, chunk_id, ord, id, type, name."""
    out = _from_sql(spark, sf_dir, ENTITIES_SQL, "entities", [t for t, _, _ in _KINDS])
    return out.select(F.lit(0).alias("doc_id"), F.lit(0).alias("chunk_id"), "*")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _from_sql(spark, sf_dir, EDGES_SQL, "edges", ["nation", "supplier", "customer", "lineitem"])
    return out.select(F.lit(0).alias("doc_id"), F.lit(0).alias("chunk_id"), "*")


# -- answers of a model -------------------------------------------------------------------------

_ANSWER = r"""'{"entities":[' || CASE k % 5 WHEN 0 THEN '{"labels":"Tool","name":"' || name || '"}'
  WHEN 1 THEN '{"labels":"Tool","properties":{"id":"tool--' || CAST(k AS STRING) || '","name":"' || name || '"}}'
  ELSE '{"labels":"Tool","id":"tool--' || CAST(k AS STRING) || '","name":"' || name || '","description":"d"}' END
  || '],"relationships":[{"source":"a' || CAST(k AS STRING) || '","target":"b"' || CASE WHEN k % 4 = 0 THEN '' ELSE ',"type":"USE"' END || ',"confidence":'
  || CASE k % 6 WHEN 0 THEN '0.876' WHEN 1 THEN '1.2' WHEN 2 THEN '"0.9"' WHEN 3 THEN '1' WHEN 4 THEN '0.125' ELSE 'null' END
  || CASE WHEN k % 7 = 0 THEN '}]' ELSE '}]}' END"""
ANSWERS_SQL = f"answers AS (SELECT k, {_ANSWER} AS response FROM (SELECT CAST(p_partkey AS BIGINT) AS k, p_name AS name FROM part))"


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, response: an entity and a relationship each, with fields missing, nested, out of range, or the JSON cut off."""
    return _from_sql(spark, sf_dir, ANSWERS_SQL, "answers", ["part"])
