"""Queries over conversations and events: pairs, samples, evaluation, daily series and idempotent appends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series, training
from ..sources.io import procedure_id
from . import tables
from .graph_queries import _FROM
from .tables import ANSWERS_SQL, table


def _pairs(spark, d):
    return training.valid_pairs(training.turn_pairs(table(spark, d, "conversations")))


def qa_pairs_valid(spark, d):
    return _pairs(spark, d).select("id", F.length("question").cast("long").alias("question_len"), F.length("answer").cast("long").alias("answer_len"))


def qa_summary(spark, d):
    """Each conversation a chunk: its status, and its pairs with a type and a confidence by place."""
    pairs = _pairs(spark, d).select("conv_id", F.struct(F.when(F.col("turn") % 2 == 0, "factual").otherwise("analytical").alias("type"), ((F.col("turn") % 5 + 5) / 10).alias("confidence")).alias("p"))
    lists = pairs.groupBy("conv_id").agg(F.collect_list("p").alias("qa_pairs"))
    chunks = table(spark, d, "conversations").select("conv_id").distinct().join(lists, "conv_id", "left")
    status = F.when(F.col("conv_id") % 10 == 0, "skipped").when(F.col("qa_pairs").isNull(), "failed").otherwise("success")
    return training.qa_summary(chunks.select(status.alias("status"), "qa_pairs"))


def chatml_text(spark, d):
    text = training.chat_text(training.SYSTEM, F.col("question"), F.col("answer"))
    return training.turn_pairs(table(spark, d, "conversations")).select("conv_id", "turn", F.md5(text).alias("text_md5"))


def _chunked(spark, d):
    spread = lambda df, key: df.withColumn("chunk_id", F.col("ord") % 50).drop("doc_id")
    return spread(tables.entities(spark, d).filter("type in ('Nation', 'Supplier')"), "id"), spread(tables.edges(spark, d).filter("type = 'BELONG'"), "source")


def training_samples(spark, d):
    ents, rels = _chunked(spark, d)
    chunks = spark.range(50).select(F.col("id").alias("chunk_id"), F.when(F.col("id") % 7 == 0, " ").otherwise(F.concat(F.lit("chunk "), F.col("id").cast("string"))).alias("content"))
    return training.samples(chunks, ents, rels).select(F.col("chunk_id").alias("chunk"), "n_entities", "n_relationships", F.md5("output").alias("output_md5"))


def sample_sink(spark, d):
    return training.turn_pairs(table(spark, d, "conversations")).orderBy("conv_id", "turn").limit(200).select("conv_id", "turn")


def augmented_samples(spark, d):
    rows = _pairs(spark, d).select("id", F.col("question").alias("input"), F.col("answer").alias("output"))
    return training.augment(rows, "id", 3).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def with_empty_samples(spark, d):
    rows = _pairs(spark, d).select(F.col("question").alias("input"), F.col("answer").alias("output"))
    empty = spark.createDataFrame([(x, training.NOTHING) for x in training.EMPTY_INPUTS], "input string, output string")
    return rows.unionByName(empty).groupBy((F.col("output") == training.NOTHING).alias("is_empty")).agg(F.count(F.lit(1)).alias("n"))


def extraction_evaluation(spark, d):
    return training.evaluation(tables.answers(spark, d))


def extraction_types(spark, d):
    from ..operators.extraction import entities_of, is_json_object

    good = tables.answers(spark, d).filter(is_json_object(F.col("response")))
    return training.type_counts(entities_of(good).withColumn("type", F.when(F.col("k") % 3 == 0, None).otherwise(F.col("type"))), "type")




def _daily(spark, d):
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, d, "events").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("count"), F.countDistinct("user_id").alias("uniques"))


def daily_upsert(spark, d):
    """Days as they were, where an update of every third day doubles its count."""
    old = _daily(spark, d)
    new = old.filter("cast(right(day, 2) as int) % 3 = 0").withColumn("count", F.col("count") * 2)
    return series.upsert(old, new, "day")


def snapshot_totals(spark, d):
    return series.totals(daily_upsert(spark, d), ["count", "uniques"])


def _procedures(spark, d):
    return table(spark, d, "embeddings").select(
        "vec_id", F.concat(F.lit("TA"), F.col("label").cast("string")).alias("tactics"), F.concat(F.lit("T"), (F.col("vec_id") % 37).cast("string")).alias("techniques"),
        F.concat(F.lit("p"), (F.col("vec_id") % 300).cast("string")).alias("procedure"),
    )


def ttp_doc_ids(spark, d):
    return _procedures(spark, d).select("vec_id", procedure_id("tactics", "techniques", "procedure").alias("doc_id"))


def idempotent_append(spark, d):
    """What an insert would do with each id: append it, or skip it because a first batch brought it."""
    rows = ttp_doc_ids(spark, d)
    held = rows.filter("vec_id < 200").select("doc_id").distinct()
    fresh = rows.join(held, "doc_id", "left_anti").select("doc_id").distinct().withColumn("action", F.lit("append"))
    again = rows.join(held, "doc_id", "left_semi").select("doc_id").distinct().withColumn("action", F.lit("skip"))
    return fresh.unionByName(again)


_NAMES = [
    qa_pairs_valid, qa_summary, chatml_text, training_samples, sample_sink, augmented_samples, with_empty_samples, extraction_evaluation, extraction_types, daily_upsert, snapshot_totals, ttp_doc_ids,
    idempotent_append,
]
QUERIES = {f.__name__: f for f in _NAMES}

_PAIRS = """n AS (SELECT conv_id, turn, role, text AS q, lead(text) OVER w AS a, lead(role) OVER w AS nr FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
t AS (SELECT conv_id, turn, q, a FROM n WHERE role = 'user' AND nr = 'assistant'),
s AS (SELECT conv_id, turn, regexp_replace(q, '^\\s+|\\s+$', '', 'g') AS q, regexp_replace(a, '^\\s+|\\s+$', '', 'g') AS a FROM t),
v AS (SELECT *, 'chunk_' || conv_id || '_qa_' || row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS id FROM s WHERE length(q) >= 5 AND length(a) >= 10)"""
_DAYS = "o AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count, count(DISTINCT user_id) AS uniques FROM events GROUP BY 1), u AS (SELECT day, CASE WHEN right(day, 2)::INT % 3 = 0 THEN count * 2 ELSE count END AS count, uniques FROM o)"
_IDS = "i AS (SELECT vec_id, md5('TA' || label || '_T' || (vec_id % 37) || '_p' || (vec_id % 300)) AS doc_id FROM embeddings)"
SQL = {
    "qa_pairs_valid": f"WITH {_PAIRS} SELECT id, length(q)::BIGINT AS question_len, length(a)::BIGINT AS answer_len FROM v",
    "qa_summary": f"""WITH {_PAIRS}, c AS (SELECT DISTINCT conv_id FROM conversations), st AS (SELECT conv_id, CASE WHEN conv_id % 10 = 0 THEN 'skipped' WHEN conv_id NOT IN (SELECT conv_id FROM v) THEN 'failed' ELSE 'success' END AS st FROM c),
      p AS (SELECT (turn % 5 + 5) / 10 AS c FROM v WHERE conv_id IN (SELECT conv_id FROM st WHERE st = 'success')), k AS (SELECT count(*) AS total, count(*) FILTER (st = 'success') AS success FROM st)
      SELECT total, success, total - success AS failed, round(100.0 * success / total, 2)::DOUBLE AS success_rate, (SELECT count(*) FROM p) AS pairs, (SELECT round(avg(c), 3) FROM p) AS avg_confidence,
        round((SELECT count(*) FROM p) / success, 2) AS avg_per_chunk FROM k""",
    "chatml_text": f"""WITH {_PAIRS} SELECT conv_id, turn, md5('<|im_start|>system' || chr(10) || '{training.SYSTEM}' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || q || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || a || '<|im_end|>') AS text_md5 FROM t""",
    "training_samples": f"""{_FROM}, e AS (SELECT ord % 50 AS c, count(*) AS n, '[' || string_agg('{{"labels":"' || type || '","id":"' || id || '","name":"' || name || '"}}', ',' ORDER BY ord) || ']' AS j FROM entities WHERE type IN ('Nation', 'Supplier') GROUP BY 1),
      r AS (SELECT ord % 50 AS c, count(*) AS n, '[' || string_agg('{{"type":"' || type || '","source":"' || source || '","target":"' || target || '"}}', ',' ORDER BY ord) || ']' AS j FROM edges WHERE type = 'BELONG' GROUP BY 1)
      SELECT e.c AS chunk, e.n AS n_entities, coalesce(r.n, 0) AS n_relationships, md5('{{"entities":' || e.j || ',"relationships":' || coalesce(r.j, '[]') || '}}') AS output_md5 FROM e LEFT JOIN r ON r.c = e.c WHERE e.c % 7 <> 0""",
    "sample_sink": f"WITH {_PAIRS} SELECT conv_id, turn FROM t ORDER BY conv_id, turn LIMIT 200",
    "with_empty_samples": f"WITH {_PAIRS} SELECT false AS is_empty, count(*) AS n FROM v UNION ALL SELECT true, 6",
    "extraction_evaluation": f"""WITH {ANSWERS_SQL.replace("STRING", "VARCHAR")}, p AS (SELECT k, k % 7 <> 0 AS ok FROM answers)
      SELECT count(*) AS total, count(*) FILTER (ok) AS parsed, round(count(*) FILTER (ok) / count(*), 6) AS rate, round(count(*) FILTER (ok) / count(*) - 0.65::DOUBLE, 6) AS over_baseline, count(*) FILTER (ok) AS has_entities,
        count(*) FILTER (ok) AS with_entities, count(*) FILTER (ok) AS has_relationships, count(*) FILTER (ok) AS with_relationships, round(count(*) FILTER (ok) / count(*), 6) AS avg_entities, round(count(*) FILTER (ok) / count(*), 6) AS avg_relationships FROM p""",
    "extraction_types": "SELECT CASE WHEN p_partkey % 3 = 0 THEN 'Unknown' ELSE 'Tool' END AS type, count(*) AS n FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 GROUP BY 1",
    "daily_upsert": f"WITH {_DAYS} SELECT * FROM u",
    "snapshot_totals": f"WITH {_DAYS} SELECT count(*) AS days, sum(count)::BIGINT AS total_count, sum(uniques)::BIGINT AS total_uniques FROM u",
    "ttp_doc_ids": f"WITH {_IDS} SELECT vec_id, doc_id FROM i",
    "idempotent_append": f"WITH {_IDS} SELECT DISTINCT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM i WHERE vec_id < 200) THEN 'skip' ELSE 'append' END AS action FROM i",
}
