"""Streams, an addition of this engine: documents scored as they arrive, and events counted by window.

Scoring is stateless, so the stream runs the same expressions as the batch. The sink writes each micro-batch without the
rows that the dataset has already, so a batch that is tried again adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality


def scored_documents(documents: DataFrame, text: str = "text", least: int = 60) -> DataFrame:
    """doc_id, score, reject_type; documents may be a stream."""
    return documents.select("doc_id", quality.judged(F.col(text), least=least).alias("_q")).select("doc_id", "_q.score", "_q.reject_type")


def document_stream(spark: SparkSession, path: str, schema: str = "doc_id bigint, text string") -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def append_new(rows: DataFrame, path: str, checkpoint: str, key: str = "doc_id") -> StreamingQuery:
    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            held = spark.read.schema(batch.schema).parquet(path).select(key)
        except Exception:  # the first batch makes the dataset
            held = spark.createDataFrame([], batch.schema).select(key)
        batch.dropDuplicates([key]).join(held, key, "left_anti").write.mode("append").parquet(path)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """start, event_type, n, value by window; late events are taken until the watermark passes."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "value")
