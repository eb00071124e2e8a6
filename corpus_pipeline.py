"""From raw documents to piece ids: five stages, each on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; run writes each as Parquet in the shared folder and
reads it back as the next one's docs. All but the last return the columns of documents. ORACLE_SQL is None: the
encoding, and components over similarity links, are beyond SQL; tests hold the stages against brute force instead.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import decontaminate, jaccard_join, line_dedup, quality_rules, sentencepiece_fst
from loomgraph.llm.common import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites; those without any other line stay whole."""
    return line_dedup.drop_boilerplate(docs, spare_copies=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group that similarity links: 0.8 or more of five-word shingles."""
    return jaccard_join.keep_one_of_each(docs, threshold=Fraction(4, 5), n=5)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, and whether decoding the ids gives the text back."""
    held = sentencepiece_fst.encode(docs.select("doc_id", "text"), decoded="_decoded")
    return held.select(
        "doc_id",
        F.col("_ids").alias("ids"),
        F.coalesce(F.size("_ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.col("text").eqNullSafe(F.col("_decoded")).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding and decoding", pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
