"""Readers and writers. A stage's output is a Parquet dataset; small results can also become one JSON or text file."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import file_type, strip
from ..operators.html import markdown_of

# -- reading ------------------------------------------------------------------------------------


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """url, file_type, html of the files under a path."""
    out = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
    return out.withColumn("file_type", file_type(F.col("url")))


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def read_chunk_file(spark: SparkSession, path: str, ids: list[str] | None = None) -> DataFrame:
    """content, metadata, length of a selected-chunks file; ids keeps those chunk ids, compared as text."""
    item = "array<struct<content:string,metadata:map<string,string>,length:int>>"
    out = read_json(spark, path, f"selected_chunks {item}").select(F.inline("selected_chunks"))
    return out.filter(F.element_at("metadata", F.lit("chunk_id")).isin(ids)) if ids else out


def read_known_procedures(spark: SparkSession, path: str) -> DataFrame:
    """tactics, techniques, procedure from the first three columns of a CSV with a header; rows without a procedure go."""
    out = spark.read.csv(path, header=True, multiLine=True, escape='"')
    if len(out.columns) < 3:
        raise ValueError("three columns are needed: tactics, techniques, procedure")
    names = ["tactics", "techniques", "procedure"]
    out = out.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in zip(out.columns, names, strict=False)])
    return out.filter(strip(F.col("procedure")) != "")


class Converters:
    """Converters from files to title, markdown, images and error, by type; more can be added."""

    def __init__(self) -> None:
        self.by_type: dict[str, Callable[[Column], Column]] = {"html": markdown_of}

    def add(self, kind: str, convert: Callable[[Column], Column]) -> None:
        self.by_type[kind] = convert

    def types(self) -> list[str]:
        return sorted(self.by_type)

    def convert(self, files: DataFrame, content: str = "html") -> DataFrame:
        """files with `page`; a type without a converter has an error instead of a text."""
        out = None
        for kind, f in self.by_type.items():
            part = files.filter(F.col("file_type") == kind).withColumn("page", f(F.col(content)))
            out = part if out is None else out.unionByName(part)
        rest = files.filter(F.coalesce(~F.col("file_type").isin(list(self.by_type)), F.lit(True)))
        kind = out.schema["page"].dataType
        missing = F.struct(*[(F.lit("no converter") if f.name == "error" else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])
        return out.unionByName(rest.withColumn("page", missing))


# -- writing ------------------------------------------------------------------------------------


def write_stage(df: DataFrame, folder: str, number: int, name: str) -> DataFrame:
    """A stage's dataset, read back, so later stages never work it out again."""
    path = f"{folder}/{number:02d}_{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_text(df: DataFrame, path: str, column: str = "text") -> None:
    df.select(column).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_json(rows: object, path: str) -> None:
    """A small result of the driver as one readable file."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False, indent=2)


def chunk_dump(chunks: DataFrame) -> DataFrame:
    """content, metadata, length as a selected-chunks file holds them; length falls back to characters."""
    length = F.coalesce("token_length", F.length("content")) if "token_length" in chunks.columns else F.length("content")
    rest = [c for c in chunks.columns if c not in ("content", "token_length")]
    return chunks.select("content", F.to_json(F.struct(*rest)).alias("metadata"), length.cast("long").alias("length"))


def procedure_id(*columns: str) -> Column:
    return F.md5(F.concat_ws("_", *columns))


class VectorTable:
    """Known procedures with their vectors, keyed by doc_id, as a Parquet dataset."""

    SCHEMA = "doc_id string, embedding array<float>, procedure string, tactics string, techniques string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def create(self) -> None:
        self.spark.createDataFrame([], self.SCHEMA).write.mode("overwrite").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def missing(self, rows: DataFrame) -> DataFrame:
        """Rows, one for each doc_id, that the table doesn't have."""
        first = Window.partitionBy("doc_id").orderBy("procedure", "tactics", "techniques")
        single = rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
        return single.join(self.read().select("doc_id"), "doc_id", "left_anti")

    def insert(self, rows: DataFrame) -> int:
        """Append what is missing; again with the same rows, nothing."""
        before = self.read().count()
        self.missing(rows).select("doc_id", "embedding", "procedure", "tactics", "techniques").write.mode("append").parquet(self.path)
        return self.read().count() - before


def append_samples(samples: DataFrame, path: str) -> None:
    samples.select("input", "output").write.mode("append").json(path)
