"""Scratch storage that all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, which the cluster names in spark.checkpoint.dir.

    Where none is named: the one set by setCheckpointDir; on one machine, as in tests, a temporary one of this process, removed at its
    end; on a cluster an error, as no folder of one machine would do.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="loomgraph-")
        atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
    return "file://" + _OWN["dir"]


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Written once and read back: a stage boundary that survives lost executors and is never worked out twice."""
    path = f"{scratch_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
