"""Connected components of a list of links: forests within tasks, and pointers that jump between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Links that a task turns into a forest at a time: some 20 MB with what is made of them.
BLOCK = 1 << 18


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of the links (a, b), each once, and the least end that each reaches."""
    ends, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(ends))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        apart = low != high
        if not apart.any():
            return ends, ends[root]
        x, y, low, high = x[apart], y[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while not np.array_equal(root, up := root[root]):
            root = up


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of links as stars: every end but the least of its tree, with that one."""
    held: list[np.ndarray] = []

    def stars() -> pa.RecordBatch:
        ends, least = roots(*np.concatenate(held, axis=1))
        some = ends != least
        return pa.RecordBatch.from_arrays([pa.array(ends[some]), pa.array(least[some])], names=["u", "v"])

    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in ("u", "v")]))
        if sum(x.shape[1] for x in held) >= BLOCK:
            yield stars()
            held.clear()
    if held:
        yield stars()


def connected(links: DataFrame) -> DataFrame:
    """id, component (the least id of it) for every end of a link (_a, _b).

    A round makes forests of the links where they lie, so that an end is there once a block at most and no end floods a
    task; hands each end's other parents, and itself, its least; then each end's parent gives way to that one's own.
    Rounds, each written to the shared folder, go on until every end has one parent and no parent has one; they number
    about the log of the longest chain.
    """
    links = links.filter("_a <> _b").select(F.col("_a").alias("u"), F.col("_b").alias("v"))
    while True:
        stars = links.mapInArrow(_forest, "u long, v long").withColumn("_low", F.min("v").over(Window.partitionBy("u")))
        trees = materialise(stars.select(F.when(F.col("v") == F.col("_low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("_low").alias("v")), "trees")
        parents = trees.groupBy("u").agg(F.min("v").alias("_up"), F.max("v").alias("_other"))
        higher = parents.select(F.col("u").alias("v"), "_up")
        jumped = trees.join(higher, "v", "left").select("u", F.coalesce("_up", "v").alias("v"), F.col("_up").isNotNull().alias("_moved"))
        links = materialise(jumped, "links")
        if links.filter("_moved").isEmpty() and parents.filter("_up < _other").isEmpty():
            break
        links = links.select("u", "v")
    found = links.select(F.col("u").alias("id"), F.col("v").alias("component")).distinct()
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
