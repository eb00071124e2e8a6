"""Enrichment of a graph from a table of known tactics, techniques and procedures by vector similarity.

Exact search takes a stated set of query vectors against every row. Queries are dealt into blocks of bounded size;
a block travels to every partition of the table as one matrix and comes back as its best k there, so what is shuffled
is k rows for each query and partition, never a row for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import shortened, slug

#: Query vectors that travel at once (8 bytes a dimension each).
QUERY_BLOCK = 4096


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def half_shifted(score: Column) -> Column:
    """Cosine as a search service tells it, from 0 to 1."""
    return (1 + score) / 2


def nearest(queries: DataFrame, rows: DataFrame, k: int, least: float = 0.0, most: int | None = None, shifted: bool = True, skip_self: bool = True) -> DataFrame:
    """query_id, rk, match_id, score: the k best rows by score, then those of at least `least`, then `most` of them.

    queries and rows: id (long), embedding. Ties go to the smaller id. The queries are read one block at a time.
    """
    out = None
    context = rows.sparkSession.sparkContext
    block_ids: list[int] = []
    block: list[np.ndarray] = []

    def search(ids: np.ndarray, vectors: np.ndarray) -> DataFrame:
        held = context.broadcast((ids, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, vectors = held.value
            for batch in batches:
                batch = batch[batch["embedding"].notna()]
                if not len(batch):
                    continue
                own = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
                own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-300)
                names = batch["id"].to_numpy()
                scores = np.round(vectors @ own.T, 12)
                if skip_self:
                    scores[ids[:, None] == names[None, :]] = -np.inf
                n = min(k, len(names))
                best = np.lexsort((np.broadcast_to(names, scores.shape), -scores), axis=1)[:, :n]
                found = np.take_along_axis(scores, best, axis=1).ravel()
                yield pd.DataFrame({"query_id": np.repeat(ids, n), "match_id": names[best].ravel(), "score": found})[np.isfinite(found)]

        return rows.select("id", "embedding").mapInPandas(run, "query_id long, match_id long, score double")

    for row in queries.select("id", "embedding").filter("embedding is not null").toLocalIterator():
        block_ids.append(row.id)
        block.append(np.asarray(row.embedding, np.float64))
        if len(block) == QUERY_BLOCK:
            found = search(np.array(block_ids), np.stack(block))
            out = found if out is None else out.unionByName(found)
            block_ids, block = [], []
    if block:
        found = search(np.array(block_ids), np.stack(block))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rk long, match_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "match_id")
    ranked = out.withColumn("rk", F.row_number().over(best).cast("long")).filter(F.col("rk") <= k)
    told = half_shifted(F.col("score")) if shifted else F.col("score")
    ranked = ranked.withColumn("score", F.round(told, 6)).filter(F.col("score") >= least)
    return (ranked.filter(F.col("rk") <= most) if most else ranked).select("query_id", "rk", "match_id", "score")


def query_text(label: Column, description: Column | None = None) -> Column:
    """What a node is looked up by: its description if that has over ten characters, else its name; null under five."""
    text = label if description is None else F.when(F.length(description) > 10, description).otherwise(label)
    return F.when(F.length(text) >= 5, text)


def pkey(kind: Column, label: Column) -> Column:
    return F.concat(kind, F.lit("--"), slug(label))


def same_node(kind: Column, label: Column) -> Column:
    return F.concat_ws("\u0000", F.lower(F.trim(kind)), F.lower(F.trim(label)))


def new_nodes(nodes: DataFrame, matches: DataFrame, dedup: bool = True) -> DataFrame:
    """pkey, label, entity_type, cnt of the tactics and techniques that matches (query_id, rk, tactics, techniques) bring."""
    each = matches.select(
        "query_id", "rk", F.inline(F.array(*[F.struct(F.lit(k).alias("entity_type"), F.col(c).alias("label")) for k, c in (("tactic", "tactics"), ("technique", "techniques"))]))
    ).filter("label is not null and label <> ''")
    key = same_node(F.col("entity_type"), F.col("label"))
    first = each.groupBy(key.alias("_key")).agg(F.min(F.struct("query_id", "rk", "entity_type", "label")).alias("_f"))
    if dedup:
        first = first.join(nodes.select(same_node(F.col("entity_type"), F.col("label")).alias("_key")), "_key", "left_anti")
    return first.select(pkey(F.col("_f.entity_type"), F.col("_f.label")).alias("pkey"), "_f.label", "_f.entity_type", F.lit(1).cast("long").alias("cnt"))


def counted_procedures(nodes: DataFrame, matches: DataFrame) -> DataFrame:
    """Procedure nodes with a match count one more for each, and similar_procedures: the matches' texts and scores."""
    held = F.sort_array(F.collect_list(F.struct("rk", shortened(F.col("procedure"), 100).alias("procedure"), "score")))
    found = matches.groupBy(F.col("query_id").alias("node_id")).agg(F.count(F.lit(1)).alias("_n"), held.alias("similar_procedures"))
    out = nodes.join(found, "node_id", "left")
    return out.withColumn("cnt", F.col("cnt") + F.coalesce("_n", F.lit(0))).drop("_n")


def new_edges(matches: DataFrame) -> DataFrame:
    """pkey, skey, label, confidence: HAS from every tactic to every technique of a procedure's matches, LAUNCH from each technique to it.

    Tactics and techniques of one procedure number at most its matches, so their pairs stay within k squared.
    """
    lists = matches.groupBy("query_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("tactics") != "", F.col("tactics")))).alias("ta"),
        F.array_sort(F.collect_set(F.when(F.col("techniques") != "", F.col("techniques")))).alias("te"), F.max("score").alias("confidence"),
    )
    key = lambda kind, c: pkey(F.lit(kind), F.col(c))
    has = lists.select("confidence", F.explode("ta").alias("a"), "te").select("confidence", "a", F.explode("te").alias("b"))
    has = has.select(key("tactic", "a").alias("pkey"), key("technique", "b").alias("skey"), F.lit("HAS").alias("label"), "confidence")
    launch = lists.select("query_id", "confidence", F.explode("te").alias("b"))
    launch = launch.select(key("technique", "b").alias("pkey"), pkey(F.lit("procedure"), F.col("query_id").cast("string")).alias("skey"), F.lit("LAUNCH").alias("label"), "confidence")
    return has.unionByName(launch).distinct()


def stats(nodes: DataFrame, matches: DataFrame, nodes_added: DataFrame, edges_added: DataFrame) -> DataFrame:
    """metric, value."""
    one = lambda df, name, c=None: df.agg((F.count(F.lit(1)) if c is None else c).alias("value")).select(F.lit(name).alias("metric"), "value")
    out = one(nodes, "procedures").unionByName(one(matches, "matches")).unionByName(one(matches, "procedures_enhanced", F.countDistinct("query_id")))
    return out.unionByName(one(nodes_added, "nodes_added")).unionByName(one(edges_added, "edges_added"))
