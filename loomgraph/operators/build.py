"""From what a model found in each chunk to one graph: union, alignment, new ids, filters, full and simple form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import alignment, graph


def raw_union(results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All entities, all relationships, and one row of totals, of results (entities, relationships: arrays of structs; a row for each chunk).

    Nothing is merged; a null array is an empty one, and its chunk counts.
    """
    entities, relationships = (results.select(F.explode(c).alias("x")).select("x.*") for c in ("entities", "relationships"))
    size = lambda c: F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.size(c))), F.lit(0)).cast("long")
    totals = results.agg(size("entities").alias("total_entities"), size("relationships").alias("total_relationships"), F.count(F.lit(1)).alias("chunks_processed"))
    return entities, relationships, totals


def align(entities: DataFrame, strategy: str | None = None, groups: DataFrame | None = None, threshold: float = alignment.THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Aligned entities, and the mapping old_id, new_id, ord.

    strategy: 'groups' (lists of positions that a model gave), 'closure', 'greedy', 'exact' (names equal but for case), or
    'none'. Without one, groups where there are any, else closure. Types of a single entity pass by unchanged; with
    'groups', so do types that no list names.
    """
    strategy = strategy or ("groups" if groups is not None else "closure")
    if strategy not in ("groups", "closure", "greedy", "exact", "none"):
        raise ValueError(f"no such strategy: {strategy}")
    if "description" not in entities.columns:
        entities = entities.withColumn("description", F.lit(None).cast("string"))
    kept = [c for c in ("id", "type", "name", "description", "ord", "chunks_info") if c in entities.columns]
    entities = entities.select(*kept)
    if strategy == "none":
        latest = Window.partitionBy("old_id").orderBy(F.col("ord").desc())
        mapping = entities.select(F.col("id").alias("old_id"), F.col("id").alias("new_id"), "ord")
        mapping = mapping.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")
        return entities.withColumns({"merge_count": F.lit(1).cast("long"), "original_names": F.col("name")}), mapping
    if strategy == "closure":
        return alignment.closure(entities, threshold=threshold)
    if strategy == "exact":
        placed = entities.withColumn("_cluster", F.struct("type", F.lower("name").alias("name")))
        out = alignment.merge(placed, "_cluster")
    elif strategy == "greedy":
        placed = alignment.greedy(entities, threshold)
        out = alignment.merge(placed, "_cluster")
    else:
        placed = alignment.apply_merge_groups(entities, groups)
        out = alignment.merge(placed, "_cluster")
    mapping = placed.select("_cluster", F.col("id").alias("old_id"), "ord").join(out.select("_cluster", F.col("id").alias("new_id")), "_cluster").drop("_cluster")
    mapping = mapping.groupBy("old_id").agg(F.max(F.struct("ord", "new_id")).alias("_l")).select("old_id", "_l.new_id", "_l.ord")
    return out.drop("_cluster"), mapping


def merge_items(entities: DataFrame, name: int = 50, description: int = 100) -> DataFrame:
    """type, n, listing: what a model is shown of each type of several entities, numbered by ord from 0. A type is one row."""
    item = F.concat(F.lit('name: "'), F.substring(F.coalesce("name", F.lit("")), 1, name), F.lit('", description: "'), F.substring(F.coalesce("description", F.lit("")), 1, description), F.lit('"'))
    held = entities.groupBy("type").agg(F.sort_array(F.collect_list(F.struct("ord", item.alias("i")))).alias("items")).filter(F.size("items") > 1)
    lines = F.transform("items", lambda x, k: F.concat(k.cast("string"), F.lit(". "), x["i"]))
    return held.select("type", F.size("items").cast("long").alias("n"), F.array_join(lines, "\n").alias("listing"))


@dataclass
class Graph:
    """The aligned entities and relationships, with their full and simple forms."""

    entities: DataFrame
    relationships: DataFrame

    @property
    def full(self) -> tuple[DataFrame, DataFrame]:
        return graph.full_graph(self.entities, self.relationships)

    @property
    def simple(self) -> tuple[DataFrame, DataFrame]:
        return graph.simple_nodes(self.entities), graph.simple_edges(self.relationships)


def pure_graph(entities: DataFrame, relationships: DataFrame, schema: DataFrame | None = None, strategy: str | None = None, groups: DataFrame | None = None, threshold: float = alignment.THRESHOLD) -> Graph:
    """Alignment, relationships over new ids (found under any spelling of the old one), then the filter over the whole graph."""
    aligned, mapping = align(entities, strategy, groups, threshold)
    spelled = graph.id_variants(mapping).withColumnRenamed("variant", "old_id")
    return Graph(*graph.filter_aligned(aligned, graph.remap(relationships, spelled), schema))
