"""Filters, remapping, building and statistics of entity graphs, as joins and aggregations.

Entities: doc_id, chunk_id, ord, id, type, name, ... Relationships: doc_id, chunk_id, ord, source, target, type, ...
Vocabularies and schemas are small tables that the caller writes; they join by equality and Spark broadcasts them by
their size. Everything else joins by shuffle on ids, and chunk-wise steps keep (doc_id, chunk_id) in their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import materialise

CHUNK = ["doc_id", "chunk_id"]


def schema_table(spark: SparkSession, triples: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(triples, "source_type string, target_type string, type string")


def of_types(rows: DataFrame, types: list[str], column: str = "type") -> DataFrame:
    return rows.filter(F.col(column).isin(types))


def no_self_loops(edges: DataFrame) -> DataFrame:
    return edges.filter(~F.col("source").eqNullSafe(F.col("target")))


def last_of_id(entities: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """One row for each id, the last in order."""
    keys = [*(scope or []), "id"]
    rest = [c for c in entities.columns if c not in (*keys, "ord")]
    kept = entities.filter("id is not null").groupBy(*keys).agg(F.max(F.struct("ord", *rest)).alias("_e"))
    return kept.select(*keys, "_e.ord", *[f"_e.{c}" for c in rest])


def fits_schema(edges: DataFrame, entities: DataFrame, schema: DataFrame | None, scope: list[str] | None = None) -> DataFrame:
    """Edges whose types the schema allows; an id that has no entity has no type, so it fits nothing. No schema, no check."""
    if schema is None:
        return edges
    scope = scope or []
    types = last_of_id(entities, scope).select(*scope, "id", F.col("type").alias("_type"))
    out = edges
    for end in ("source", "target"):
        side = types.withColumnsRenamed({"id": end, "_type": f"{end}_type"})
        out = out.join(side, [*scope, end], "left").fillna("", [f"{end}_type"])
    return out.join(schema, ["source_type", "target_type", "type"], "left_semi").select(*edges.columns)


def ends_exist(edges: DataFrame, entities: DataFrame, scope: list[str] | None = None) -> DataFrame:
    scope = scope or []
    ids = entities.select(*scope, "id")
    for end in ("source", "target"):
        edges = edges.join(ids.withColumnRenamed("id", end), [*scope, end], "left_semi")
    return edges


def dangling(edges: DataFrame, entities: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Edges with an end that is no entity. Ends are looked up in distinct ids, so no edge comes twice."""
    scope = scope or []
    ids = entities.select(*scope, "id").distinct()
    out = edges
    for end in ("source", "target"):
        out = out.join(ids.withColumnRenamed("id", end).withColumn(f"_{end}", F.lit(True)), [*scope, end], "left")
    return out.filter("_source is null or _target is null").select(*edges.columns)


def ends(edges: DataFrame, scope: list[str] | None = None) -> DataFrame:
    return edges.select(*(scope or []), F.explode(F.array("source", "target")).alias("id")).distinct()


def connected(entities: DataFrame, edges: DataFrame, scope: list[str] | None = None) -> DataFrame:
    return entities.join(ends(edges, scope), [*(scope or []), "id"], "left_semi")


def isolated(entities: DataFrame, edges: DataFrame, scope: list[str] | None = None) -> DataFrame:
    return entities.join(ends(edges, scope), [*(scope or []), "id"], "left_anti")


def filter_chunks(entities: DataFrame, edges: DataFrame, types: list[str], edge_types: list[str], schema: DataFrame | None = None, drop_isolated: bool = True) -> tuple[DataFrame, DataFrame]:
    """The filter of each chunk's extraction: types, self-loops, schema, dangling edges, isolated nodes, one row for each id."""
    entities = of_types(entities, types)
    edges = no_self_loops(of_types(edges, edge_types))
    edges = fits_schema(edges, entities, schema, CHUNK)
    if drop_isolated:
        edges = ends_exist(edges, entities, CHUNK)
        entities = last_of_id(connected(entities, edges, CHUNK), CHUNK)
    return entities, edges


def filter_aligned(entities: DataFrame, edges: DataFrame, schema: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The filter after alignment, over the whole graph; several rows of an id survive."""
    edges = fits_schema(no_self_loops(ends_exist(edges, entities)), entities, schema)
    return connected(entities, edges), edges


# -- ids ----------------------------------------------------------------------------------------


def id_variants(mapping: DataFrame) -> DataFrame:
    """variant, new_id for mapping (old_id, new_id, ord): the spellings of each id. An id that is spelled so itself wins, the
    last such; among variants the first."""
    old = F.col("old_id")
    cap = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))
    at = F.instr(old, "--")
    left, right = F.substring(old, F.lit(1), at - 1), F.substring(old, at + 2, F.length(old))
    two = lambda a, b: F.when(at > 0, F.concat(a, F.lit("--"), b))
    spelled = [
        F.lower(old), F.upper(old), cap(old), two(F.lower(left), F.lower(right)), two(F.upper(left), F.upper(right)),
        two(cap(left), right), two(cap(left), F.lower(right)), two(cap(left), F.upper(right)),
    ]
    exact = mapping.select(F.col("old_id").alias("variant"), "new_id", F.lit(0).alias("_kind"), (-F.col("ord")).alias("_at"), F.lit(0).alias("_n"))
    others = mapping.select("new_id", "ord", F.posexplode(F.array(*spelled)).alias("_n", "variant")).filter("variant is not null")
    others = others.select("variant", "new_id", F.lit(1).alias("_kind"), F.col("ord").alias("_at"), "_n")
    best = exact.unionByName(others).groupBy("variant").agg(F.min(F.struct("_kind", "_at", "_n", "new_id")).alias("_b"))
    return best.select("variant", F.col("_b.new_id").alias("new_id"))


def remap(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges over new ids; an end that the mapping (old_id, new_id; unique) lacks drops the edge."""
    for end in ("source", "target"):
        edges = edges.join(mapping.select(F.col("old_id").alias(end), F.col("new_id").alias(f"_{end}")), end).drop(end).withColumnRenamed(f"_{end}", end)
    return edges


# -- graphs -------------------------------------------------------------------------------------


def full_graph(entities: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities and relationships with their defaults."""
    has = lambda df, c, default: F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default)
    nodes = entities.select("id", "name", F.col("type").alias("labels"), has(entities, "description", "").alias("description"), has(entities, "merge_count", 1).alias("merge_count"))
    links = edges.select("source", "target", "type", has(edges, "confidence", 0.7).alias("confidence"), has(edges, "evidence", "").alias("evidence"))
    return nodes, links


def simple_nodes(entities: DataFrame) -> DataFrame:
    """pkey, label, entity_type, cnt: the merge count of the last entity with that key."""
    count = F.coalesce(F.col("merge_count"), F.lit(1)) if "merge_count" in entities.columns else F.lit(1)
    rows = entities.select(F.col("id").alias("pkey"), F.col("name").alias("label"), F.lower("type").alias("entity_type"), "ord", count.cast("long").alias("_n"))
    return rows.groupBy("pkey", "label", "entity_type").agg(F.max(F.struct("ord", "_n"))["_n"].alias("cnt"))


def simple_edges(edges: DataFrame) -> DataFrame:
    """pkey, skey, label, cnt: how often the edge came."""
    return edges.groupBy(F.col("source").alias("pkey"), F.col("target").alias("skey"), F.col("type").alias("label")).agg(F.count(F.lit(1)).alias("cnt"))


def node_keys(nodes: DataFrame, edges: DataFrame, order: str = "ord") -> DataFrame:
    """pkey, node_id: numbers from 0 by first appearance, nodes before ends of edges, sources before targets.

    Numbers without gaps over all nodes: range partitions by first appearance are counted, and each adds the sum of
    those before it, so no task sorts the whole graph.
    """
    seen = nodes.select("pkey", F.lit(0).alias("_k"), F.col(order).cast("long").alias("_o"))
    both = edges.select(F.posexplode(F.array("pkey", "skey")).alias("_e", "pkey"), F.col(order).cast("long").alias("_o"))
    seen = seen.unionByName(both.select("pkey", F.lit(1).alias("_k"), (F.col("_o") * 2 + F.col("_e")).alias("_o")))
    first = seen.groupBy("pkey").agg(F.min(F.struct("_k", "_o")).alias("_f")).select("pkey", "_f._k", "_f._o")
    return dense_numbers(first, ["_k", "_o", "pkey"], "node_id").select("pkey", "node_id")


def dense_numbers(rows: DataFrame, order: list[str], into: str) -> DataFrame:
    """rows numbered from 0 in order, over all partitions."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() % (1 << 33))
    placed = materialise(placed, "numbers")  # a partition's number must be the same in both uses, and after a lost executor
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_b"))
    return placed.join(F.broadcast(before), "_p").withColumn(into, F.col("_i") + F.col("_b")).drop("_p", "_i", "_n", "_b")


def node_link(nodes: DataFrame, edges: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Numbered nodes (with those that only edges name) and links by number."""
    keys = node_keys(nodes, edges, order)
    listed = keys.join(nodes.select("pkey", "label", "entity_type"), "pkey", "left")
    shown = listed.select("node_id", F.coalesce("label", "pkey").alias("name"), "label", "entity_type")
    out = edges
    for end, into in (("pkey", "source"), ("skey", "target")):
        out = out.join(keys.select(F.col("pkey").alias(end), F.col("node_id").alias(into)), end)
    return shown, out.select("source", "target", F.col("label").alias("relation"))


def node_stats(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy(F.col("entity_type").alias("type")).agg(F.countDistinct("label").alias("n_unique"), F.sum("cnt").cast("long").alias("n_occurrences"))


def edge_stats(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("label").alias("type")).agg(F.countDistinct("pkey", "skey").alias("n_unique"), F.sum("cnt").cast("long").alias("n_occurrences"))


def top_types(stats: DataFrame, most: int = 5) -> DataFrame:
    return stats.orderBy(F.col("n_occurrences").desc(), "type").limit(most)


def to_json_key(*columns: Column | str) -> Column:
    """The key of a simple graph's map, as JSON with fields in order of name."""
    return F.to_json(F.struct(*columns))
