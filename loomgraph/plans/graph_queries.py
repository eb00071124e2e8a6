"""Queries over graphs: filters, ids, alignment, building, statistics and enrichment by vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alignment, build, enrichment, graph, html, quality
from ..operators.extraction import RuleExtractor
from . import tables
from .tables import EDGES_SQL, ENTITIES_SQL, SCHEMA, SCHEMA_SQL, table

TYPES, EDGE_TYPES = ["Region", "Nation", "Supplier", "Part"], ["BELONG", "USE"]
_E, _R = tables.entities, tables.edges
_FROM = f"WITH {ENTITIES_SQL.replace('STRING', 'VARCHAR')}, {EDGES_SQL.replace('STRING', 'VARCHAR')}, {SCHEMA_SQL}"


def entity_type_filter(spark, d):
    return graph.of_types(_E(spark, d), TYPES).select("id", "type")


def schema_filtered_edges(spark, d):
    edges = graph.no_self_loops(graph.of_types(_R(spark, d), EDGE_TYPES))
    kept = graph.fits_schema(edges, _E(spark, d), graph.schema_table(spark, SCHEMA))
    return kept.select("source", "target", "type", "ord")


def dangling_edges(spark, d):
    return graph.dangling(_R(spark, d), _E(spark, d)).select("source", "target", "type", "ord")


def isolated_nodes(spark, d):
    return graph.isolated(_E(spark, d), _R(spark, d)).select("id", "type")


def connected_nodes(spark, d):
    return graph.connected(_E(spark, d), _R(spark, d)).select("id", "type")


def chunk_graph_filter(spark, d):
    nodes, edges = graph.filter_chunks(_E(spark, d), _R(spark, d), TYPES, EDGE_TYPES, graph.schema_table(spark, SCHEMA))
    count = lambda df, kind: df.groupBy("type").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "type", "n")
    return count(nodes, "entity").unionByName(count(edges, "relationship"))


def post_alignment_filter(spark, d):
    nodes, edges = graph.filter_aligned(_E(spark, d), _R(spark, d), graph.schema_table(spark, SCHEMA))
    return nodes.agg(F.count(F.lit(1)).alias("entities")).join(edges.agg(F.count(F.lit(1)).alias("relationships")))


def _mapping(spark, d):
    """Suppliers of one nation merge into one; ids in two spellings."""
    rows = table(spark, d, "supplier")
    return rows.select(
        F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Supplier--S"), F.col("s_suppkey").cast("string"))).otherwise(F.concat(F.lit("supplier--"), F.col("s_suppkey").cast("string"))).alias("old_id"),
        F.concat(F.lit("group--"), F.col("s_nationkey").cast("string")).alias("new_id"), F.col("s_suppkey").alias("ord"),
    )


def id_variants(spark, d):
    return graph.id_variants(_mapping(spark, d))


def id_remap(spark, d):
    edges = _R(spark, d).filter("type = 'BELONG'")
    nations = _E(spark, d).filter("type in ('Nation', 'Region')").select(F.col("id").alias("old_id"), F.col("id").alias("new_id"))
    mapping = _mapping(spark, d).select("old_id", "new_id").unionByName(nations)
    return graph.remap(edges, mapping).select("source", "target", "type")


def unmapped_ids(spark, d):
    return alignment.unmapped(_E(spark, d).filter("type = 'Supplier'").select("id"), _mapping(spark, d))


def _named(spark, d):
    """Part names, one entity for each brand and name."""
    rows = table(spark, d, "part").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("ord"))
    return rows.select(F.col("p_brand").alias("type"), F.col("p_name").alias("name"), "ord", F.concat(F.lit("part--"), F.col("ord").cast("string")).alias("id"), F.concat(F.lit("d"), (F.col("ord") % 3).cast("string")).alias("description"))


def similar_pairs(spark, d):
    return alignment.similar_pairs(_named(spark, d).select("type", F.col("ord").alias("id"), "name"), ["type"])


def nation_pairs(spark, d):
    names = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    return alignment.similar_pairs(names.withColumn("_b", F.lit(1)), ["_b"])




def acronym_pairs(spark, d):
    names = spark.sql(f"SELECT CAST(n_nationkey AS BIGINT) AS id, left(n_name, 1) || ' x' AS long, lower(left(n_name, 1)) || 'x' AS short FROM parquet.`{d}/nation.parquet`")
    pairs = names.select(F.col("id").alias("a"), "long").join(names.select(F.col("id").alias("b"), "short"), alignment.is_acronym(F.col("long"), F.col("short")))
    return pairs.select("a", "b")


def aligned_entities_closure(spark, d):
    out, _ = alignment.closure(_named(spark, d))
    return out.select("id", "name", F.col("merge_count").cast("long").alias("merge_count"), "description", "ord")


def aligned_entities_greedy(spark, d):
    out = alignment.merge(alignment.greedy(_named(spark, d)), "_cluster")
    return out.select("id", "name", F.col("merge_count").cast("long").alias("merge_count"))


def merged_by_groups(spark, d):
    groups = spark.createDataFrame([("Region", [[0, 1], [1, 2], [3, 4, 9]])], "type string, groups array<array<int>>")
    out = alignment.apply_merge_groups(_E(spark, d).filter("type = 'Region'").withColumn("description", F.lit(None).cast("string")), groups)
    return alignment.merge(out, "_cluster").select("id", "name", F.col("merge_count").cast("long").alias("merge_count"))


CHUNK_ROWS = 100


def raw_graph_totals(spark, d):
    """The union over chunks of 100 entities or edges each, and what it counts."""
    held = lambda rows, into, *c: rows.groupBy(F.floor(F.col("ord") / CHUNK_ROWS).alias("chunk")).agg(F.collect_list(F.struct(*c)).alias(into))
    results = held(_E(spark, d), "entities", "id", "type", "name").join(held(_R(spark, d), "relationships", "source", "target", "type"), "chunk", "full")
    entities, relationships, totals = build.raw_union(results)
    by_type = lambda rows, what: rows.groupBy(F.concat(F.lit(what), F.col("type")).alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    counted = totals.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in totals.columns]), F.array(*totals.columns))).alias("metric", "value"))
    return counted.unionByName(by_type(entities, "entity ")).unionByName(by_type(relationships, "relationship "))


def _pure(spark, d):
    return build.pure_graph(_E(spark, d), _R(spark, d), graph.schema_table(spark, SCHEMA), "exact")


def pure_graph_nodes(spark, d):
    return _pure(spark, d).entities.select("id", "name", "type", F.col("merge_count").cast("long").alias("merge_count"))


def pure_graph_edges(spark, d):
    """The simple form of the aligned graph's edges."""
    return _pure(spark, d).simple[1]


def merge_prompts(spark, d):
    return build.merge_items(_named(spark, d))


def _simple(spark, d):
    nodes = graph.simple_nodes(_E(spark, d))
    edges = graph.simple_edges(graph.no_self_loops(_R(spark, d)))
    return nodes, edges


def simple_nodes(spark, d):
    return _simple(spark, d)[0]


def simple_edges(spark, d):
    return _simple(spark, d)[1]


def node_link_nodes(spark, d):
    return _link(spark, d)[0]


def node_link_graph(spark, d):
    return _link(spark, d)[1]


def _link(spark, d):
    nodes = _E(spark, d).select(F.col("id").alias("pkey"), F.col("name").alias("label"), F.lower("type").alias("entity_type"), "ord")
    edges = graph.no_self_loops(_R(spark, d)).select(F.col("source").alias("pkey"), F.col("target").alias("skey"), F.col("type").alias("label"), "ord")
    return graph.node_link(nodes, edges)


def full_graph(spark, d):
    """Counts by kind, and what merged: of edges the sum of confidences in decimals, as sums of doubles change with the partitions and round either way at a half."""
    nodes, edges = graph.full_graph(_E(spark, d), _R(spark, d))
    confidence = F.sum(F.col("confidence").cast("decimal(28,17)"))
    return nodes.groupBy("labels").agg(F.count(F.lit(1)).alias("n"), F.sum("merge_count").cast("long").alias("merged")).select(F.col("labels").alias("kind"), "n", "merged").unionByName(
        edges.groupBy(F.col("type").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.round(confidence, 0).cast("long").alias("merged"))
    )


def graph_node_stats(spark, d):
    return graph.node_stats(simple_nodes(spark, d))


def graph_edge_stats(spark, d):
    return graph.edge_stats(simple_edges(spark, d))


def graph_top_types(spark, d):
    return graph.top_types(graph_node_stats(spark, d), 3)


# -- vectors ------------------------------------------------------------------------------------

K, LEAST, MOST = 5, 0.68, 3


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def _matches(spark, d):
    """Each vector whose id 100 divides, against all; labels as tactics and groups of ids as techniques."""
    rows = _vectors(spark, d)
    found = enrichment.nearest(rows.filter("id % 100 = 0"), rows, K, LEAST, MOST)
    known = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("match_id"), F.concat(F.lit("TA "), F.col("label").cast("string")).alias("tactics"), F.concat(F.lit("T"), (F.col("vec_id") % 37).cast("string")).alias("techniques"),
        F.concat(F.lit("procedure "), F.col("vec_id").cast("string")).alias("procedure"),
    )
    return found.join(known, "match_id")


def knn_topk(spark, d):
    rows = _vectors(spark, d)
    return enrichment.nearest(rows.filter("id % 100 = 0"), rows, K)


def _present(spark):
    return spark.createDataFrame([("tactic", "TA 1"), ("technique", " t5 ")], "entity_type string, label string")


def enriched_nodes(spark, d):
    return enrichment.new_nodes(_present(spark), _matches(spark, d))


def enriched_edges(spark, d):
    return enrichment.new_edges(_matches(spark, d))


def enriched_procedures(spark, d):
    nodes = _vectors(spark, d).filter("id % 100 = 0").select(F.col("id").alias("node_id"), F.lit(1).cast("long").alias("cnt"))
    out = enrichment.counted_procedures(nodes, _matches(spark, d))
    return out.select("node_id", "cnt", F.coalesce(F.array_join(F.transform("similar_procedures", lambda x: x["procedure"]), ";"), F.lit("")).alias("similar"))


def enrichment_stats(spark, d):
    nodes = _vectors(spark, d).filter("id % 100 = 0")
    matches = _matches(spark, d)
    return enrichment.stats(nodes, matches, enrichment.new_nodes(_present(spark), matches), enrichment.new_edges(matches))


def document_to_graph(spark, d):
    """Pages to markdown, chunks, filter, indicators, relationships and the aggregated graph."""
    chunks = quality.filter_chunks(html.page_chunks(table(spark, d, "pages")), least=40).filter("reject_type is null")
    chunks = chunks.select(F.col("page_id").alias("doc_id"), "chunk_id", "content")
    rules = RuleExtractor()
    found = rules.entities(chunks, graph.CHUNK, "content").withColumn("ord", F.lit(0))
    return graph.simple_edges(rules.relationships(found, graph.CHUNK))


_NAMES = [
    entity_type_filter, schema_filtered_edges, dangling_edges, isolated_nodes, connected_nodes, chunk_graph_filter, post_alignment_filter, id_variants, id_remap, unmapped_ids, similar_pairs,
    nation_pairs, acronym_pairs, aligned_entities_closure, aligned_entities_greedy, merged_by_groups, simple_nodes, simple_edges, node_link_nodes, node_link_graph, full_graph, graph_node_stats,
    graph_edge_stats, graph_top_types, knn_topk, enriched_nodes, enriched_edges, enriched_procedures, enrichment_stats, document_to_graph,
    raw_graph_totals, pure_graph_nodes, pure_graph_edges, merge_prompts,
]
QUERIES = {f.__name__: f for f in _NAMES}

_T = ", ".join(f"'{x}'" for x in TYPES)
_OK = "r.type IN ('BELONG', 'USE') AND r.source <> r.target"
_TYPED = f"""typed AS (SELECT r.*, coalesce(a.type, '') AS source_type, coalesce(b.type, '') AS target_type FROM edges r LEFT JOIN {{e}} a ON a.id = r.source LEFT JOIN {{e}} b ON b.id = r.target
  WHERE {{w}}), fit AS (SELECT t.source, t.target, t.type, t.ord FROM typed t SEMI JOIN allowed USING (source_type, target_type, type))"""
_SIMPLE = f"""{_FROM}, sn AS (SELECT id AS pkey, name AS label, lower(type) AS entity_type, 1::BIGINT AS cnt FROM entities),
se AS (SELECT source AS pkey, target AS skey, type AS label, count(*) AS cnt FROM edges WHERE source <> target GROUP BY ALL)"""
_LINKED = f"""{_FROM}, n AS (SELECT id AS pkey, name AS label, lower(type) AS entity_type, ord FROM entities),
l AS (SELECT source AS pkey, target AS skey, type AS label, ord FROM edges WHERE source <> target),
seen AS (SELECT pkey, 0 AS k, ord AS o FROM n UNION ALL SELECT pkey, 1, ord * 2 FROM l UNION ALL SELECT skey, 1, ord * 2 + 1 FROM l),
first AS (SELECT pkey, min(struct_pack(k := k, o := o)) AS f FROM seen GROUP BY pkey),
ids AS (SELECT pkey, row_number() OVER (ORDER BY f.k, f.o, pkey) - 1 AS node_id FROM first)"""
_NAMED = "named AS (SELECT p_brand AS type, p_name AS name, lower(p_name) AS low, min(p_partkey) AS ord FROM part GROUP BY ALL)"


_PURE = f"""{_FROM}, c AS (SELECT type, lower(name) AS low, count(*) AS n, arg_min(name, ord) AS name,
  CASE WHEN count(*) = 1 THEN min(id) ELSE lower(type) || '--' || replace(replace(lower(name), ' ', ''), '-', '') END AS id FROM entities GROUP BY type, lower(name)),
pm AS (SELECT e.id AS old, c.id AS new FROM entities e JOIN c ON c.type = e.type AND c.low = lower(e.name)),
ok AS (SELECT a.new AS source, b.new AS target, r.type FROM edges r JOIN pm a ON a.old = r.source JOIN pm b ON b.old = r.target
  WHERE a.new <> b.new AND EXISTS (SELECT 1 FROM allowed w JOIN c s ON s.type = w.source_type JOIN c t ON t.type = w.target_type WHERE s.id = a.new AND t.id = b.new AND w.type = r.type))"""


def _chars(x: str) -> str:
    return f"list_distinct(string_split({x}, ''))"


def _rule(a: str, b: str, threshold: float) -> str:
    words = lambda x: rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"
    heads = lambda x: f"list_aggregate(list_transform({words(x)}, lambda w: w[1]), 'string_agg', '')"
    short = lambda p, q: f"(len({words(p)}) = 1 AND len({words(q)}) > 1 AND {words(p)}[1] = {heads(q)})"
    like = f"len(list_intersect({_chars(a)}, {_chars(b)})) >= {threshold} * len(list_distinct(list_concat({_chars(a)}, {_chars(b)})))"
    return f"CASE WHEN {a} = {b} THEN 'equal' WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 'contains' WHEN {short(a, b)} OR {short(b, a)} THEN 'acronym' WHEN {like} THEN 'characters' END"


_MAP = """m AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'Supplier--S' || s_suppkey::VARCHAR ELSE 'supplier--' || s_suppkey::VARCHAR END AS old_id, 'group--' || s_nationkey::VARCHAR AS new_id, s_suppkey AS ord FROM supplier)"""
_KNN = """s AS (SELECT q.vec_id AS query_id, r.vec_id AS match_id, r.label, round(list_dot_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) /
    (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_dot_product(r.embedding::DOUBLE[], r.embedding::DOUBLE[]))), 12) AS c
  FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, match_id) AS rk, round((1 + c) / 2, 6) AS score FROM s)"""
_MATCH = f"{_KNN}, mt AS (SELECT query_id, rk, match_id, score, 'TA ' || label AS tactics, 'T' || (match_id % 37) AS techniques FROM ranked WHERE rk <= {MOST} AND score >= {LEAST})"
_SLUG = "regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_.]', '', 'g')"
_KEYS = f"""pk AS (SELECT *, 'tactic--' || {_SLUG.format(x="tactics")} AS ta, 'technique--' || {_SLUG.format(x="techniques")} AS te FROM mt),
ne AS (SELECT DISTINCT a.ta AS pkey, b.te AS skey, 'HAS' AS label, c.confidence FROM pk a JOIN pk b USING (query_id) JOIN (SELECT query_id, max(score) AS confidence FROM mt GROUP BY 1) c USING (query_id)
  UNION SELECT DISTINCT te, 'procedure--' || query_id, 'LAUNCH', c.confidence FROM pk JOIN (SELECT query_id, max(score) AS confidence FROM mt GROUP BY 1) c USING (query_id)),
nn AS (SELECT t || '--' || {_SLUG.format(x="label")} AS pkey, label, t AS entity_type, 1::BIGINT AS cnt FROM (SELECT DISTINCT 'tactic' AS t, tactics AS label FROM mt UNION SELECT DISTINCT 'technique', techniques FROM mt)
  WHERE NOT (t = 'tactic' AND lower(label) = 'ta 1') AND NOT (t = 'technique' AND lower(label) = 't5'))"""

SQL = {
    "entity_type_filter": f"{_FROM} SELECT id, type FROM entities WHERE type IN ({_T})",
    "schema_filtered_edges": f"{_FROM}, {_TYPED.format(e='entities', w=_OK)} SELECT source, target, type, ord FROM fit",
    "dangling_edges": f"{_FROM} SELECT source, target, type, ord FROM edges WHERE source NOT IN (SELECT id FROM entities) OR target NOT IN (SELECT id FROM entities)",
    "isolated_nodes": f"{_FROM} SELECT id, type FROM entities WHERE id NOT IN (SELECT source FROM edges UNION SELECT target FROM edges)",
    "connected_nodes": f"{_FROM} SELECT id, type FROM entities WHERE id IN (SELECT source FROM edges UNION SELECT target FROM edges)",
    "chunk_graph_filter": f"""{_FROM}, en AS (SELECT * FROM entities WHERE type IN ({_T})), {_TYPED.format(e="en", w=_OK)}, en2 AS (SELECT * FROM en WHERE id IN (SELECT source FROM fit UNION SELECT target FROM fit))
      SELECT 'entity' AS kind, type, count(*) AS n FROM en2 GROUP BY 1, 2 UNION ALL SELECT 'relationship', type, count(*) FROM fit GROUP BY 1, 2""",
    "post_alignment_filter": f"""{_FROM}, {_TYPED.format(e="entities", w="r.source <> r.target")}
      SELECT (SELECT count(*) FROM entities WHERE id IN (SELECT source FROM fit UNION SELECT target FROM fit)) AS entities, (SELECT count(*) FROM fit) AS relationships""",
    "id_variants": f"""WITH {_MAP}, p AS (SELECT *, split_part(old_id, '--', 1) AS l, split_part(old_id, '--', 2) AS r FROM m),
      v AS (SELECT old_id AS variant, new_id, 0 AS k, -ord AS o, 0 AS n FROM p UNION ALL SELECT unnest([lower(old_id), upper(old_id), upper(old_id[1]) || lower(substring(old_id, 2)), lower(l) || '--' || lower(r), upper(l) || '--' || upper(r),
        upper(l[1]) || lower(substring(l, 2)) || '--' || r, upper(l[1]) || lower(substring(l, 2)) || '--' || lower(r), upper(l[1]) || lower(substring(l, 2)) || '--' || upper(r)]), new_id, 1, ord, unnest([0, 1, 2, 3, 4, 5, 6, 7]) FROM p)
      SELECT variant, new_id FROM (SELECT *, row_number() OVER (PARTITION BY variant ORDER BY k, o, n) AS rn FROM v) WHERE rn = 1""",
    "id_remap": f"""{_FROM}, {_MAP}, mm AS (SELECT old_id, new_id FROM m UNION ALL SELECT id, id FROM entities WHERE type IN ('Nation', 'Region'))
      SELECT a.new_id AS source, b.new_id AS target, r.type FROM edges r JOIN mm a ON a.old_id = r.source JOIN mm b ON b.old_id = r.target WHERE r.type = 'BELONG'""",
    "unmapped_ids": f"{_FROM}, {_MAP} SELECT id FROM entities WHERE type = 'Supplier' AND id NOT IN (SELECT old_id FROM m)",
    "similar_pairs": f"WITH {_NAMED} SELECT a, b, rule FROM (SELECT x.ord AS a, y.ord AS b, {_rule('x.low', 'y.low', 0.75)} AS rule FROM named x JOIN named y ON x.type = y.type AND x.ord < y.ord) WHERE rule IS NOT NULL",
    "nation_pairs": f"SELECT a, b, rule FROM (SELECT x.k AS a, y.k AS b, {_rule('x.l', 'y.l', 0.75)} AS rule FROM (SELECT n_nationkey::BIGINT AS k, lower(n_name) AS l FROM nation) x JOIN (SELECT n_nationkey::BIGINT AS k, lower(n_name) AS l FROM nation) y ON x.k < y.k) WHERE rule IS NOT NULL",
    "acronym_pairs": "SELECT x.n_nationkey::BIGINT AS a, y.n_nationkey::BIGINT AS b FROM nation x JOIN nation y ON lower(left(x.n_name, 1)) = lower(left(y.n_name, 1))",
    "aligned_entities_closure": f"""WITH RECURSIVE {_NAMED}, p AS (SELECT x.ord AS a, y.ord AS b FROM named x JOIN named y ON x.type = y.type AND x.ord <> y.ord WHERE {_rule("x.low", "y.low", 0.75)} IS NOT NULL),
      reach AS (SELECT ord AS a, ord AS b FROM named UNION SELECT r.a, p.b FROM reach r JOIN p ON p.a = r.b), c AS (SELECT a AS ord, min(b) AS cluster FROM reach GROUP BY a),
      g AS (SELECT n.*, c.cluster, 'd' || (n.ord % 3) AS dsc FROM named n JOIN c USING (ord)), f AS (SELECT cluster, dsc, min(ord) AS o FROM g GROUP BY 1, 2)
      SELECT CASE WHEN w.n = 1 THEN 'part--' || w.o ELSE lower(g.type) || '--' || replace(replace(lower(g.name), ' ', ''), '-', '') END AS id, g.name, w.n AS merge_count, w.d AS description, w.o AS ord FROM (
        SELECT cluster, count(*) AS n, min(ord) AS o, arg_max(ord, length(name) * 1000000000 - ord) AS best, (SELECT string_agg(dsc, '; ' ORDER BY o) FROM f WHERE f.cluster = g.cluster) AS d FROM g GROUP BY cluster) w
      JOIN named g ON g.ord = w.best""",
    "merged_by_groups": """WITH c AS (SELECT r_regionkey AS k, r_name AS name, CASE r_regionkey WHEN 1 THEN 0 WHEN 4 THEN 3 ELSE r_regionkey END AS g FROM region),
      m AS (SELECT g, count(*) AS n, min(k) AS k, arg_max(name, length(name) * 1000 - k) AS name FROM c GROUP BY g)
      SELECT CASE WHEN n = 1 THEN 'region--' || k ELSE 'region--' || replace(replace(lower(name), ' ', ''), '-', '') END AS id, name, n AS merge_count FROM m""",
    "raw_graph_totals": f"""{_FROM}, c AS (SELECT ord // 100 AS c FROM entities UNION SELECT ord // 100 FROM edges)
      SELECT 'total_entities' AS metric, (SELECT count(*) FROM entities) AS value UNION ALL SELECT 'total_relationships', (SELECT count(*) FROM edges) UNION ALL SELECT 'chunks_processed', (SELECT count(*) FROM c)
      UNION ALL SELECT 'entity ' || type, count(*) FROM entities GROUP BY 1 UNION ALL SELECT 'relationship ' || type, count(*) FROM edges GROUP BY 1""",
    "pure_graph_nodes": f"""{_PURE} SELECT id, name, type, n AS merge_count FROM c WHERE id IN (SELECT source FROM ok UNION SELECT target FROM ok)""",
    "pure_graph_edges": f"{_PURE} SELECT source AS pkey, target AS skey, type AS label, count(*) AS cnt FROM ok GROUP BY ALL",
    "merge_prompts": """WITH n AS (SELECT p_brand AS type, p_name AS name, min(p_partkey) AS ord FROM part GROUP BY ALL), i AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY ord) - 1 AS k FROM n)
      SELECT type, count(*) AS n, string_agg(k || '. name: "' || left(name, 50) || '", description: "d' || (ord % 3) || '"', chr(10) ORDER BY k) AS listing FROM i GROUP BY type HAVING count(*) > 1""",
    "simple_nodes": f"{_SIMPLE} SELECT * FROM sn",
    "simple_edges": f"{_SIMPLE} SELECT * FROM se",
    "node_link_nodes": f"{_LINKED} SELECT node_id, coalesce(label, pkey) AS name, label, entity_type FROM ids LEFT JOIN n USING (pkey)",
    "node_link_graph": f"{_LINKED} SELECT a.node_id AS source, b.node_id AS target, l.label AS relation FROM l JOIN ids a ON a.pkey = l.pkey JOIN ids b ON b.pkey = l.skey",
    "full_graph": f"{_FROM} SELECT type AS kind, count(*) AS n, count(*) AS merged FROM entities GROUP BY 1 UNION ALL SELECT type, count(*), round(sum(0.7::DOUBLE), 0)::BIGINT FROM edges GROUP BY 1",
    "graph_node_stats": f"{_SIMPLE} SELECT entity_type AS type, count(DISTINCT label) AS n_unique, sum(cnt)::BIGINT AS n_occurrences FROM sn GROUP BY 1",
    "graph_edge_stats": f"{_SIMPLE} SELECT label AS type, count(*) AS n_unique, sum(cnt)::BIGINT AS n_occurrences FROM se GROUP BY 1",
    "graph_top_types": f"{_SIMPLE} SELECT entity_type AS type, count(DISTINCT label) AS n_unique, sum(cnt)::BIGINT AS n_occurrences FROM sn GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 3",
    "knn_topk": f"WITH {_KNN} SELECT query_id, rk, match_id, score FROM ranked WHERE rk <= {K}",
    "enriched_nodes": f"WITH {_MATCH}, {_KEYS} SELECT * FROM nn",
    "enriched_edges": f"WITH {_MATCH}, {_KEYS} SELECT * FROM ne",
    "enriched_procedures": f"WITH {_MATCH} SELECT v.vec_id AS node_id, 1 + count(mt.match_id) AS cnt, coalesce(string_agg('procedure ' || mt.match_id, ';' ORDER BY mt.rk), '') AS similar FROM embeddings v LEFT JOIN mt ON mt.query_id = v.vec_id WHERE v.vec_id % 100 = 0 GROUP BY 1",
    "enrichment_stats": f"""WITH {_MATCH}, {_KEYS} SELECT 'procedures' AS metric, (SELECT count(*) FROM embeddings WHERE vec_id % 100 = 0) AS value UNION ALL SELECT 'matches', count(*) FROM mt
      UNION ALL SELECT 'procedures_enhanced', count(DISTINCT query_id) FROM mt UNION ALL SELECT 'nodes_added', count(*) FROM nn UNION ALL SELECT 'edges_added', count(*) FROM ne""",
}
