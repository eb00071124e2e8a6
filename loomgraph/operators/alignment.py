"""Alignment of entities that go by several names.

`closure` joins names that are similar, block by block, and merges connected components; it scales and is the
default. `greedy` repeats the order-dependent rule of merging each name with all that are similar to it, one type at
a time. `apply_merge_groups` merges by lists of positions, such as a model answers with.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import char_set, initials, words
from .components import connected_ids

THRESHOLD = 0.75
# Spellings of entity types, tried in this order as prefixes.
TYPE_PREFIXES = [
    ("attack-event", "attackevent"), ("attack-event--", "attackevent"), ("threat-org", "threatorganization"), ("threat-org--", "threatorganization"),
    ("threatorganization", "threatorganization"), ("technique--", "technique"), ("tactic--", "tactic"), ("procedure--", "procedure"),
    ("tool--", "tool"), ("target--", "target"), ("report--", "report"), ("asset--", "asset"),
]


def is_acronym(a: Column, b: Column) -> Column:
    one = (F.size(words(a)) == 1) & (F.size(words(b)) > 1) & (F.lower(F.get(words(a), F.lit(0))) == initials(b))
    other = (F.size(words(b)) == 1) & (F.size(words(a)) > 1) & (F.lower(F.get(words(b), F.lit(0))) == initials(a))
    return F.coalesce(one, F.lit(False)) | F.coalesce(other, F.lit(False))


def likeness(a: Column, b: Column) -> Column:
    """Shared characters of all characters that two names have."""
    every = F.size(F.array_union(char_set(a), char_set(b)))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(char_set(a), char_set(b))), every), F.lit(0.0))


def rule(a: Column, b: Column, threshold: float = THRESHOLD) -> Column:
    """Why two lower-case names are similar: equal, contains, acronym, characters; null if they aren't."""
    contains = F.contains(a, b) | F.contains(b, a)
    return F.when(a == b, "equal").when(contains, "contains").when(is_acronym(a, b), "acronym").when(likeness(a, b) >= threshold, "characters")


def similar_pairs(names: DataFrame, block: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """a, b, rule for names (block, id, name) of one block; ids in order. Equal names meet once beforehand: pass distinct ones."""
    left = names.select(*block, F.col("id").alias("a"), F.lower("name").alias("_x"))
    right = names.select(*block, F.col("id").alias("b"), F.lower("name").alias("_y"))
    pairs = left.join(right, block).filter("a < b") if block else left.join(right, F.col("a") < F.col("b"))
    return pairs.withColumn("rule", rule(F.col("_x"), F.col("_y"), threshold)).filter("rule is not null").select("a", "b", "rule")


def normal_type(kind: Column) -> Column:
    low = F.lower(kind)
    out = low
    for prefix, name in reversed(TYPE_PREFIXES):
        out = F.when(F.startswith(low, F.lit(prefix)), F.concat(F.lit(name), F.substring(low, F.lit(len(prefix) + 1), F.length(low)))).otherwise(out)
    return out


def merged_id(kind: Column, name: Column) -> Column:
    return F.concat(normal_type(kind), F.lit("--"), F.replace(F.replace(F.lower(name), F.lit(" "), F.lit("")), F.lit("-"), F.lit("")))


def merge(entities: DataFrame, cluster: str) -> DataFrame:
    """One entity for each cluster: the longest name (the first of equals), first type, descriptions in order, merge_count, original_names.

    An entity that is alone keeps its id, unless that has no prefix or an unknown one. chunks_info (an array of structs with
    chunk_index), where there is one, is united, the first of each chunk_index in order.
    """
    held = F.sort_array(F.collect_set(F.struct("ord", "description")))
    told = F.array_distinct(F.filter(F.transform(held, lambda x: x["description"]), lambda d: d.isNotNull() & (d != "")))
    more = []
    if "chunks_info" in entities.columns:
        entities = entities.withColumn("_infos", F.when(F.col("chunks_info").isNotNull(), F.struct("ord", "chunks_info")))
        more = [F.sort_array(F.collect_list("_infos")).alias("_infos")]
    out = entities.groupBy(cluster).agg(
        F.max(F.struct(F.length("name").alias("n"), (-F.col("ord")).alias("o"), "name"))["name"].alias("name"),
        F.min(F.struct("ord", "type"))["type"].alias("type"), F.min("ord").alias("ord"), F.array_join(told, "; ").alias("description"),
        F.count(F.lit(1)).alias("merge_count"), F.array_join(F.sort_array(F.collect_set("name")), "; ").alias("original_names"),
        F.min(F.struct("ord", "id"))["id"].alias("_id"), *more,
    )
    if more:
        infos = F.flatten(F.transform("_infos", lambda x: x["chunks_info"]))
        index = F.transform(infos, lambda y: y["chunk_index"])
        first = F.filter(infos, lambda x, k: x["chunk_index"].isNotNull() & (F.array_position(index, x["chunk_index"]) == k + 1))
        out = out.withColumn("chunks_info", first).drop("_infos")
    alone = F.when(F.contains("_id", F.lit("--")) & ~F.startswith("_id", F.lit("unknown--")), F.col("_id"))
    alone = F.coalesce(alone, F.concat(F.lower("type"), F.lit("--"), F.replace(F.lower("name"), F.lit(" "), F.lit(""))))
    return out.withColumn("id", F.when(F.col("merge_count") == 1, alone).otherwise(merged_id(F.col("type"), F.col("name")))).drop("_id")


def closure(entities: DataFrame, block: list[str] | None = None, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Merged entities, and the mapping old_id to new_id. Names that are equal within a type merge before any are compared."""
    block = block or ["type"]
    low = entities.withColumn("_low", F.lower("name"))
    names = low.groupBy(*block, "_low").agg(F.min("ord").alias("id")).withColumnRenamed("_low", "name")
    pairs = similar_pairs(names, block, threshold).select("a", "b")
    groups = connected_ids(pairs)
    placed = low.join(names.select(*block, F.col("name").alias("_low"), F.col("id").alias("_first")), [*block, "_low"])
    placed = placed.join(groups.withColumnsRenamed({"id": "_first", "component": "_group"}), "_first", "left").withColumn("_cluster", F.coalesce("_group", "_first"))
    out = merge(placed, "_cluster")
    mapping = placed.select("_cluster", F.col("id").alias("old_id"), "ord").join(out.select("_cluster", F.col("id").alias("new_id")), "_cluster").drop("_cluster")
    latest = Window.partitionBy("old_id").orderBy(F.col("ord").desc())
    mapping = mapping.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")
    return out.drop("_cluster"), mapping


def _similar(a: str, b: str, threshold: float) -> bool:
    short, long = sorted((a.split(), b.split()), key=len)
    if a == b or a in b or b in a:
        return True
    if len(short) == 1 and len(long) > 1 and short[0] == "".join(w[0] for w in long):
        return True
    every = set(a) | set(b)
    return bool(every) and len(set(a) & set(b)) / len(every) >= threshold


def greedy(entities: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Clusters of the order-dependent rule: `_cluster`, the ord of the entity that opened it, for each entity it took.

    In order, a name not yet taken opens a cluster with every entity of its type whose name is similar, whether that one
    is taken or not; names that it takes are done. A type is one group, so this is for graphs whose types fit a task.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ord")
        low, done, out = [str(n or "").lower() for n in rows["name"]], set(), []
        for at, (name, spelled) in enumerate(zip(low, rows["name"], strict=True)):
            if spelled not in done:
                taken = [k for k, other in enumerate(low) if k == at or _similar(name, other, threshold)]
                done.update(rows["name"].iloc[k] for k in taken)
                out += [rows.iloc[k].tolist() + [int(rows["ord"].iloc[at])] for k in taken]
        return pd.DataFrame(out, columns=[*rows.columns, "_cluster"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entities.schema.fields)
    return entities.groupBy("type").applyInPandas(run, f"{fields}, _cluster long")


def apply_merge_groups(entities: DataFrame, groups: DataFrame) -> DataFrame:
    """_cluster for each entity: groups (type, groups: lists of positions by ord within the type) are taken in order, a group with a
    position that is used already is skipped, positions that don't exist are ignored, and whoever is left stays alone."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("ord").reset_index(drop=True)
        cluster = left["ord"].astype("int64").tolist()
        used: set[int] = set()
        for group in right["groups"].iloc[0] if len(right) else []:
            places = [int(k) for k in group if 0 <= k < len(left)]
            if len(places) >= 2 and not used.intersection(int(k) for k in group):
                used.update(places)
                for k in places:
                    cluster[k] = int(left["ord"].iloc[places[0]])
        return left.assign(_cluster=cluster)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entities.schema.fields)
    return entities.groupBy("type").cogroup(groups.groupBy("type")).applyInPandas(run, f"{fields}, _cluster long")


def unmapped(ids: DataFrame, mapping: DataFrame) -> DataFrame:
    """Ids that the mapping lacks."""
    return ids.join(mapping.select(F.col("old_id").alias("id")), "id", "left_anti")
