"""The pipeline's stages, each against brute force on its own input."""

from fractions import Fraction

import corpus_pipeline
from loomgraph.llm import decontaminate, jaccard_join

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SF).cache())
    assert all(k.columns == columns for k in kept[:-1])
    raw, good, clean, single, safe, pieces = ([r.asDict() for r in k.collect()] for k in kept)
    ids = lambda rows: {r["doc_id"] for r in rows}
    assert ids(good) < ids(raw) and ids(clean) == ids(good)
    assert ids(single) == {d for d, _, c in jaccard_join.brute_force([(r["doc_id"], r["text"]) for r in clean], 5, Fraction(4, 5)) if d == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids(safe) == {r[0] for r in decontaminate.brute_force([(r["doc_id"], r["text"]) for r in single], items) if not r[5]}
    assert ids(pieces) == ids(safe) and all(r["round_trip"] and len(r["ids"]) == r["n_pieces"] for r in pieces)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_pieces", "round_trip"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
