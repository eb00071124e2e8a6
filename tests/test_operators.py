"""Small cases with known results."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from loomgraph.config import Config
from loomgraph.functions import text as tx
from loomgraph.operators import alignment, chunking, enrichment, extraction, graph, html, markdown, quality, series, training
from loomgraph.sources import io


def values(spark, items, column, kind="string"):
    df = spark.createDataFrame([(n, x) for n, x in enumerate(items)], f"n int, x {kind}")
    return [r[0] for r in df.select(column(F.col("x")).alias("y"), "n").orderBy("n").collect()]


def lines(spark, *text):
    return spark.createDataFrame([(1, k, x) for k, x in enumerate(text)], "doc_id long, pos long, line string")


def out(df):
    return [r.line for r in df.orderBy("pos").collect()]


def test_file_types(spark):
    assert values(spark, ["http://a/b.PDF", "http://a/b", "x.htm", "x.docx", "y.pdf"], tx.file_type) == ["pdf", "html", "html", None, "pdf"]


def test_titles(spark):
    assert values(spark, ["Foo Bar - Site", "Chinese-Speaking Users", "Home", "Page 12", "x" * 201], html.clean_title) == ["Foo Bar", "Chinese", None, None, None]


def test_image_names(spark):
    assert values(spark, ["https://x.org/y/pic.png", "https://x.org/y/pic", "https://x.org/svg/pic"], lambda c: tx.image_file_name(c, F.lit(1))) == ["image_001_pic.png", "image_001_pic.jpg", "image_001_pic.svg"]
    assert values(spark, ["/a.png", "b.png", "http://o/c.png"], lambda c: tx.image_url(c, F.lit("http://h/p/q.html"))) == ["http://h/a.png", "http://h/p/b.png", "http://o/c.png"]


def test_setext(spark):
    assert out(markdown.setext_to_atx(lines(spark, "Title", "====", "", "---", "x"))) == ["# Title", "x"]
    assert out(markdown.setext_to_atx(lines(spark, "A", "---", "---", "b"))) == ["## A", "---", "b"]
    assert out(markdown.setext_to_atx(lines(spark, "---", "---", "b"))) == ["## ---", "b"]


@pytest.mark.parametrize(
    "text",
    [
        ["| | |", "| --- | --- |", "| a | b |", "", "| c | d |", "text"], ["| a | b |", "| c | d |"], ["x", "", "", "", "", "y"], ["a", "```", "b", "```", "c", "```", "d"],
        ["Title", "====", "", "---", "x"], ["## 这是一个很长很长很长很长很长很长很长的句子。", "（一）开始", "图1.2 名称", "Table 3. name"], ["a", "", "x", "", "b"], ["## 附录4 参考链接", "gone"],
        ["| a |", "", "", "b", "| c | d |", "| - | - |", "| - | - |", "| e | f |"],
    ],
)
def test_both_forms_of_cleaning_agree(spark, text):
    assert "\n".join(out(markdown.clean_lines(lines(spark, *text)))) == markdown.clean("\n".join(text))


def test_tables(spark):
    assert out(markdown.clean_tables(lines(spark, "| | |", "| --- | --- |", "| a | b |", "", "| c | d |", "text")))[1:] == ["| a | b |", "| c | d |", "text"]
    assert out(markdown.clean_tables(lines(spark, "| a | b |", "| c | d |"))) == ["| a | b |", "|------|------|", "| c | d |"]
    assert out(markdown.collapse_blanks(lines(spark, "a", "", "", "", "", "b"))) == ["a", "", "", "b"]


def test_tokens_and_packing(spark):
    assert values(spark, ["x" * 7, "x" * 8, ""], chunking.tokens) == [1, 2, 0]
    rows = spark.createDataFrame([([30, 30, 30],)], "sizes array<bigint>")
    assert chunking.pack_rows(rows, 100, 10).first().bins == [0, 0, 1]
    assert chunking.pack_rows(rows, 100, 60).first().bins is None


def test_chunks_keep_their_headings():
    text = "# Report\n\n" + "alpha beta. " * 300 + "\n\n## Part\n\n| a | b |\n| --- | --- |\n" + "\n".join(f"| {k} | {'x' * 40} |" for k in range(80)) + "\n\ntail text here\n"
    cut = chunking.chunk(text, most=200, overlap=20)
    assert {c.content_type for c in cut} == {"text", "table"}
    tables = [c.content for c in cut if c.content_type == "table"]
    assert all("| a | b |\n| --- | --- |" in t for t in tables) and sum(t.count("xxxx" * 10) for t in tables) == 80
    assert all("Report" in c.content for c in cut)


def test_scores(spark):
    long = "This is a plain English sentence about nothing " * 7
    got = values(spark, ["x" * 10, "a" * 64, long[:299] + ".", None], lambda c: quality.score(c).cast("int"))
    assert got == [60, 20, 90, None]
    assert values(spark, ["[a](b)\n[c](d)", "plain"], quality.is_navigation) == [True, False]
    assert values(spark, ["Subscribe now. Learn more", "Learn more"], quality.is_marketing) == [True, False]
    assert values(spark, ["| a | b |\n| APT | group |"], lambda c: quality.table_points(c).cast("int")) == [-10]
    assert values(spark, ["attack backdoor control 漏洞"], lambda c: quality.keyword_count(c).cast("int")) == [6]


def test_selection_is_stable(spark):
    docs = spark.createDataFrame([(0, "plain words only here " * 12 + "."), (1, "attack malware threat exploit " * 12 + "."), (2, "plain words only here " * 12 + ".")], "i long, content string")
    got = [r.i for r in quality.select_chunks(docs, "quality", 2, "i").orderBy("rk").collect()]
    assert got == [1, 0]
    assert [r.i for r in quality.select_chunks(docs, "first", 2, "i").orderBy("rk").collect()] == [0, 1]
    assert quality.select_chunks(docs, "random", 2, "i").count() == 2


def test_buckets(spark):
    assert values(spark, ["x" * n for n in (500, 501, 2000, 2001)], quality.length_bucket) == ["0-500", "500-1000", "1000-2000", "2000+"]


def test_pages(spark):
    page = """<html><head><title>A page of note</title></head><body><nav><a href="/x">x</a></nav><article><h1>A page of note</h1>
    <p>One <b>two</b><p>three <a href="/y">link</a><img src="i.png" alt="pic"><a href="z.JPG">download</a><script>var t="</p>";</script>
    <table><tr><td>name</td><td>meaning of the name in words</td></tr><tr><td>key</td><td>a thing that opens other things, long text</td></tr></table></article></body></html>"""
    title, text, images = html.to_markdown(page)
    assert title == "A page of note"
    assert "One **two**" in text and "[link](/y)" in text and "var t" not in text and "[x](/x)" not in text
    assert "| name | meaning of the name in words |\n| --- | --- |" in text
    assert [i[1] for i in images] == ["i.png", "z.JPG"]
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    got = {r.page_id: r.p for r in df.select("page_id", html.markdown_of(F.col("html")).alias("p")).collect()}
    assert got[1].title == title and got[2].markdown is None and got[3].markdown == ""
    assert html.page_chunks(df).filter("page_id = 1").count() >= 1


def test_confidence(spark):
    assert values(spark, ["0.876", "1.2", "abc", None, "1", "0.125"], lambda c: F.coalesce(extraction.confidence(c), F.lit(0.7))) == [0.88, 0.7, 0.7, 0.7, 1.0, 0.12]


def test_merge_groups(spark):
    assert values(spark, ['[[0,1],[2],["3",4],[-1,5]]', "no"], extraction.merge_groups) == [[[0, 1], [3, 4]], None]


@pytest.mark.parametrize(
    ("broken", "fixed"),
    [
        ('```json\n{"a": 1,}\n```', {"a": 1}), ('{"a": "x:\\"y\\"", "b": [1, 2}', {"a": 'x:"y"', "b": [1, 2]}), ('say {"a": {"b": "c"} trailing', {"a": {"b": "c"}}),
        ('{"a": "1" "b": "2"}', {"a": "1", "b": "2"}), ('{"a": "C:\\dir"}', {"a": "C:\\dir"}), ('{"k": "key:value, \\"x\\""}', {"k": 'key:value, "x"'}),
    ],
)
def test_repair(broken, fixed):
    assert json.loads(extraction.repair(broken)) == fixed


def test_repair_gives_up():
    assert extraction.repair("no object") is None


def test_extractors(spark):
    chunks = spark.createDataFrame([(1, 0, "good"), (1, 1, "bad"), (1, 2, " ")], "doc_id long, chunk_id long, prompt string")

    def ask(prompt):
        if prompt == "bad":
            raise ConnectionError("no")  # one that is worth another try
        return '{"entities":[],"relationships":[]}'

    got = {r.chunk_id: (r.status, r.attempts) for r in extraction.CallExtractor(ask, 2).answers(chunks).collect()}
    assert got == {0: ("success", 1), 1: ("failed", 2), 2: ("skipped", 0)}
    recorded = spark.createDataFrame([(1, 0, "{}")], "doc_id long, chunk_id long, response string")
    assert {r.chunk_id: r.status for r in extraction.ReplayExtractor(recorded).answers(chunks).collect()} == {0: "success", 1: "failed", 2: "failed"}
    assert "Tool" in chunks.select(extraction.build_prompt(F.col("prompt"), {"mixed": "keep the language", "short": "short"})).first()[0]


def test_chunk_filter(spark):
    ents = spark.createDataFrame([(1, 1, n, i, t, i) for n, (i, t) in enumerate([("e1", "ThreatOrganization"), ("e2", "AttackEvent"), ("e3", "Foo"), ("e4", "Tool")])], "doc_id int, chunk_id int, ord int, id string, type string, name string")
    rels = [("LAUNCH", "e1", "e2"), ("LAUNCH", "e1", "e1"), ("ATTACK", "e2", "e3"), ("ZZZ", "e1", "e2"), ("USE", "e1", "e2")]
    rels = spark.createDataFrame([(1, 1, n, *r) for n, r in enumerate(rels)], "doc_id int, chunk_id int, ord int, type string, source string, target string")
    types, edge_types = extraction.ENTITY_TYPES, extraction.RELATIONSHIP_TYPES
    nodes, edges = graph.filter_chunks(ents, rels, types, edge_types, graph.schema_table(spark, extraction.SCHEMA))
    assert {r.id for r in nodes.collect()} == {"e1", "e2"} and [r.type for r in edges.collect()] == ["LAUNCH"]
    _, edges = graph.filter_chunks(ents, rels, types, edge_types)
    assert sorted(r.type for r in edges.collect()) == ["LAUNCH", "USE"]


def test_id_variants(spark):
    got = {r.variant: r.new_id for r in graph.id_variants(spark.createDataFrame([("Technique--T1059", "n", 0), ("technique--t1059", "m", 1)], "old_id string, new_id string, ord int")).collect()}
    assert got["technique--t1059"] == "m" and got["Technique--T1059"] == got["TECHNIQUE--T1059"] == got["Technique--t1059"] == "n"


def test_node_link(spark):
    nodes = spark.createDataFrame([("a", "A", "t", 0), ("a", "A2", "t", 1), ("b", "B", "t", 2)], "pkey string, label string, entity_type string, ord int")
    edges = spark.createDataFrame([("a", "c", "R", 0)], "pkey string, skey string, label string, ord int")
    shown, links = graph.node_link(nodes, edges)
    assert sorted((r.node_id, r.name) for r in shown.collect()) == [(0, "A"), (0, "A2"), (1, "B"), (2, "c")]
    assert [tuple(r) for r in links.collect()] == [(0, 2, "R")]


def test_last_write_wins_and_counts(spark):
    ents = spark.createDataFrame([("i", "n", "T", 0, 2), ("i", "n", "T", 1, 1)], "id string, name string, type string, ord int, merge_count int")
    assert [r.cnt for r in graph.simple_nodes(ents).collect()] == [1]
    edge = Row(source="a", target="b", type="R")
    assert [r.cnt for r in graph.simple_edges(spark.createDataFrame([edge] * 3)).collect()] == [3]


def test_similar_names(spark):
    pairs = [("ssh", "secure shell"), ("apt1", "apt10"), ("apt", "advanced persistent threat"), ("listen", "silent"), ("192.168.1.1", "192.168.1.2")]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    assert [r[0] for r in df.select(alignment.rule(F.col("a"), F.col("b"))).collect()] == [None, "contains", "acronym", "characters", "characters"]


def test_merging(spark):
    ents = spark.createDataFrame([("Tool", "AB-C d", 0, "x", "d1"), ("Tool", "ab", 1, "y", "d2"), ("Tool", "zq", 2, "z", None)], "type string, name string, ord int, id string, description string")
    merged, mapping = alignment.closure(ents)
    got = {r.name: (r.id, r.merge_count, r.description) for r in merged.collect()}
    assert got == {"AB-C d": ("tool--abcd", 2, "d1; d2"), "zq": ("tool--zq", 1, "")}
    assert {r.old_id: r.new_id for r in mapping.collect()} == {"x": "tool--abcd", "y": "tool--abcd", "z": "tool--zq"}
    greedy = alignment.greedy(ents.withColumn("ord", F.col("ord").cast("long")))
    assert {r.name: r._cluster for r in greedy.collect()} == {"AB-C d": 0, "ab": 0, "zq": 2}
    groups = spark.createDataFrame([("Tool", [[0, 2], [1, 2]])], "type string, groups array<array<int>>")
    assert {r.name: r._cluster for r in alignment.apply_merge_groups(ents, groups).collect()} == {"AB-C d": 0, "zq": 0, "ab": 1}


def test_long_chains_connect(spark):
    from loomgraph.operators.components import connected_ids

    pairs = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.component for r in connected_ids(pairs).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_enrichment_edges(spark):
    m = spark.createDataFrame([(7, 1, "A", "X", 0.9), (7, 2, "B", "Y", 0.8)], "query_id long, rk long, tactics string, techniques string, score double")
    got = sorted((r.pkey, r.skey, r.label) for r in enrichment.new_edges(m).collect())
    assert got == [("tactic--a", "technique--x", "HAS"), ("tactic--a", "technique--y", "HAS"), ("tactic--b", "technique--x", "HAS"), ("tactic--b", "technique--y", "HAS"), ("technique--x", "procedure--7", "LAUNCH"), ("technique--y", "procedure--7", "LAUNCH")]


def test_nearest_handles_nulls_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(enrichment, "QUERY_BLOCK", 2)
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0]), (3, None), (4, [1.0, 0.0])], "id long, embedding array<float>")
    got = {(r.query_id, r.rk): r.match_id for r in enrichment.nearest(rows.filter("id < 4"), rows, 1).collect()}
    assert got == {(0, 1): 4, (1, 1): 0, (2, 1): 1}
    assert enrichment.nearest(rows.filter("id > 9"), rows, 1).count() == 0


def test_qa_summary(spark):
    pair = "array<struct<type:string,confidence:double>>"
    rows = [("success", [("factual", 0.8), ("analytical", 0.9)]), ("skipped", None), ("failed", None)]
    got = training.qa_summary(spark.createDataFrame(rows, f"status string, qa_pairs {pair}")).first()
    assert (got.total, got.success, got.failed, got.pairs, got.avg_per_chunk, got.avg_confidence, got.success_rate) == (3, 1, 2, 2, 2.0, 0.85, 33.33)


def test_first_replacement_only(spark):
    assert values(spark, ["a b a", "c"], lambda c: training.first_replaced(c, F.lit("a"), F.lit("x"))) == ["x b a", "c"]


def test_upsert(spark):
    old = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, count int")
    new = spark.createDataFrame([("d2", 5), ("d3", 3)], "day string, count int")
    assert sorted(tuple(r) for r in series.upsert(old, new, "day").collect()) == [("d1", 1), ("d2", 5), ("d3", 3)]


def test_vector_table_inserts_once(spark, tmp_path):
    held = io.VectorTable(spark, f"file://{tmp_path}/v")
    held.create()
    rows = spark.createDataFrame([("a", [1.0], "p", "t", "q"), ("b", [2.0], "p2", "t", "q"), ("a", [1.0], "p", "t", "q")], io.VectorTable.SCHEMA)
    assert held.insert(rows) == 2 and held.insert(rows) == 0


def test_csv_and_chunk_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text('tactics,techniques,procedure,x\nA,B,"do, it",1\nA,,,2\n')
    got = [tuple(r) for r in io.read_known_procedures(spark, str(tmp_path / "t.csv")).collect()]
    assert got == [("A", "B", "do, it")]
    io.save_json({"selected_chunks": [{"content": "c", "metadata": {"chunk_id": 3}, "length": 1}, {"content": "d", "metadata": {"chunk_id": 4}, "length": 1}]}, str(tmp_path / "c.json"))
    assert [r.content for r in io.read_chunk_file(spark, str(tmp_path / "c.json"), ["4"]).collect()] == ["d"]


def test_converters(spark):
    files = spark.createDataFrame([("a.html", "html", "<h1>Some title here</h1>"), ("b.xyz", None, "x")], "url string, file_type string, html string")
    got = {r.url: r.page for r in io.Converters().convert(files).collect()}
    assert got["a.html"].title == "Some title here" and got["b.xyz"].error == "no converter"


def test_config(tmp_path):
    c = Config({"a": {"b": 1}, "t": "None"})
    assert c.get("a.b") == 1 and c.get("a.x", 5) == 5 and c.get("t", 2) == 2 and c.updated("q.r", 3).get("q.r") == 3
    assert len(Config({"openai": {"timeout": 5}, "chunk_splitter": {"max_chunk_size": 100}}).problems()) == 3
    c.save(str(tmp_path / "c.json"))
    assert Config.load(str(tmp_path / "c.json")).values == c.values


def test_streaming(spark, tmp_path):
    from loomgraph.streaming import jobs

    spark.createDataFrame([(1, "attack " * 40), (2, "short")], "doc_id long, text string").write.parquet(f"{tmp_path}/in")
    for run in range(2):
        stream = jobs.scored_documents(jobs.document_stream(spark, f"{tmp_path}/in"))
        jobs.append_new(stream, f"{tmp_path}/out", f"{tmp_path}/ck{run}").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_plans_push_filters_and_prune(spark):
    plan = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").filter("l_orderkey > 5").select("l_partkey")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey), GreaterThan(l_orderkey,5)]" in plan and "l_comment" not in plan


def test_retry_policy(spark):
    """Errors that may pass are tried again after 1, 2, 4 ... seconds; bad requests twice, refused content and others not at all."""
    from loomgraph.operators import extraction

    E = extraction.CallError
    assert [extraction.retries(E("bad_request"), k) for k in range(3)] == [True, True, False]
    assert not extraction.retries(E("bad_request", "data_inspection_failed"), 0) and not extraction.retries(ValueError("x"), 0)
    assert all(extraction.retries(e, 9) for e in (E("rate_limit"), E("server"), TimeoutError(), ConnectionError(), ValueError("read timeout")))
    assert [extraction.delay(k) for k in (0, 1, 2, 5, 6, 50)] == [1, 2, 4, 32, 60, 60]

    def ask(prompt):
        raise extraction.CallError(prompt)

    chunks = spark.createDataFrame([(1, k, p) for k, p in enumerate(["rate_limit", "bad_request", "other"])], "doc_id long, chunk_id long, prompt string")
    got = {r.chunk_id: r.attempts for r in extraction.CallExtractor(ask, 5, wait=lambda s: None).answers(chunks).collect()}
    assert got == {0: 5, 1: 3, 2: 1}


def test_alignment_strategies(spark):
    """Groups where a model gave some, else similar names; single ones keep their ids unless these have no prefix; chunk infos unite."""
    from loomgraph.operators import build

    info = lambda *k: [(x,) for x in k]
    rows = [("tool--a", "Tool", "Alpha", "x", 0, info(1, 2)), ("t2", "Tool", "alpha", "y", 1, info(2, 3)), ("b", "Tool", "Be ta", None, 2, None), ("unknown--c", "Target", "C", None, 3, info(5)), ("org--d", "Org", "D", None, 4, [])]
    df = spark.createDataFrame(rows, "id string, type string, name string, description string, ord long, chunks_info array<struct<chunk_index:int>>")
    for strategy in ("exact", "closure", "greedy"):
        out, mapping = build.align(df, strategy)
        got = {r.id: (r.name, r.merge_count, [x.chunk_index for x in r.chunks_info]) for r in out.collect()}
        assert got == {"tool--alpha": ("Alpha", 2, [1, 2, 3]), "tool--beta": ("Be ta", 1, []), "target--c": ("C", 1, [5]), "org--d": ("D", 1, [])}, strategy
        assert {r.old_id: r.new_id for r in mapping.collect()} == {"tool--a": "tool--alpha", "t2": "tool--alpha", "b": "tool--beta", "unknown--c": "target--c", "org--d": "org--d"}
    groups = spark.createDataFrame([("Tool", [[0, 2]])], "type string, groups array<array<int>>")
    assert sorted(r.merge_count for r in build.align(df, groups=groups)[0].collect()) == [1, 1, 1, 2]
    assert {r.id for r in build.align(df, "none")[0].collect()} == {r[0] for r in rows}
    listed = {r.type: r.listing for r in build.merge_items(df).collect()}
    assert listed == {"Tool": '0. name: "Alpha", description: "x"\n1. name: "alpha", description: "y"\n2. name: "Be ta", description: ""'}
    edges = spark.createDataFrame([("TOOL--A", "unknown--c", "USE"), ("t2", "tool--a", "USE"), ("t2", "gone", "USE")], "source string, target string, type string")
    out = build.pure_graph(df, edges, strategy="exact")
    assert [(r.pkey, r.skey, r.cnt) for r in out.simple[1].collect()] == [("tool--alpha", "target--c", 1)]
    assert {r.id for r in out.full[0].collect()} == {"tool--alpha", "target--c"}
    results = spark.createDataFrame([([("e",)], [("r",), ("q",)]), (None, None)], "entities array<struct<id:string>>, relationships array<struct<id:string>>")
    assert tuple(build.raw_union(results)[2].first()) == (1, 2, 2)
