"""Every registered query of the engine against its SQL; those without SQL run and have rows."""

import pytest

from loomgraph.plans import registry

from .compare import TABLES, connection, same

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    same(spark, con, QUERIES[name], SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    out = QUERIES[name](spark, SF)
    assert out.columns
    assert name in ("document_to_graph",) or out.count() > 0


def test_entry_point_lists_every_query():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["lone_characters", "caption_filter", "heading_demote", "fence_removal", "blank_collapse", "last_section", "table_separator_clean", "setext_headings"])
def test_line_rules_change_something(spark, name):
    """The inputs hold what each rule looks for, so that returning them unchanged would fail."""
    from loomgraph.plans import tables

    lines = tables.marked_lines(spark, SF)
    assert QUERIES[name](spark, SF).select("doc_id", "line").exceptAll(lines.select("doc_id", "line")).count() + lines.select("doc_id", "line").exceptAll(QUERIES[name](spark, SF).select("doc_id", "line")).count() > 20


@pytest.mark.parametrize("n", [15, 25])
def test_full_graph_rounds_a_half_up(spark, con, tmp_path, n):
    """15 times 0.7 is 10.5; a sum of doubles may end just below."""
    for t in TABLES:
        con.sql(f"copy (select * from {t} limit {n if t == 'nation' else 1 if t == 'region' else 0}) to '{tmp_path}/{t}.parquet'")
    found = {r.kind: (r.n, r.merged) for r in QUERIES["full_graph"](spark, str(tmp_path)).collect()}
    assert found["BELONG"] == (n, (7 * n + 5) // 10)
    same(spark, connection(tmp_path), QUERIES["full_graph"], SQL["full_graph"], tmp_path)
