"""All registered queries against their SQL, and properties of their plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from perplexis.plans.oracle import GIVEN
from perplexis.plans.registry import QUERIES, tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(frame):
    frame = frame[sorted(frame.columns)]
    plain = frame.astype(object).where(frame.notna(), None)
    return sorted(map(repr, plain.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    theirs = duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert {c: str(ours[c].dtype) for c in ours} == {c: str(theirs[c].dtype) for c in ours}
    assert comparable(ours) == comparable(theirs)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pair_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text


def test_flagship_plan(spark):
    text = plan(QUERIES["doc_scores"](spark, FOLDER))
    # Neighbours come off the arrays; positions are pruned away.
    assert "Window" not in text and "pos#" not in text.replace("posexplode", "")
    assert "BroadcastHashJoin" in text


def test_scan_reads_only_what_is_used(spark):
    shared = tables(spark, FOLDER)
    text = plan(shared.read("documents").select("doc_id", "text"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    gaps = plan(QUERIES["find_missing"](spark, FOLDER))
    assert "n_chars" not in gaps


def test_preview_ranks_before_the_shuffle(spark):
    text = plan(QUERIES["missing_preview"](spark, FOLDER))
    partial = text.index("Partial", text.index("WindowGroupLimit"))
    assert "Exchange" in text[:partial] and "Scan" in text[partial:]


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "src", "doc_id", "turn", "n_tokens", "ppl", "x_ppl", "score"
    ]
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


def test_what_is_absent_is_told_from_what_is_broken(tmp_path, monkeypatch):
    """A folder left over with compiled files only counts as absent; a module that is there counts, whatever is in it."""
    os.makedirs(tmp_path / "left" / "__pycache__")
    (tmp_path / "left" / "__pycache__" / "queries.cpython-313.pyc").write_bytes(b"old")
    os.makedirs(tmp_path / "broken")
    (tmp_path / "broken" / "queries.py").write_text("import nothing_of_this_name")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert not entry_points._present("left.queries") and not entry_points._present("never.queries")
    assert entry_points._present("broken.queries") and entry_points._present("perplexis.plans.registry")
