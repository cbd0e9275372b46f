"""Every core query against its SQL on the smallest tables."""

import harness
import pytest

from lakeloom import queries as core

SQL = core.oracle_sql()
#: Queries without rows on the smallest tables.
EMPTY = {"fetch_fanout", "merge_conflicts"}


@pytest.fixture(scope="module")
def con(sf):
    return harness.connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf, con, name):
    want = con.sql(SQL[name]).df()
    assert not harness.differences(core.queries()[name](spark, sf).toPandas(), want)
    assert len(want) or name in EMPTY


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(SQL)))
def test_runs_without_sql(spark, sf, name):
    """Rows without a null key; the operators' results are in the other tests."""
    rows = core.queries()[name](spark, sf).toPandas()
    assert len(rows) and rows.iloc[:, 0].notna().all()


def test_keys_of_urls_are_those_of_the_task_table(spark, sf):
    from pyspark.sql import functions as F

    from lakeloom.functions import columns as C
    from lakeloom.session import table

    tasks = table(spark, sf, "crawl_tasks").filter("normalized_url is not null")
    assert tasks.filter(~C.task_url(F.col("url")).eqNullSafe(F.col("normalized_url"))).count() == 0
    assert tasks.filter(~F.sha2(C.task_url(F.col("url")), 256).eqNullSafe(F.col("fetch_key"))).count() == 0


def test_package_without_the_text_subpackage():
    """Nothing outside the subpackage imports it."""
    import ast
    from pathlib import Path

    root = Path(core.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" in p.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(".llm" in n for n in names), p
