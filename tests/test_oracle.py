"""Every registered query of the engine against its DuckDB oracle on sf0.001
(``python tests/oracle_harness.py DIR`` runs them elsewhere), plus the driver
smoke entry."""

import functools

import pytest

import __spark_entry__ as entry
from revcast.plans import catalog, oracle

from .conftest import SF_SMALL
from .oracle_harness import compare


def test_every_query_has_an_oracle():
    assert set(oracle.ORACLE) == set(catalog.QUERIES)


def test_the_oracle_takes_nothing_from_the_engine():
    import ast
    import inspect

    tree = ast.parse(inspect.getsource(oracle))
    imported = [n for n in ast.walk(tree) if isinstance(n, (ast.Import, ast.ImportFrom))]
    assert [getattr(n, "module", None) for n in imported] == ["__future__"]


@pytest.fixture(scope="module", autouse=True)
def shared_lakes():
    """Queries that only read one and the same lake share it here."""
    patch = pytest.MonkeyPatch()
    for name in ("_two_batches", "_day_of_batches", "_bronze_flow", "_observation_deltas", "_corrected"):
        patch.setattr(catalog, name, functools.cache(getattr(catalog, name)))
    yield
    patch.undo()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_oracle(spark, name):
    """Same rows; and no Python and no pair join in the plan that ran."""
    res = compare(spark, name, SF_SMALL)
    plan = res.pop("plan")
    assert res["status"] == "ok", res
    for node in ("EvalPython", "PythonUDF", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    assert res["oracle_rows"] or name.startswith("dq_") and not name.endswith("_unmerged"), "an empty result shows nothing"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 24 and df.columns[:2] == ["city", "lead_time_bucket"]
