"""Physical-plan properties and partition independence."""

import pytest

import __spark_entry__ as entry
from revcast.plans import inputs as I

from .conftest import SF_SMALL

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final(df) -> str:
    """The plan that ran, after adaptive execution."""
    df.collect()
    return _plan(df)


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(I.raw(spark, SF_SMALL, "forecast"))
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,view))" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan


@pytest.mark.parametrize("kind", ["forecast", "observation"])
def test_what_rules_look_at_is_worked_out_once(spark, kind):
    plan = I.valid(spark, SF_SMALL, kind)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") == 1


def test_dimension_rows_meet_in_a_hash_aggregate(spark):  # U3
    plan = _final(entry.queries()["dim_city"](spark, SF_SMALL))
    # the only sorting aggregate sees one row per city and position
    assert plan.count("HashAggregate(keys=[city") >= 2


def test_grouping_sets_take_one_pass(spark):  # A4
    plan = _plan(entry.queries()["accuracy_grouping_sets"](spark, SF_SMALL))
    assert plan.count("Expand") == 1


@pytest.mark.parametrize("name", ["gold_accuracy_summary", "scd2_revisions", "scd2_hot_key"])
def test_results_do_not_depend_on_partitioning(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(str(tuple(r)) for r in entry.queries()[name](spark, SF_SMALL).collect()))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
