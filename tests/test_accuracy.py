"""Scoring join, lead hours and buckets (J1, P17, P18, P22, D4, D14, D15,
D18, D21)."""

import pytest
from pyspark.sql import functions as F

from revcast.functions.timecols import lead_bucket, lead_hours_boundary, lead_hours_exact
from revcast.operators import accuracy as acc
from revcast.operators import silver as sv

from .helpers import forecast, forecasts, observation, observations


@pytest.mark.parametrize(
    "issued,target,exact,boundary,bucket",
    [
        ("2029-05-24 00:00", "2029-05-24 06:00", 6.0, 6, "00-06h"),
        ("2029-05-24 00:30", "2029-05-24 07:00", 6.5, 7, "07-12h"),
        ("2029-05-24 00:00", "2029-05-24 12:00", 12.0, 12, "07-12h"),
        ("2029-05-24 00:00", "2029-05-27 00:00", 72.0, 72, "49-72h"),
        ("2029-05-24 00:00", "2029-05-27 00:30", 72.5, 72, "72h+"),
        ("2029-05-24 00:59", "2029-05-24 01:01", 2 / 60, 1, "00-06h"),
    ],
)
def test_lead_hours_two_definitions(spark, issued, target, exact, boundary, bucket):  # D14
    df = spark.createDataFrame([(issued, target)], "i string, t string").select(
        F.col("i").cast("timestamp_ntz").alias("i"), F.col("t").cast("timestamp_ntz").alias("t")
    )
    r = df.select(
        lead_hours_exact("i", "t").alias("e"),
        lead_hours_boundary("i", "t").alias("b"),
        lead_bucket(lead_hours_exact("i", "t")).alias("k"),
    ).first()
    assert r.e == pytest.approx(exact) and r.b == boundary and r.k == bucket


def test_null_lead_is_last_bucket(spark):  # D15
    r = spark.range(1).select(lead_bucket(F.lit(None).cast("double")).alias("k")).first()
    assert r.k == "72h+"


def _gold(spark, f_rows, o_rows, **kw):
    f = sv.silver(forecasts(spark, f_rows), "forecast")
    o = acc.latest_observations(sv.silver(observations(spark, o_rows), "observation"))
    return acc.gold_rows(f, o, **kw)


def test_name_join_has_one_city_column(spark):  # D4
    g = _gold(spark, [forecast()], [observation()])
    assert g.columns.count("city") == 1 and len(g.columns) == 18
    r = g.first()
    assert r.temperature_error_c == pytest.approx(1.5)
    assert r.temperature_squared_error == pytest.approx(2.25)
    assert r.lead_time_bucket == "25-48h" and str(r.target_date) == "2031-03-03"


def test_two_observing_sources_score_twice_unless_filtered(spark):  # D18
    obs = [observation("o1", source="s1"), observation("o2", source="s2")]
    assert _gold(spark, [forecast()], obs).count() == 2
    assert _gold(spark, [forecast()], obs, observation_source="s2").count() == 1


def test_corrected_hour_scored_once(spark):  # D21
    obs = [
        observation("o1", temp=1.0, ingested="2031-03-03 10:00"),
        observation("o2", temp=3.0, ingested="2031-03-03 12:00"),
    ]
    rows = _gold(spark, [forecast()], obs).collect()
    assert len(rows) == 1 and rows[0].observed_temperature_c == 3.0


def test_summary_measures(spark):  # A1
    f = [forecast("a", temp=-1.0), forecast("b", temp=7.0, issued="2031-03-03 05:00")]
    g = _gold(spark, f, [observation(temp=2.0)])
    s = {r.lead_time_bucket: r for r in acc.summary(g).collect()}
    assert s["25-48h"].temperature_mae_c == pytest.approx(3.0)
    assert s["00-06h"].temperature_bias_c == pytest.approx(5.0)
    from_parts = acc.summary_of_partials(acc.partials(g)).collect()
    assert [tuple(r) for r in from_parts] == [tuple(r) for r in acc.summary(g).collect()]
    cuts = acc.grouping_sets(g).collect()
    assert {r.grouping_level for r in cuts} == {2, 3, 5, 6}


@pytest.mark.parametrize("value", [4e-7, 1e13])
def test_means_round_nothing_and_take_any_size(spark, value):  # A1
    rows = spark.createDataFrame([("x", "b", value)] * 2, "city string, lead_time_bucket string, e double").select(
        "city", "lead_time_bucket", F.col("e").alias("temperature_absolute_error_c"),
        (F.col("e") * F.col("e")).alias("temperature_squared_error"), F.col("e").alias("temperature_error_c"),
    )
    r = acc.summary(rows).first()
    assert r.temperature_mae_c == value and r.temperature_bias_c == value and r.temperature_rmse_c == pytest.approx(value)


def test_signed_changes_add_up_to_the_rows_after(spark):  # D5, K6
    day = [forecast("a", temp=1.0), forecast("b", temp=3.0), forecast("b", temp=3.0)]
    cold, warm = observation("o", temp=0.0), observation("o", temp=2.0)
    before, after = (
        acc.gold_rows(
            forecasts(spark, rows).withColumn("forecast_date", F.to_date("forecast_timestamp")), observations(spark, [seen])
        )
        for rows, seen in ((day, cold), (day[:2], warm))
    )
    feed = acc.changes(before, after)
    assert sorted((r.event_id, r.temperature_error_c, r.change) for r in feed.collect()) == [
        ("a", -1.0, 1), ("a", 1.0, -1), ("b", 1.0, 1), ("b", 3.0, -1), ("b", 3.0, -1)
    ]
    sums = acc.partials(before).unionByName(acc.retractable_partials(feed))
    assert [tuple(r) for r in acc.summary_of_partials(sums).collect()] == [tuple(r) for r in acc.summary(after).collect()]
    assert acc.changes(after, after).isEmpty()
    gone = acc.partials(before).unionByName(acc.retractable_partials(acc.changes(before, after.limit(0))))
    assert acc.summary_of_partials(gone).isEmpty()
