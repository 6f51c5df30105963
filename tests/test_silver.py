"""Validation, routing and dedup."""

import json

import pytest

from revcast import schemas
from revcast.operators import silver as sv

from .helpers import forecast, forecasts, observation, observations


def routed(spark, rows, kind="forecast"):
    frame = (forecasts if kind == "forecast" else observations)(spark, rows)
    good, bad = sv.split_valid(sv.normalize(frame, kind), kind)
    return sorted(r.event_id for r in good.collect()), {r.event_id: r.failed_rules for r in bad.collect()}


@pytest.mark.parametrize(
    "change,rule",
    [
        ({"temp": None}, "temperature_in_range"),  # D6: NULL fails, it doesn't vanish
        ({"temp": 70.0001}, "temperature_in_range"),
        ({"temp": -100.5}, "temperature_in_range"),
        ({"prob": -0.1}, "precipitation_probability_in_range"),
        ({"prob": 101.0}, "precipitation_probability_in_range"),
        ({"city": None}, "city_present"),
        ({"event_id": None}, "event_id_present"),
        ({"target": "2031-03-02 05:59"}, "target_not_before_issue"),
    ],
)
def test_one_broken_rule_is_named(spark, change, rule):  # F1, Q1-Q4, Q11
    good, bad = routed(spark, [forecast(**change), forecast("fine")])
    assert good == ["fine"] and list(bad.values()) == [[rule]]


@pytest.mark.parametrize(
    "change", [{"temp": 70.0}, {"temp": -100.0}, {"prob": None}, {"prob": 0.0}, {"prob": 100.0}, {"target": "2031-03-02 06:00"}]
)
def test_bounds_are_inclusive(spark, change):
    assert routed(spark, [forecast(**change)])[0] == ["f1"]


def test_observation_rules_and_several_at_once(spark):  # F2
    good, bad = routed(spark, [observation("a"), observation("b", temp=None, city=None)], "observation")
    assert good == ["a"] and bad == {"b": ["city_present", "temperature_in_range"]}


def test_landed_text_is_parsed_trimmed_or_marked(spark, tmp_path):  # D3, P11-P13
    def line(event_id, **change):
        event = {
            "event_id": event_id, "event_type": "forecast", "source": "  NORTH", "city": "Oslo ", "temperature_2m_c": -3.5,
            "issued_at": "2031-03-02T07:00:00+01:00", "forecast_timestamp": "2031-03-02T12:00:00Z",
            "ingested_at": "2031-03-02T06:30:00Z",
        }
        return json.dumps(event | change)

    rows = [line("ok"), line("time", issued_at="yesterday"), line("typed", temperature_2m_c="cold"), '{"event_id": "cut']
    (tmp_path / "day.json").write_text("\n".join(rows))
    raw = spark.read.schema(schemas.with_corrupt(schemas.BRONZE_FORECAST)).json(str(tmp_path / "day.json"))
    good, bad = sv.split_valid(sv.normalize(raw, "forecast"), "forecast")
    (ok,) = good.collect()
    assert (ok.event_id, ok.source, ok.city, ok.issued_at.hour, str(ok.forecast_date)) == ("ok", "north", "Oslo", 6, "2031-03-02")
    reasons = {r.event_id: r.failed_rules for r in bad.collect()}
    assert reasons["time"] == ["issued_at_parses", "target_not_before_issue"]
    assert reasons["typed"][0] == "malformed_record" and any("malformed_record" in r for r in reasons.values())
    assert good.count() + bad.count() == len(rows)


def test_dedup_keeps_the_last_sighting_then_the_greatest_place(spark):  # W1, D20
    rows = [
        forecast("x", ingested="2031-03-02 09:00", lat=1.0), forecast("x", ingested="2031-03-02 08:00", lat=9.0),
        forecast("y", lat=3.0), forecast("y", lat=4.0), forecast("y", lat=4.0), forecast("z"),
    ]
    once = sv.dedup(forecasts(spark, rows))
    assert {r.event_id: r.latitude for r in once.collect()} == {"x": 1.0, "y": 4.0, "z": 59.5}
    assert sorted(map(tuple, sv.dedup(once).collect())) == sorted(map(tuple, once.collect()))


def test_counts_add_up(spark):  # A8, D7
    rows = [forecast("p"), forecast("p"), forecast("q"), forecast("r", temp=99.0)]
    m = sv.metrics(forecasts(spark, rows), "forecast").first()
    assert (m.input_count, m.valid_count, m.invalid_count, m.deduplicated_count) == (4, 3, 1, 2)
