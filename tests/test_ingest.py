"""Payload explode, event split, ids, serialisation, decoding, city config
(P1-P10, F10, D11, D13, S5, S8, K7, K8)."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from revcast import schemas
from revcast.functions.ids import canonical_json, event_id
from revcast.operators import ingest
from revcast.sources import cities

from .helpers import FORECAST, OBSERVATION, forecast, forecasts, observation, observations

NULLABLE = dict(prob=None, wind=None)


def ids(spark, rows, kind="forecast"):
    frame = (forecasts if kind == "forecast" else observations)(spark, rows)
    return [r[0] for r in frame.select(event_id(kind)).collect()]


@pytest.mark.parametrize(
    "kind,make,schema", [("forecast", forecast, FORECAST), ("observation", observation, OBSERVATION)]
)
def test_id_is_the_hash_of_sorted_compact_json(spark, kind, make, schema):  # P6, P7, D11
    import hashlib

    from revcast.functions.ids import IDENTITY

    for row in (make(), make(temp=None), make(city='Zürich "old"')):
        frame = spark.createDataFrame([row], schema)
        own = dict(zip(schema.names, row))
        event = {k: own[k].isoformat() + "+00:00" if isinstance(own[k], dt.datetime) else own[k] for k in IDENTITY[kind]}
        text = json.dumps(event, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert frame.select(canonical_json(kind)).first()[0] == text
        assert frame.select(event_id(kind)).first()[0] == hashlib.sha256(text.encode()).hexdigest()


def test_redelivery_keeps_the_id_and_a_correction_changes_it(spark):
    first, again, moved, warmer, unknown = ids(
        spark,
        [forecast(), forecast("other", ingested="2031-03-09 00:00"), forecast(lat=0.0), forecast(temp=4.5), forecast(**NULLABLE)],
    )
    assert first == again == moved and len({first, warmer, unknown}) == 3
    o, wet = ids(spark, [observation(), observation(precip=None)], "observation")
    assert o != wet and o != first


def test_another_type_fails_or_gets_no_id(spark):  # P8
    mixed = forecasts(spark, [forecast()]).withColumn("event_type", F.lit("radar")).withColumns(
        {"observation_timestamp": F.lit(None).cast("timestamp_ntz"), "precipitation_mm": F.lit(None).cast("double")}
    )
    assert ingest.with_event_id(mixed, strict=False).first()["event_id"] is None
    for plan in (lambda: ingest.with_event_id(mixed).select("event_id"), lambda: mixed.select(event_id("radar"))):
        with pytest.raises(Exception, match="no identity fields for event type radar"):
            plan().collect()


def test_arrays_of_any_length_become_rows(spark):  # P1, P2
    hours = [f"2031-03-02T0{h}:00" for h in range(4)]
    hourly = {
        "time": hours, "temperature_2m": [1.0], "precipitation_probability": None,
        "precipitation": [], "wind_speed_10m": [5.0, None, 7.0, 8.0, 9.0],
    }
    payload = spark.createDataFrame([("Quito", -0.25, -78.5, hourly)], schemas.HOURLY_PAYLOAD).withColumn(
        "issued_at", F.lit("2031-03-02T02:00").cast("timestamp_ntz")
    )
    rows = ingest.explode_hourly(payload, ["city", "issued_at"]).orderBy("pos")
    got = [(r.pos, r.event_ts.hour, r.temperature_2m_c, r.precipitation_probability_pct, r.precipitation_mm, r.wind_speed_10m_kmh) for r in rows.collect()]
    assert got == [(0, 0, 1.0, None, None, 5.0), (1, 1, None, None, None, None), (2, 2, None, None, None, 7.0), (3, 3, None, None, None, 8.0)]
    split = ingest.split_events(rows.withColumn("source", F.lit("s")))  # P3: from the issue hour on a forecast
    assert sorted((r.event_type, (r.forecast_timestamp or r.observation_timestamp).hour) for r in split.collect()) == [
        ("forecast", 2), ("forecast", 3), ("observation", 0), ("observation", 1),
    ]


def test_issue_hour_is_cut(spark):  # P4
    df = spark.createDataFrame([(dt.datetime(2031, 3, 2, 6, 59, 59, 999999),)], "at timestamp_ntz")
    assert df.select(ingest.issue_hour("at")).first()[0] == dt.datetime(2031, 3, 2, 6)


# --- records --------------------------------------------------------------------


def packed(text: str) -> str:
    return base64.b64encode(text.encode()).decode()


def event(**change) -> str:
    return json.dumps({"event_type": "observation", "event_id": "k9", "ingested_at": "2031-12-31T23:30:00-01:00"} | change)


def decoded(spark, *values):
    rows = [(str(i), "Oslo", v) for i, v in enumerate(values)]
    return ingest.decode_records(spark.createDataFrame(rows, schemas.STREAM_RECORD))


def test_each_failure_has_its_reason(spark):  # F10, R2s
    bad = {
        "bad_base64": ["*not base64*"],
        "bad_json": [packed(t) for t in ("", "{", "[1]", "7", '"text"', event()[:-3])],
        "unsupported_event_type": [packed(event(event_type=x)) for x in ("radar", None, 5)],
        "bad_ingested_at": [packed(event(ingested_at=x)) for x in ("soon", None, "")],
    }
    for reason, values in bad.items():
        dead = ingest.dead_letter(decoded(spark, *values)).collect()
        assert [r.error for r in dead] == [reason] * len(values), reason
        assert [r.value for r in dead] == values
    unnamed = spark.createDataFrame([(None, "Oslo", "*"), (None, "Oslo", "*")], schemas.STREAM_RECORD)
    named = [r.record_id for r in ingest.dead_letter(ingest.decode_records(unnamed)).collect()]
    assert len(set(named)) == 2 and all(len(x) == 36 for x in named)


def test_good_records_keep_their_text_and_get_utc_partitions(spark):  # P9, P10, D13, K1
    texts = [event(), "\n  " + event(extra={"deep": [1]}, temperature_2m_c="mild"), event(ingested_at="2032-01-01T00:30:00Z")]
    rows = ingest.bronze_rows(decoded(spark, *map(packed, texts))).collect()
    assert {(r.event_type, r.year, r.month, r.day, r.hour) for r in rows} == {("observation", "2032", "01", "01", "00")}
    assert [json.loads(r.value) for r in rows] == [json.loads(t) for t in texts]
    assert all("\n" not in r.value for r in rows)


def test_lines_are_compact_and_keyed_by_city(spark):  # K7, K8
    df = forecasts(spark, [forecast(city="Quito", prob=None)])
    record = ingest.to_records(df, ["city", "precipitation_probability_pct", "issued_at"]).first()
    assert record.key == "Quito"
    assert record.value == '{"city":"Quito","precipitation_probability_pct":null,"issued_at":"2031-03-02T06:00:00.000000"}'
    assert ingest.to_lines(df, ["city"]).first().value == '{"city":"Quito"}'


def test_city_list_needs_every_field(spark, tmp_path):  # S5, Q12
    full = {"city": "Quito", "latitude": -0.25, "longitude": -78.5, "timezone": "Etc/GMT+5"}
    root = str(tmp_path / "cities")
    cities.write_cities(spark.createDataFrame([tuple(full.values()), ("Oslo", 59.5, 10.5, "Etc/GMT-1")], schemas.CITY_CONFIG), root)
    assert sorted(r.city for r in cities.load_cities(spark, root).collect()) == ["Oslo", "Quito"]
    for left_out in (["latitude"], ["timezone", "city"]):
        part = tmp_path / f"{left_out[0]}.json"
        part.write_text(json.dumps([full, {k: v for k, v in full.items() if k not in left_out}]))
        with pytest.raises(Exception) as err:
            cities.load_cities(spark, str(part)).collect()
        assert f"incomplete city entry, without [{', '.join(sorted(left_out))}]" in str(err.value)
