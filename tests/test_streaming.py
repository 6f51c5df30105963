"""Structured Streaming paths (R1s-R6s, SURVEY §5.4)."""

import base64
import json

from pyspark.sql import functions as F

from revcast import schemas
from revcast.operators import silver as sv
from revcast.operators import warehouse as wh
from revcast.plans import jobs
from revcast.plans import storage as st
from revcast.session import scratch_path
from revcast.sources import fixtures
from revcast.streaming import bronze, merge

from .helpers import forecast, forecasts


def record(n: int, **change) -> tuple:
    event = {"event_type": "forecast", "event_id": f"e{n}", "city": "Quito", "ingested_at": f"2031-03-0{n}T01:00:00Z"}
    return (str(n), "Quito", base64.b64encode(json.dumps(event | change).encode()).decode())


def land(spark, root, records):
    spark.createDataFrame(records, schemas.STREAM_RECORD).write.mode("append").json(f"{root}/landing")
    bronze.await_end(bronze.start_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/dead", f"{root}/cp"))


def test_records_land_once_and_failed_ones_apart(spark):
    root = scratch_path(spark, "t-stream")
    land(spark, root, [record(1), ("2", "Quito", "??"), record(3, temperature_2m_c="mild", note="kept")])
    land(spark, root, [record(4), record(5, event_type="tide")])
    bronze.await_end(bronze.start_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/dead", f"{root}/cp"))
    texts = {json.loads(r.value)["event_id"]: json.loads(r.value) for r in bronze.read_bronze_text(spark, f"{root}/bronze").collect()}
    assert set(texts) == {"e1", "e3", "e4"} and texts["e3"]["note"] == "kept" and texts["e3"]["temperature_2m_c"] == "mild"
    dead = bronze.read_dead_letter(spark, f"{root}/dead").collect()
    assert sorted((r.record_id, r.error) for r in dead) == [("2", "bad_base64"), ("5", "unsupported_event_type")]
    typed = {r.event_id: r for r in bronze.read_bronze(spark, f"{root}/bronze").collect()}
    assert typed["e3"]._corrupt_record is not None and typed["e3"].city == "Quito" and typed["e1"]._corrupt_record is None
    assert [r.event_id for r in bronze.read_bronze_batch(spark, f"{root}/bronze", "forecast", "2031-03-04").collect()] == ["e4"]
    assert bronze.read_bronze_batch(spark, f"{root}/bronze", "forecast", "2031-03-07").isEmpty()


def test_a_replayed_batch_replaces_itself(spark):  # R3s
    root = scratch_path(spark, "t-replay")
    rows = spark.createDataFrame([record(1), record(2), ("9", "Quito", "??")], schemas.STREAM_RECORD)
    for stream, batch in (("a", 0), ("a", 0), ("b", 0), ("a", 1)):
        bronze._land(f"{root}/bronze", f"{root}/dead", stream)(rows, batch)
    assert bronze.read_bronze_text(spark, f"{root}/bronze").count() == 3 * 2
    assert bronze.read_dead_letter(spark, f"{root}/dead").count() == 3


def test_the_rows_of_a_folder_meet_in_one_file(spark):  # R9: not one for each task
    root = scratch_path(spark, "t-files")
    rows = [record(1 + n % 2, event_id=f"e{n}") for n in range(40)] + [("9", "Quito", "??")] * 40
    bronze._land(f"{root}/bronze", f"{root}/dead", "s")(spark.createDataFrame(rows, schemas.STREAM_RECORD).repartition(5), 0)
    landed, dead = bronze.read_bronze_text(spark, f"{root}/bronze"), bronze.read_dead_letter(spark, f"{root}/dead")
    assert landed.count() == dead.count() == 40
    assert len(landed.inputFiles()) == 2 and len(dead.inputFiles()) == 1


def test_the_text_of_a_record_is_rendered_once(spark):
    rows = forecasts(spark, [forecast(str(n)) for n in (1, 5, 7, 101, 103, 107, 109, 113, 5 * 7 * 103, 101 * 103, 5 * 7 * 107)])
    sent = fixtures.stream_records(rows, schemas.FORECAST_COLUMNS)
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 1
    got = {r.record_id: r.value for r in sent.collect()}
    text = {k: base64.b64decode(v).decode() for k, v in got.items() if not v.startswith("!")}
    assert set(got) - set(text) == {"101", str(101 * 103)}
    assert text["103"] == text["1"][:20].replace('"1"', '"103"')[:20] and text[str(5 * 7 * 103)][:3] == "  {" and len(text[str(5 * 7 * 103)]) == 20
    whole = {k: json.loads(v) for k, v in text.items() if len(v) > 20}
    assert whole["5"] | {"event_id": "1"} == whole["1"] and text["5"].startswith("  {")
    assert whole["7"]["sensor"] == "s1" and whole["107"]["event_type"] == "radar" and whole["109"]["ingested_at"] == "soon"
    assert whole["113"]["temperature_2m_c"] == "mild" and whole["3745"]["sensor"] == "s1" and whole["3745"]["event_type"] == "radar"


def test_one_days_read_lists_only_that_day(spark):  # S2
    root = scratch_path(spark, "t-day")
    land(spark, root, [record(n) for n in range(1, 9)])
    day = bronze.read_bronze_batch(spark, f"{root}/bronze", "forecast", "2031-03-05")
    assert len(day.inputFiles()) == 1 and len(bronze.read_bronze(spark, f"{root}/bronze").inputFiles()) == 8


def typed(spark, rows):
    return forecasts(spark, rows).withColumn("forecast_date", F.to_date("forecast_timestamp"))


def run_merge(spark, lay, deliveries, apply):
    for rows in deliveries:
        df = typed(spark, rows)
        df.write.mode("append").parquet(f"{lay.root}/landing")
        stream = merge.read_silver_stream(spark, f"{lay.root}/landing", df.schema)
        bronze.await_end(merge.start(stream, apply, f"{lay.root}/cp"))


def test_stream_merge_equals_batch_and_replays_safely(spark):  # R6s
    rows = [
        forecast("u", temp=1.0, ingested="2031-03-02 07:00"),
        forecast("v", temp=2.0, ingested="2031-03-03 07:00"),
        forecast("u", temp=1.0, ingested="2031-03-04 07:00"),
        forecast("w", temp=3.0, city="Quito"),
    ]
    cols = ["source_event_id", "effective_from", "effective_to", "is_current", "last_seen_at"]
    want = wh.scd2_apply(None, wh.incoming_revisions(wh.stage(typed(spark, rows), "forecast")))
    want = sorted(map(str, want.select(cols).collect()))
    lay = jobs.new_layout(spark, "t-merge")
    run_merge(spark, lay, [rows[:1], rows[1:], rows], merge.merge_facts(lay, "forecast"))
    assert sorted(map(str, jobs.read_fact_forecast(spark, lay).select(cols).collect())) == want and len(want) == 4


def test_no_event_is_lost_for_arriving_late(spark):  # R4s
    newest = [forecast("m", ingested="2031-03-02 20:00"), forecast("n", ingested="2031-03-02 20:30")]
    older = [forecast("m", ingested="2031-03-02 05:00"), forecast("p", ingested="2031-03-01 05:00")]
    lay = jobs.new_layout(spark, "t-late")
    run_merge(spark, lay, [newest, older, newest], merge.merge_silver(lay, "forecast"))
    got = sorted(map(tuple, jobs.read_silver(spark, lay, "forecast").collect()))
    assert got == sorted(map(tuple, sv.dedup(typed(spark, newest + older)).collect()))
    assert [(r[0], r[11].hour) for r in got] == [("m", 20), ("n", 20), ("p", 5)]


def test_a_repeat_within_the_watermark_commits_nothing(spark):  # R4s
    lay = jobs.new_layout(spark, "t-state")
    first = [forecast("m", ingested="2031-03-02 20:00"), forecast("n", ingested="2031-03-02 20:30")]
    again = [forecast("m", ingested="2031-03-02 21:00")]
    commits = []
    for rows in (first, again, [forecast("m", ingested="2031-03-03 09:00")]):
        df = typed(spark, rows)
        df.write.mode("append").parquet(f"{lay.root}/landing")
        stream = merge.dedup_events(merge.read_silver_stream(spark, f"{lay.root}/landing", df.schema))
        bronze.await_end(merge.start(stream, merge.merge_silver(lay, "forecast"), f"{lay.root}/cp"))
        commits.append(st.snapshot(spark, lay.root)[0])
    assert commits[:2] == [1, 1]  # a copy an hour later touches no table
    assert sorted(r.event_id for r in jobs.read_silver(spark, lay, "forecast").collect()) == ["m", "n"]


def test_rows_behind_the_watermark_come_by_the_other_way(spark):  # R4s
    lay = jobs.new_layout(spark, "t-behind")
    apply = merge.late_rows(lay, "forecast", merge.merge_silver(lay, "forecast"))
    newest, old = forecast("m", ingested="2031-03-05 20:00"), forecast("p", ingested="2031-03-01 05:00")
    apply(typed(spark, [newest]), 0)
    assert jobs.read_silver(spark, lay, "forecast") is None
    apply(typed(spark, [old]), 1)
    apply(typed(spark, [old]), 1)  # replayed
    assert [r.event_id for r in jobs.read_silver(spark, lay, "forecast").collect()] == ["p"]
