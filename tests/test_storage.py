"""Commits over all tables, deltas, quarantine, markers (K2-K6, K10, U7, R5s,
D1, D5, D7, D10, Q5, Q6)."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from revcast import schemas
from revcast.operators import silver as sv
from revcast.operators import warehouse as wh
from revcast.plans import jobs
from revcast.plans import storage as st
from revcast.session import scratch_path

from .helpers import forecast, forecasts, observation, observations

DAY3, DAY4 = dt.date(2031, 3, 3), dt.date(2031, 3, 4)


def silver(spark, lay, rows, day="d", batch="0"):
    _, dates, cached = jobs.run_silver(spark, forecasts(spark, rows), "forecast", lay, day, batch)
    cached.unpersist()
    return dates


def test_a_later_run_keeps_earlier_issues_of_a_target(spark):  # D1
    lay = jobs.new_layout(spark, "t-d1")
    assert silver(spark, lay, [forecast("a"), forecast("far", target="2031-03-04 00:00")]) == [DAY3, DAY4]
    assert silver(spark, lay, [forecast("b", issued="2031-03-03 01:00")]) == [DAY3]
    assert sorted(r.event_id for r in jobs.read_silver(spark, lay, "forecast").collect()) == ["a", "b", "far"]
    assert [r.event_id for r in jobs.read_silver(spark, lay, "forecast", [DAY4]).collect()] == ["far"]
    assert jobs.read_silver(spark, lay, "forecast", [dt.date(2040, 1, 1)]) is None
    stg = jobs.stage_from_silver(spark, lay, "forecast", [DAY4])  # S7, D9
    assert stg.columns == schemas.STG_FORECAST_COLUMNS and stg.count() == 1


def test_a_one_date_read_opens_that_date_only(spark):  # R1, S3
    lay = jobs.new_layout(spark, "t-list")
    silver(spark, lay, [forecast(str(d), target=f"2031-04-{d:02d} 00:00") for d in range(1, 20)])
    one = jobs.read_silver(spark, lay, "forecast", [dt.date(2031, 4, 7)])
    assert [f.split("forecast_date=")[1][:10] for f in one.inputFiles()] == ["2031-04-07"]
    assert len(jobs.read_silver(spark, lay, "forecast").inputFiles()) == 19


def tables(spark, lay):
    """Every stored table as text."""
    readers = {
        "silver": jobs.read_silver(spark, lay, "forecast"), "observations": jobs.read_silver(spark, lay, "observation"),
        "runs": jobs.read_forecast_runs(spark, lay), "fact": jobs.read_fact_forecast(spark, lay),
        "upserts": jobs.read_fact_observation(spark, lay), "gold": jobs.read_gold(spark, lay), "cities": jobs.read_dim_city(spark, lay),
        "summary": jobs.read_summary(spark, lay),
    }
    return {name: sorted(map(str, df.collect())) if df is not None else None for name, df in readers.items()}


FIRST = ([forecast("a", temp=1.0, ingested="2031-03-02 07:00")], [observation("o", temp=0.0)])
SECOND = (
    [forecast("b", temp=2.0, ingested="2031-03-02 08:00"), forecast("q", city="Quito")],
    [observation("p", temp=9.0, ingested="2031-03-05 00:00")],
)


def batch(spark, lay, rows, day, **kw):
    return jobs.run_batch(spark, lay, forecasts(spark, rows[0]), observations(spark, rows[1]), day, **kw)


def test_a_writer_lost_anywhere_leaves_all_tables_as_they_were(spark, monkeypatch):  # U7
    lay, whole = jobs.new_layout(spark, "t-crash"), jobs.new_layout(spark, "t-whole")
    batch(spark, lay, FIRST, "one")
    before = tables(spark, lay)

    def lost(*args, **kw):
        raise RuntimeError("driver lost")

    for place in ((jobs, "merge_observations"), (st.Transaction, "commit")):
        monkeypatch.setattr(*place, lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            batch(spark, lay, SECOND, "two")
        assert tables(spark, lay) == before
        monkeypatch.undo()
    assert batch(spark, lay, SECOND, "two") is True
    batch(spark, whole, FIRST, "one")
    batch(spark, whole, SECOND, "two")
    after = tables(spark, whole)
    assert tables(spark, lay) == after
    assert len(st.vacuum(spark, lay.root, lay.fact_forecast)) == 3  # two lost runs and the replaced one
    assert tables(spark, lay) == after


def test_two_writers_of_one_date_conflict_and_of_two_dates_don_t(spark):  # U7
    lay = jobs.new_layout(spark, "t-conflict")
    a, b, c = (st.Transaction(spark, lay.root) for _ in range(3))
    for tx, event, target in ((a, "a", "2031-03-03 09:00"), (b, "b", "2031-03-03 10:00"), (c, "c", "2031-03-04 09:00")):
        rows = forecasts(spark, [forecast(event, target=target)]).withColumn("forecast_date", F.to_date("forecast_timestamp"))
        jobs.merge_silver(spark, rows, "forecast", lay, tx=tx)
    assert a.commit() == 1
    with pytest.raises(st.Conflict, match="2031-03-03"):
        b.commit()
    assert c.commit() == 2
    assert sorted(r.event_id for r in jobs.read_silver(spark, lay, "forecast").collect()) == ["a", "c"]


def test_a_commit_record_is_never_overwritten_nor_half_seen(spark, tmp_path):
    path = f"{tmp_path}/_commits/000000000001"
    assert st.create_text(spark, path, "{}") is True
    assert st.create_text(spark, path, "other") is False
    assert st.read_text(spark, path) == "{}"
    (tmp_path / "_commits" / "000000000002.ab.tmp").write_text("{")  # a writer lost while writing
    assert st.snapshot(spark, str(tmp_path)) == (1, {})


def test_a_finished_batch_is_not_run_again(spark):  # K10
    lay = jobs.new_layout(spark, "t-marker")
    a, x, y = (([forecast(e)], []) for e in "axy")
    assert batch(spark, lay, a, "day", batch="06") is True
    assert batch(spark, lay, a, "day", batch="06") is False
    with pytest.raises(ValueError, match="finished with other rows"):
        batch(spark, lay, x, "day", batch="06")
    assert batch(spark, lay, y, "day", batch="07") is True
    assert sorted(r.event_id for r in jobs.read_silver(spark, lay, "forecast").collect()) == ["a", "y"]


def test_runs_of_one_day_without_names_all_land(spark):  # K10
    lay = jobs.new_layout(spark, "t-hourly")
    assert [batch(spark, lay, ([forecast(e)], []), "day") for e in "aba"] == [True, True, False]
    assert sorted(r.event_id for r in jobs.read_silver(spark, lay, "forecast").collect()) == ["a", "b"]
    assert st.read_metrics(spark, lay.metrics, schemas.METRICS).where("event_type = 'forecast'").count() == 2


def test_low_coverage_and_repeated_ids_stop_a_run(spark, monkeypatch):  # Q5, Q6
    lay = jobs.new_layout(spark, "t-gates")
    batch(spark, lay, FIRST, "one", min_coverage=1.0)
    before = tables(spark, lay)
    with pytest.raises(Exception, match="quality gate join_coverage failed"):
        batch(spark, lay, SECOND, "two", min_coverage=0.9)
    monkeypatch.setattr(jobs.sv, "dedup", lambda df: df)
    with pytest.raises(Exception, match="quality gate unique_event_id"):
        batch(spark, lay, ([forecast("d"), forecast("d", ingested="2031-03-02 09:00")], []), "three")
    assert tables(spark, lay) == before
    monkeypatch.undo()
    assert batch(spark, lay, SECOND, "two", min_coverage=0.5) is True


def test_deltas_hold_touched_keys_and_compaction_changes_no_row(spark):  # R5s, K2
    lay = jobs.new_layout(spark, "t-deltas")
    start = [observation(f"o{h}", at=f"2031-03-03 {h:02d}:00", temp=float(h)) for h in range(20)]
    for n in range(4):
        rows = start if n == 0 else [observation(f"n{n}", at="2031-03-03 05:00", temp=50.0 + n, ingested=f"2031-03-04 0{n}:00", source=None if n == 2 else "north")]
        jobs.merge_observations(spark, lay, wh.stage(observations(spark, rows), "observation"), [DAY3], deltas=True)
    _, state = st.snapshot(spark, lay.root)
    runs = state[lay.fact_observation]["2031-03-03"]
    tx = st.Transaction(spark, lay.root)
    assert [tx.staged(lay.fact_observation, r, schemas.FACT_OBSERVATION).count() for r in runs] == [20, 1, 1, 1]
    rows = sorted(map(str, jobs.read_fact_observation(spark, lay).collect()))
    assert len(rows) == 21 and sum("53.0" in r for r in rows) == 1 and sum("52.0" in r for r in rows) == 1
    key = wh.OKEY
    assert st.compact(spark, lay.root, lay.fact_observation, schemas.FACT_OBSERVATION, "observation_date", key) == ["2031-03-03"]
    assert sorted(map(str, jobs.read_fact_observation(spark, lay).collect())) == rows
    assert len(st.vacuum(spark, lay.root, lay.fact_observation)) == 4
    assert sorted(map(str, jobs.read_fact_observation(spark, lay).collect())) == rows


def test_a_date_of_many_deltas_is_folded_by_its_next_merge(spark, monkeypatch):
    monkeypatch.setattr(jobs, "FOLD", 3)
    lay = jobs.new_layout(spark, "t-fold")
    counts = []
    for n in range(5):
        rows = [forecast(f"e{n}", temp=float(n % 2), ingested=f"2031-03-02 0{n}:30")]
        jobs.merge_forecasts(spark, lay, wh.stage(forecasts(spark, rows), "forecast"), [DAY3], deltas=True)
        counts.append(len(st.snapshot(spark, lay.root)[1][lay.fact_forecast]["2031-03-03"]))
    assert counts == [1, 2, 3, 1, 2]
    assert [r.source_event_id for r in jobs.read_fact_forecast(spark, lay).orderBy("effective_from").collect()] == [f"e{n}" for n in range(5)]


def test_steps_that_run_together_all_end_before_an_error_is_raised(spark):
    spark.sparkContext.setLocalProperty("t.step", "seen")
    meet, ended = threading.Barrier(2), []

    def fails():
        meet.wait(60)  # only passed by two at the same time
        raise ValueError("first")

    def ends():
        meet.wait(60)
        ended.append(spark.range(3).count())
        return spark.sparkContext.getLocalProperty("t.step")

    with pytest.raises(ValueError, match="first"):
        jobs.together(spark, fails, ends)
    assert ended == [3]
    assert jobs.together(spark, lambda: 1, lambda: spark.sparkContext.getLocalProperty("t.step")) == [1, "seen"]
    assert jobs.together(spark) == []


def test_both_types_of_a_batch_are_written_at_the_same_time(spark, monkeypatch):  # small jobs don't wait for each other
    meet, write = threading.Barrier(2), jobs.run_silver

    def both(*args, **kw):
        meet.wait(60)
        return write(*args, **kw)

    monkeypatch.setattr(jobs, "run_silver", both)
    lay = jobs.new_layout(spark, "t-together")
    assert batch(spark, lay, FIRST, "one")
    assert [r.event_id for r in jobs.read_silver(spark, lay, "observation").collect()] == ["o"]
    assert len({run for table in st.snapshot(spark, lay.root)[1].values() for runs in table.values() for run in runs}) == 9


def test_quarantine_and_counts_by_batch(spark):  # K3, K4, D7
    lay = jobs.new_layout(spark, "t-d7")
    silver(spark, lay, [forecast("a", temp=None), forecast("b")], "day", "1")
    silver(spark, lay, [forecast("c", prob=400.0, city=None)], "day", "2")
    silver(spark, lay, [forecast("a", temp=None), forecast("b")], "day", "1")  # rerun

    def quarantined():
        rows = st.read_quarantine(spark, lay.quarantine, "forecast", schemas.QUARANTINE["forecast"]).collect()
        return sorted((r.batch, r.event_id, r.failed_rules) for r in rows)

    both = [("1", "a", ["temperature_in_range"]), ("2", "c", ["city_present", "precipitation_probability_in_range"])]
    assert quarantined() == both
    silver(spark, lay, [forecast("b")], "day", "1")  # a clean rerun leaves nothing of the old one
    assert quarantined() == both[1:]
    counts = st.read_metrics(spark, lay.metrics, schemas.METRICS).collect()
    assert sorted((r.batch, r.input_count, r.invalid_count) for r in counts) == [("1", 1, 0), ("2", 1, 1)]


def test_gold_and_summary_follow_the_touched_dates(spark):  # D5, D10, K6
    lay = jobs.new_layout(spark, "t-d5")
    o3, o4 = observation("o3", temp=0.0), observation("o4", at="2031-03-04 09:00", temp=1.0, ingested="2031-03-04 10:00")
    jobs.run_batch(spark, lay, forecasts(spark, [forecast("a")]), observations(spark, [o3]), "p1")
    jobs.run_batch(spark, lay, forecasts(spark, [forecast("b", target="2031-03-04 09:00")]), observations(spark, [o4]), "p2")
    assert {str(r.target_date): r.temperature_error_c for r in jobs.read_gold(spark, lay).collect()} == {"2031-03-03": 4.0, "2031-03-04": 3.0}
    fixed = observation("o5", temp=10.0, ingested="2031-03-05 00:00")
    jobs.run_batch(spark, lay, forecasts(spark, []), observations(spark, [fixed]), "p3")
    assert {str(r.target_date): r.temperature_error_c for r in jobs.read_gold(spark, lay).collect()} == {"2031-03-03": -6.0, "2031-03-04": 3.0}
    summary = jobs.read_summary(spark, lay).collect()
    assert sum(r.matched_forecasts for r in summary) == 2
    assert sorted(r.temperature_mae_c for r in summary) == [3.0, 6.0]
    assert jobs.read_fact_observation(spark, lay).count() == 2


def test_a_date_can_become_empty(spark):
    lake, schema = scratch_path(spark, "t-empty"), schemas.GOLD_PARTIALS
    row = ("Oslo", "00-06h", 1, 1.0, 1.0, 1.0)
    rows = spark.createDataFrame([(*row, DAY3), (*row, DAY4)], schema)
    for df, dates in ((rows, [DAY3, DAY4]), (rows.limit(0), [DAY3])):
        with st.transaction(spark, lake) as tx:
            tx.replace("sums", tx.stage(df, "sums", schema, "target_date"), "target_date", dates)
    assert [r.target_date for r in st.Transaction(spark, lake).read("sums", schema, "target_date").collect()] == [DAY4]


def test_old_commit_records_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "KEEP_COMMITS", 3)
    for n in range(12):
        with st.transaction(spark, str(tmp_path)) as tx:
            tx.state["t"] = {"": [str(n)]}
            tx.changed.add(("t", ""))
    names = sorted(p.name for p in (tmp_path / "_commits").iterdir() if p.name.isdigit())
    assert int(names[-1]) == 12 and len(names) <= 6 and st.snapshot(spark, str(tmp_path))[1] == {"t": {"": ["11"]}}


def test_dimensions_get_a_new_version_only_for_new_names(spark):  # J9, U6
    lay = jobs.new_layout(spark, "t-dims")
    none = observations(spark, [])
    for batch, (city, at) in enumerate([("Oslo", "2031-03-02"), ("Oslo", "2031-03-03"), ("Quito", "2031-03-04")]):
        jobs.run_batch(spark, lay, forecasts(spark, [forecast(city, city=city)]), none, "p", f"{at} 00:00:00", str(batch))
    written = [len(st._children(spark, f"{lay.root}/{t}/data", "run=")) for t in (lay.dim_city, lay.dim_source)]
    assert written == [2, 1]
    assert {r.city_name: str(r.created_at)[:10] for r in jobs.read_dim_city(spark, lay).collect()} == {"Oslo": "2031-03-02", "Quito": "2031-03-04"}
    assert jobs.read_dim_city(spark, lay).schema.names == schemas.DIM_CITY.names
    assert jobs.read_fact_forecast(spark, lay).where(F.col("created_at").isNull()).count() == 0


def test_counts_are_those_of_the_batch_alone(spark):  # K4, A8
    lay = jobs.new_layout(spark, "t-observe")
    silver(spark, lay, [forecast("a"), forecast("b")], "day", "1")
    # a stored id sent again twice, a new one on another date, a refused row
    again = forecast("a", ingested="2031-03-03 09:00")
    silver(spark, lay, [again, again, forecast("c", target="2031-03-04 00:00"), forecast("d", temp=None)], "day", "2")
    silver(spark, lay, [forecast("e", temp=None)], "day", "3")  # touches no date
    silver(spark, lay, [], "day", "4")
    rows = st.read_metrics(spark, lay.metrics, schemas.METRICS).collect()
    got = {r.batch: (r.input_count, r.valid_count, r.invalid_count, r.deduplicated_count) for r in rows}
    assert got == {"1": (2, 2, 0, 2), "2": (4, 3, 1, 2), "3": (1, 0, 1, 0), "4": (0, 0, 0, 0)}
    assert sv.BATCH_ROWS not in jobs.read_silver(spark, lay, "forecast").columns


def test_staged_dates_load_on_their_own(spark):  # S7, P26
    lay = jobs.new_layout(spark, "t-load")
    jobs.load_warehouse(spark, lay, [DAY3], [DAY3])  # no silver yet
    dates = silver(spark, lay, [forecast("a"), forecast("far", target="2031-03-04 00:00")])
    for loaded, want in (([DAY4], {"far"}), (dates, {"a", "far"}), (dates, {"a", "far"})):
        jobs.load_warehouse(spark, lay, loaded, [])
        rows = jobs.read_fact_forecast(spark, lay).collect()
        assert sorted(r.source_event_id for r in rows) == sorted(want)
