"""SCD2 revisions, observation upsert, dimensions, gates (U1-U6, D12, D16,
D17, D17b, D19, D20, Q7, Q10)."""

import random

import pytest
from pyspark.sql import functions as F

from revcast.functions.ids import revision_key, surrogate_key
from revcast.operators import quality as dq
from revcast.operators import warehouse as wh

from .helpers import forecast, forecasts, observation, observations, t

COLS = ["source_event_id", "effective_from", "effective_to", "is_current", "last_seen_at"]


def revisions(spark, rows):
    return wh.incoming_revisions(wh.stage(forecasts(spark, rows), "forecast"))


def chain(df):
    return sorted(tuple(map(str, r)) for r in df.select("city_key", *COLS, "record_hash").collect())


def by_rule(rows):
    """The chain spelled out: (city, id, from, to, last seen) of each revision."""
    out = []
    for city in {r[3] for r in rows}:
        seen = {}
        for r in rows:
            if r[3] == city:
                seen[r[11]] = max(seen.get(r[11], r), r, key=lambda x: x[0])
        runs = []
        for at in sorted(seen):
            value = seen[at][8:11]
            if runs and runs[-1][1] == value:
                runs[-1][3] = at
            else:
                runs.append([seen[at][0], value, at, at])
        for i, (event, _, start, last) in enumerate(runs):
            out.append((city, event, start, runs[i + 1][2] if i + 1 < len(runs) else None, last))
    return sorted(out, key=str)


def built(spark, df):
    keys = {r[1]: r[0] for r in spark.createDataFrame([("Oslo",), ("Quito",)], "c string").select("c", surrogate_key("c")).collect()}
    return sorted(
        ((keys[r.city_key], r.source_event_id, r.effective_from, r.effective_to, r.last_seen_at) for r in df.collect()), key=str
    )


def sightings(seed, n, hours):
    """Few values, over many days, with ties, gaps and exact copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        h = rng.randrange(hours)
        rows.append(
            forecast(f"e{i:04d}", city=rng.choice(["Oslo", "Oslo", "Quito"]), temp=float(rng.randrange(3)),
                     ingested=f"2031-03-{1 + h // 24:02d} {h % 24:02d}:00")
        )
    return rows + rng.sample(rows, n // 10)


@pytest.mark.parametrize("seed,n,hours", [(1, 40, 24), (2, 300, 24 * 25), (3, 300, 24 * 6), (4, 12, 24 * 28), (5, 200, 30)])
def test_chain_follows_the_rule_across_slices(spark, seed, n, hours):  # D17, F6
    rows = sightings(seed, n, hours)
    fact = wh.scd2_apply(None, revisions(spark, rows))
    assert built(spark, fact) == by_rule(rows)
    assert dq.gate(dq.duplicate_current(fact), "current") == 0 and dq.gate(dq.invalid_intervals(fact), "intervals") == 0


@pytest.mark.parametrize("seed", range(4))
def test_time_ordered_batches_and_replays_give_the_same_chain(spark, seed):  # D17, D20
    rows = sorted(sightings(seed, 60, 24 * 9), key=lambda r: r[11])
    cut = random.Random(seed).randrange(len(rows))
    while 0 < cut < len(rows) and rows[cut][11] == rows[cut - 1][11]:
        cut += 1
    whole = chain(wh.scd2_apply(None, revisions(spark, rows)))
    stored = wh.merge_runs(None, revisions(spark, rows[:cut])).cache()
    both = wh.merge_runs(stored, revisions(spark, rows[cut:])).cache()
    assert chain(wh.chains(both)) == whole
    assert chain(wh.scd2_apply(both, revisions(spark, rows[cut:]))) == whole


@pytest.mark.parametrize("seed", range(4))
def test_any_order_of_deliveries_gives_the_chain_of_all_at_once(spark, seed):  # U1
    rows = sightings(10 + seed, 60, 24 * 4)
    random.Random(seed).shuffle(rows)
    stored = None
    for i in range(0, len(rows), 14):
        stored = wh.merge_runs(stored, revisions(spark, rows[i : i + 14])).cache()
    assert built(spark, wh.chains(stored)) == by_rule(rows)


def test_the_pass_over_a_key_sees_no_runs(spark):  # a hot key's runs never meet in one task
    rows = [forecast(f"e{h}", source=s, temp=float(h % 3), ingested=f"2031-03-{1 + h // 24:02d} {h % 24:02d}:00")
            for h in range(0, 24 * 5, 5) for s in ("north", None)]
    fact = wh.scd2_apply(None, revisions(spark, rows))
    nodes, found = [fact._jdf.queryExecution().optimizedPlan()], 0
    while nodes:
        node = nodes.pop()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "Window":
            found += 1
            assert "array<" not in node.schema().catalogString()
    assert found
    # slices of a key that is null in part are stitched too
    one = built(spark, fact.where("source_key is null"))
    assert one == built(spark, fact.where("source_key is not null")) and len(one) == 24


def test_a_late_row_splits_a_run_of_many_repeats(spark):  # what first and last sighting alone can't tell
    same = [forecast(f"r{h}", temp=1.0, ingested=f"2031-03-02 {h:02d}:00") for h in range(6, 12)]
    stored = wh.merge_runs(None, revisions(spark, same))
    assert [len(r.seen) for r in stored.select(F.inline("runs")).collect()] == [6]
    late = forecast("z", temp=2.0, ingested="2031-03-02 07:30")
    got = wh.scd2_apply(stored, revisions(spark, [late])).orderBy("effective_from").collect()
    assert [(r.source_event_id, r.effective_from.hour, r.last_seen_at.hour) for r in got] == [("r6", 6, 7), ("z", 7, 7), ("r8", 8, 11)]


def test_a_revision_keeps_the_batch_that_brought_its_start(spark):  # U6
    one, two = "2031-04-01 00:00:00", "2031-04-02 00:00:00"
    stored = wh.merge_runs(None, revisions(spark, [U]), one)
    rows = wh.scd2_apply(stored, revisions(spark, [U, V]), two).orderBy("effective_from").collect()
    assert [str(r.created_at) for r in rows] == [one, two]


U = forecast("u", temp=1.0, ingested="2031-03-01 07:00")
V = forecast("v", temp=2.0, ingested="2031-03-02 07:00")
W = forecast("w", temp=1.0, ingested="2031-03-05 07:00")
X = forecast("x", temp=9.0, ingested="2031-03-05 09:00")


def test_late_row_between_two_sightings_of_one_value(spark):  # §7.4 last_seen_at
    stored = wh.merge_runs(None, revisions(spark, [U, W])).cache()
    assert [r.last_seen_at for r in wh.chains(stored).collect()] == [W[11]]
    late = wh.scd2_apply(stored, revisions(spark, [V])).orderBy("effective_from").collect()
    assert [r.temperature_2m_c for r in late] == [1.0, 2.0, 1.0]
    assert [r.effective_to for r in late] == [V[11], W[11], None]


def test_building_the_plan_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "none expected")
    wh.scd2_apply(wh.merge_runs(None, revisions(spark, [U])), revisions(spark, [V, W]))
    assert list(tracker.getJobIdsForGroup("plan-only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_newest_reading_survives(spark):  # U2, D17b
    def incoming(*rows):
        return wh.incoming_observations(wh.stage(observations(spark, list(rows)), "observation"), "2031-04-01 00:00:00")

    stored = wh.upsert_observations(None, incoming(observation("b", temp=5.0, ingested="2031-03-03 12:00"))).cache()
    newer = observation("a", temp=6.0, ingested="2031-03-03 13:00")
    older = observation("z", temp=7.0, ingested="2031-03-03 11:00")
    tie = observation("c", temp=8.0, ingested="2031-03-03 12:00")
    for row, want in ((newer, ("a", 6.0)), (older, ("b", 5.0)), (tie, ("c", 8.0))):
        (r,) = wh.upsert_observations(stored, incoming(row)).collect()
        assert (r.source_event_id, r.temperature_2m_c) == want and str(r.observation_date) == "2031-03-03"
    assert wh.upsert_observations(stored, incoming(observation(at="2031-03-03 11:00"))).count() == 2


def test_city_keeps_its_first_position(spark):  # D19, U3
    rows = [forecast(lat=3.0, ingested="2031-03-02 08:00"), forecast(lat=2.0, ingested="2031-03-02 07:00"), forecast(lat=1.0, ingested="2031-03-02 07:00")]
    first = wh.upsert_dim_city(None, wh.stage(forecasts(spark, rows), "forecast"))
    assert [(r.city_name, float(r.latitude)) for r in first.collect()] == [("Oslo", 1.0)]
    later = [forecast(lat=0.0, ingested="2030-01-01 00:00"), forecast(city="Quito", lat=-0.25), forecast(city=None)]
    dim = wh.upsert_dim_city(first, wh.stage(forecasts(spark, later), "forecast")).collect()
    assert {r.city_name: float(r.latitude) for r in dim} == {"Oslo": 1.0, "Quito": -0.25}


def test_keys_are_hashes_of_the_name_and_of_the_whole_revision(spark):  # D12, U5
    import hashlib

    name = spark.createDataFrame([("Zürich",)], "n string").select(surrogate_key("n")).first()[0]
    assert name == int(hashlib.sha256("Zürich".encode()).hexdigest()[:15], 16) < 2**60
    fact = wh.scd2_apply(None, revisions(spark, [U, V]))
    keys = [r[0] for r in fact.select("forecast_revision_key").collect()]
    assert all(len(k) == 64 for k in keys) and len(set(keys)) == 2
    assert sorted(r[0] for r in fact.select(revision_key()).collect()) == sorted(keys)


def test_calendar(spark):  # P27, D16
    df = spark.createDataFrame([(t("2031-02-28 22:30"),), (t("2031-03-01 01:10"),)], "t timestamp_ntz")
    hours = wh.dim_time(spark, df).orderBy("full_timestamp").collect()
    assert [h.time_key for h in hours] == [2031022822, 2031022823, 2031030100, 2031030101]
    assert [h.day_of_week for h in hours] == [5, 5, 6, 6]  # Friday, Saturday
    assert wh.dim_time(spark, df.limit(0)).count() == 0


def test_gate_stops_the_run_and_the_report_names_it(spark):  # Q7, Q10
    appended = revisions(spark, [U, V]).withColumn("is_current", F.lit(True))
    with pytest.raises(Exception, match="quality gate one_current failed: 1 rows"):
        dq.gate(dq.duplicate_current(appended), "one_current")
    report = dq.gate_report({"bad": dq.duplicate_current(appended), "good": dq.duplicate_current(appended.limit(1))})
    assert sorted(map(tuple, report.collect())) == [("bad", 1, False), ("good", 0, True)]
