"""Stream → bronze JSON → daily batch jobs → warehouse, gold and views,
on the sf0.001 tables; silver must equal the direct mapping of the days."""

from pyspark.sql import functions as F

from revcast import schemas
from revcast.operators import silver as sv
from revcast.operators import views
from revcast.plans import jobs
from revcast.session import scratch_path
from revcast.sources import fixtures as fx
from revcast.streaming import bronze

from .conftest import SF_SMALL

DAYS = ["2024-01-02", "2024-01-03"]


def test_bronze_to_views(spark):
    root = scratch_path(spark, "t-e2e")
    lay = jobs.Layout(root)
    forecasts = fx.forecast_events(spark, SF_SMALL)
    observations = fx.observation_events(spark, SF_SMALL)
    recs = fx.stream_records(forecasts, schemas.FORECAST_COLUMNS).unionByName(
        fx.stream_records(observations, schemas.OBSERVATION_COLUMNS)
    )
    recs.write.json(f"{root}/landing")
    bronze.await_end(bronze.start_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/dead", f"{root}/cp"))
    for day in DAYS:
        f = bronze.read_bronze_batch(spark, f"{root}/bronze", "forecast", day)
        o = bronze.read_bronze_batch(spark, f"{root}/bronze", "observation", day)
        jobs.run_batch(spark, lay, f, o, process_date=day, batch_ts=day + "T05:20:00")

    # silver = valid, deduplicated forecasts ingested on those days (minus the
    # records the stream damaged on purpose: in the dead letter, or, mistyped,
    # in quarantine)
    n = F.col("event_id").cast("bigint")
    expected = sv.silver(
        forecasts.where(F.to_date("ingested_at").isin(DAYS))
        .where(
            (n % fx.BAD_BASE64_EVERY != 0) & (n % fx.BAD_JSON_EVERY != 0) & (n % fx.UNKNOWN_TYPE_EVERY != 0)
            & (n % fx.BAD_TIME_EVERY != 0) & (n % fx.MISTYPED_EVERY != 0)
        ),
        "forecast",
    )
    stored = jobs.read_silver(spark, lay, "forecast")
    cols = ["event_id", "issued_at", "forecast_timestamp", "temperature_2m_c", "ingested_at"]
    assert sorted(map(tuple, stored.select(cols).collect())) == sorted(
        map(tuple, expected.select(cols).collect())
    )

    fact = jobs.read_fact_forecast(spark, lay)
    obs = jobs.read_fact_observation(spark, lay)
    city = jobs.read_dim_city(spark, lay)
    source = jobs.read_dim_source(spark, lay)
    assert fact.count() == stored.count() and fact.where("is_current").count() == fact.count()
    acc = views.temperature_accuracy(fact, obs, city, source)
    gold = jobs.read_gold(spark, lay)
    assert acc.count() == gold.count()
    summary = jobs.read_summary(spark, lay)
    assert summary.agg(F.sum("matched_forecasts")).first()[0] == gold.count()
