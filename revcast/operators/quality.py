"""Data-quality checks and the gate (Q1-Q12, A5-A7, A11-A13, F7, F8, F9,
J8).

Each check returns the violating rows (or one summary row), so the same
frame serves as a report, a test oracle and the input of :func:`gate`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules as R

FKEY = schemas.FORECAST_KEY
OKEY = schemas.OBSERVATION_KEY


def duplicate_current(fact: DataFrame) -> DataFrame:
    """Q7/A5: natural keys with more than one current row."""
    return (
        fact.where(F.col("is_current"))
        .groupBy(*FKEY)
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .where(F.col("current_rows") > 1)
    )


def invalid_intervals(fact: DataFrame) -> DataFrame:
    """Closed rows whose interval is empty or inverted."""
    return fact.where(
        F.col("effective_to").isNotNull() & (F.col("effective_to") <= F.col("effective_from"))
    )


def target_before_issue(forecasts: DataFrame) -> DataFrame:
    """Q3/F8: forecasts whose target precedes their issue time."""
    return forecasts.where(F.col("forecast_timestamp") < F.col("issued_at"))


def duplicate_observations(fact_observation: DataFrame) -> DataFrame:
    """More than one stored reading per (source, city, hour)."""
    return (
        fact_observation.groupBy(*OKEY)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where(F.col("cnt") > 1)
    )


def missing_observations(fact: DataFrame, fact_observation: DataFrame, as_of) -> DataFrame:
    """Forecast rows whose target hour is before ``as_of`` and
    that have no observation of their city and hour (an anti join, R13).

    ``as_of`` is a parameter (a literal or a scalar Column), never the clock.
    """
    cutoff = as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("timestamp_ntz")
    due = fact.where(F.col("forecast_timestamp") < cutoff)
    seen = fact_observation.select(
        "city_key", F.col("observation_timestamp").alias("forecast_timestamp")
    )
    return due.join(seen, ["city_key", "forecast_timestamp"], "left_anti").agg(
        F.count(F.lit(1)).alias("missing_observation_count")
    )


def join_coverage(forecasts: DataFrame, observations: DataFrame, threshold: float) -> DataFrame:
    """Share of forecasts with an observation of their city and
    hour, compared with ``threshold``. Observation keys are distinct, so the
    left join cannot multiply forecasts."""
    seen = (
        observations.select(
            "city", F.col("observation_timestamp").alias("forecast_timestamp")
        )
        .distinct()
        .withColumn("_seen", F.lit(1))
    )
    f = forecasts.select("city", "forecast_timestamp")
    joined = f.join(seen, ["city", "forecast_timestamp"], "left")
    total = F.count(F.lit(1))
    matched = F.count("_seen")
    return joined.agg(
        total.alias("forecast_count"),
        matched.alias("matched_count"),
        (matched / total).alias("coverage"),
        F.lit(threshold).alias("threshold"),
        ((matched / total) >= F.lit(threshold)).alias("passed"),
    )


def ingestion_lag(forecasts: DataFrame, observations: DataFrame) -> DataFrame:
    """Seconds from the issue (forecast) or the measured hour
    (observation) to ingestion, per event type. Exact min/max/mean: they
    combine map-side, unlike an exact percentile."""

    def lag(df: DataFrame, kind: str, start: str) -> DataFrame:
        secs = (
            F.unix_micros(F.col("ingested_at").cast("timestamp"))
            - F.unix_micros(F.col(start).cast("timestamp"))
        ) / F.lit(1e6)
        return df.select(F.lit(kind).alias("event_type"), secs.alias("lag_seconds"))

    both = lag(forecasts, "forecast", "issued_at").unionByName(
        lag(observations, "observation", "observation_timestamp")
    )
    return both.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("lag_seconds").alias("min_lag_seconds"),
        F.max("lag_seconds").alias("max_lag_seconds"),
        F.avg("lag_seconds").alias("avg_lag_seconds"),
    )


#: Accuracy of the lag sketches: log2 of the items a level holds.
LAG_K = 200
#: Rank error that a sketch of this size stays within (99 % of the time).
LAG_RANK_ERROR = 0.02


def lag_seconds(df: DataFrame, start: str) -> Column:
    return (F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))) / F.lit(1e6)


def lag_sketches(forecasts: DataFrame, observations: DataFrame) -> DataFrame:
    """One mergeable quantile sketch of the ingestion lag for each event
    type and target date. A few kilobytes each, however many events, and
    combined before the shuffle."""
    parts = [
        df.select(F.lit(kind).alias("event_type"), F.col(date).alias("target_date"), lag_seconds(df, start).alias("lag"))
        for df, kind, date, start in (
            (forecasts, "forecast", "forecast_date", "issued_at"),
            (observations, "observation", "observation_date", "observation_timestamp"),
        )
    ]
    return parts[0].unionByName(parts[1]).where("lag is not null").groupBy("event_type", "target_date").agg(
        F.count(F.lit(1)).alias("events"), F.kll_sketch_agg_double("lag", F.lit(LAG_K)).alias("sketch")
    )


def lag_quantiles(sketches: DataFrame, ranks: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Lag at the given ranks by event type, from the merged sketches of any
    range of dates."""
    merged = sketches.groupBy("event_type").agg(
        F.sum("events").alias("events"), F.kll_merge_agg_double("sketch", F.lit(LAG_K)).alias("sketch")
    )
    at = [F.struct(F.lit(r).alias("rank"), F.kll_sketch_get_quantile_double("sketch", F.lit(r)).alias("lag_seconds")) for r in ranks]
    return merged.select("event_type", "events", F.inline(F.array(*at)))


def event_id_duplicates(silver: DataFrame) -> DataFrame:
    """Ids that occur more than once."""
    return (
        silver.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def rule_violations(df: DataFrame, kind: str, temperature_range=R.TEMPERATURE_RANGE_C) -> DataFrame:
    """Q1-Q4, Q11: violations per rule of the declarative rule table, all
    rules counted in one aggregation pass, then turned into rows."""
    rules = R.rules_for(kind, temperature_range)
    counts = df.agg(
        *[F.count(F.when(~r.holds(), 1)).alias(r.name) for r in rules]
    )
    pairs = ", ".join(f"'{r.name}', `{r.name}`" for r in rules)
    return counts.selectExpr(
        f"'{kind}' AS event_type", f"stack({len(rules)}, {pairs}) AS (rule, violations)"
    )


def gate_report(checks: dict[str, DataFrame]) -> DataFrame:
    """Name, number of violations and verdict of each check."""
    out = None
    for name, violations in checks.items():
        n = F.count(F.lit(1))
        row = violations.agg(n.alias("violations"), (n == 0).alias("passed")).select(F.lit(name).alias("gate"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def gate(violations: DataFrame, name: str) -> int:
    """Q10: fail the run when a check returns rows.

    The count is raised inside the plan (``raise_error``), so the job fails
    on the executors with the check's name; it returns the count (0) when
    the check passes."""
    row = violations.agg(F.count(F.lit(1)).alias("n")).select(
        F.when(
            F.col("n") > 0,
            F.raise_error(F.concat(F.lit(f"quality gate {name} failed: "), F.col("n"), F.lit(" rows"))),
        ).alias("_gate"),
        "n",
    ).first()
    return int(row["n"])
