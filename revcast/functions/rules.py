"""Declarative row rules (F1, F2, Q1-Q4, Q11).

A rule is ``(name, predicate, severity)``. A row is valid when every
``error`` rule holds; a NULL predicate counts as a failure (D6), so nothing
can fall between the good and the bad output.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The physical ranges the validation accepts (inclusive).
TEMPERATURE_RANGE_C = (-100.0, 70.0)
PROBABILITY_RANGE_PCT = (0.0, 100.0)


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Callable[[], Column]
    severity: str = "error"

    def holds(self) -> Column:
        """TRUE only when the predicate is TRUE; NULL becomes FALSE."""
        return F.coalesce(self.predicate(), F.lit(False))


def _not_null(c: str) -> Callable[[], Column]:
    return lambda: F.col(c).isNotNull()


def _temperature(lo: float, hi: float) -> Callable[[], Column]:
    return lambda: F.col("temperature_2m_c").between(lo, hi)


def forecast_rules(temperature_range=TEMPERATURE_RANGE_C) -> list[Rule]:
    lo, hi = temperature_range
    plo, phi = PROBABILITY_RANGE_PCT
    return [
        Rule("event_id_present", _not_null("event_id")),
        Rule("city_present", _not_null("city")),
        Rule("issued_at_parses", _not_null("issued_at")),
        Rule("forecast_timestamp_parses", _not_null("forecast_timestamp")),
        Rule(
            "target_not_before_issue",
            lambda: F.col("forecast_timestamp") >= F.col("issued_at"),
        ),
        Rule("temperature_in_range", _temperature(lo, hi)),
        Rule(
            "precipitation_probability_in_range",
            lambda: F.col("precipitation_probability_pct").isNull()
            | F.col("precipitation_probability_pct").between(plo, phi),
        ),
    ]


def observation_rules(temperature_range=TEMPERATURE_RANGE_C) -> list[Rule]:
    lo, hi = temperature_range
    return [
        Rule("event_id_present", _not_null("event_id")),
        Rule("city_present", _not_null("city")),
        Rule("observation_timestamp_parses", _not_null("observation_timestamp")),
        Rule("temperature_in_range", _temperature(lo, hi)),
    ]


def rules_for(kind: str, temperature_range=TEMPERATURE_RANGE_C) -> list[Rule]:
    if kind == "forecast":
        return forecast_rules(temperature_range)
    if kind == "observation":
        return observation_rules(temperature_range)
    raise ValueError(f"no rules for event type {kind}")


def all_hold(rules: list[Rule]) -> Column:
    cond = F.lit(True)
    for rule in rules:
        if rule.severity == "error":
            cond = cond & rule.holds()
    return cond


def failed_names(rules: list[Rule]) -> Column:
    """Names of the rules a row breaks, in rule order."""
    names = F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules])
    return F.filter(names, lambda n: n.isNotNull())
