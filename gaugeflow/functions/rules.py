"""Named classification rules, each one expression.

The thresholds and labels are fixed values: results must equal those of the
tables they replace.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.spec import ROLES, Roles

CHECKS = 5


def ladder(*steps: tuple[Column, str], otherwise: str | None) -> Column:
    """First label whose condition holds."""
    (condition, label), *rest = steps
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def temperature_class(t: Column) -> Column:
    return ladder((t < 0, "Freezing"), (t < 10, "Cold"), (t < 20, "Mild"), (t < 30, "Warm"), otherwise="Hot")


def trend(change: Column) -> Column:
    return ladder((change > 2, "Rising"), (change < -2, "Falling"), otherwise="Stable")


def quality_checks(r: Roles = ROLES) -> Column:
    """How many of the five range and presence checks a row passes."""
    passed = [
        F.col(r.temperature).between(-50, 60),
        F.col(r.humidity).between(0, 100),
        F.col(r.pressure).between(800, 1100),
        F.col(r.wind).between(0, 150),
        F.col(r.category).isNotNull() & F.col(r.description).isNotNull(),
    ]
    total = F.lit(0)
    for check in passed:
        total = total + F.coalesce(check, F.lit(False)).cast("int")
    return total


def in_range(r: Roles = ROLES) -> Column:
    """Acceptance of an incoming record: temperature and humidity within bounds."""
    ok = F.col(r.temperature).between(-50, 60) & F.col(r.humidity).between(0, 100)
    return F.coalesce(ok, F.lit(False))


# --- extreme readings: four rule sets that differ on purpose


def event_detected(r: Roles = ROLES) -> Column:
    """Stored events: a thunderstorm counts as a storm at any wind speed. NULL if none."""
    return ladder(
        (F.col(r.temperature) > 35, "Heatwave"),
        ((F.col(r.wind) > 50) | (F.col(r.category) == "Thunderstorm"), "Storm"),
        (F.col(r.category) == "Rain", "Heavy Rain"),
        otherwise=None,
    )


def event_reported(r: Roles = ROLES) -> Column:
    """Event report: knows cold, and rain only with high humidity."""
    return ladder(
        (F.col(r.temperature) > 35, "Heatwave"),
        (F.col(r.temperature) < -10, "Freezing"),
        (F.col(r.wind) > 50, "Storm"),
        ((F.col(r.category) == "Rain") & (F.col(r.humidity) > 80), "Heavy Rain"),
        otherwise="Normal",
    )


def event_listed(r: Roles = ROLES) -> Column:
    """Event list: heat, wind, rain."""
    return ladder(
        (F.col(r.temperature) > 35, "Heatwave"),
        (F.col(r.wind) > 50, "Storm"),
        (F.col(r.category) == "Rain", "Heavy Rain"),
        otherwise="Other",
    )


def alert_level(r: Roles = ROLES) -> Column:
    """Alert level of a reading."""
    return ladder(
        (F.col(r.temperature) > 35, "Heatwave Alert"),
        (F.col(r.wind) > 50, "Storm Alert"),
        (F.col(r.category) == "Rain", "Rain Alert"),
        otherwise="Normal",
    )


def day_alert(temperature: Column, humidity: Column, wind: Column, category: Column) -> Column:
    return ladder(
        ((temperature > 30) & (humidity > 70), "High Heat & Humidity"),
        (temperature > 30, "Heatwave Risk"),
        (wind > 50, "High Wind Alert"),
        ((category == "Rain") & (humidity > 80), "Heavy Rain Risk"),
        otherwise="Normal",
    )


def anomaly(z: Column) -> Column:
    return ladder(
        (z > 2, "Significantly Above Average"),
        (z < -2, "Significantly Below Average"),
        (z > 1, "Above Average"),
        (z < -1, "Below Average"),
        otherwise="Normal",
    )


def data_health(hours_since: Column, days: Column) -> Column:
    return ladder((hours_since > 4, "Stale"), (days < 7, "Incomplete"), otherwise="Healthy")


def day_completeness(readings: Column) -> Column:
    return ladder((readings >= 20, "Complete"), (readings >= 10, "Partial"), otherwise="Incomplete")


def coverage(readings: Column) -> Column:
    return ladder((readings == 0, "No Data"), (readings < 12, "Partial Data"), otherwise="Complete Data")


def season_anomaly(month: Column, t: Column) -> Column:
    return ladder(
        (month.isin(6, 7, 8) & (t < 10), "Unusually Cold Summer"),
        (month.isin(12, 1, 2) & (t > 15), "Unusually Warm Winter"),
        (month.isin(3, 4, 5) & (t < 0), "Unusually Cold Spring"),
        (month.isin(9, 10, 11) & (t > 25), "Unusually Warm Autumn"),
        otherwise="Normal Season",
    )


# --- severities


def freshness_severity(hours: Column) -> Column:
    return ladder((hours > 24, "critical"), (hours > 4, "warning"), otherwise="info")


def score_severity(score: Column) -> Column:
    return ladder((score < 4, "critical"), (score < 4.5, "warning"), otherwise="info")


def volume_severity(missing: Column) -> Column:
    return ladder((missing > 0.5, "critical"), (missing > 0.2, "warning"), otherwise="info")


def report_severity(critical: Column, warning: Column) -> Column:
    return ladder((critical > 0, "critical"), (warning > 0, "warning"), otherwise="info")


def run_severity(status: Column, error: Column) -> Column:
    """A failed run is critical; a succeeded one that reports an error is a warning."""
    return ladder(
        ((status == "success") & error.isNotNull(), "warning"), (status == "failure", "critical"), otherwise="info"
    )
