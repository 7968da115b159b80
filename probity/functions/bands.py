"""Conditional bands and flags as column expressions (``when`` chains).

All thresholds below are fixed values taken from the specification of each
band; they are parameters where the reference treats them as such.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def risk_level_pair(avg_ai: Column | str) -> Column:
    """Average AI score >= 0.7 High, >= 0.4 Medium, else Low."""
    x = _c(avg_ai)
    return F.when(x >= 0.7, "High").when(x >= 0.4, "Medium").otherwise("Low")


def risk_level_collusion(matches: Column | str) -> Column:
    """Matching questions >= 10 High, >= 5 Medium, else Low."""
    x = _c(matches)
    return F.when(x >= 10, "High").when(x >= 5, "Medium").otherwise("Low")


def suspicion_from_count(n: Column | str, threshold: int = 5) -> Column:
    """min(n / threshold, 1.0) -- the pair suspicion score of C3."""
    return F.least(_c(n).cast("double") / F.lit(float(threshold)), F.lit(1.0))


def risk_level_suspicion(score: Column | str) -> Column:
    """Score >= 0.7 High, >= 0.4 Medium, else Low."""
    x = _c(score)
    return F.when(x >= 0.7, "High").when(x >= 0.4, "Medium").otherwise("Low")


def risk_level_attempt(ai: Column | str) -> Column:
    """C4: < 0.3 Low Risk, < 0.7 Medium Risk, else High Risk."""
    x = _c(ai)
    return F.when(x < 0.3, "Low Risk").when(x < 0.7, "Medium Risk").otherwise("High Risk")


def ai_usage_band(ai: Column | str) -> Column:
    """> 0.85 High, >= 0.70 Medium-high, >= 0.50 Medium, else Low."""
    x = _c(ai)
    return (F.when(x > 0.85, "High").when(x >= 0.70, "Medium-high")
            .when(x >= 0.50, "Medium").otherwise("Low"))


def suspicion_band(score: Column | str) -> Column:
    """< 0.30 green, < 0.70 yellow, else red."""
    x = _c(score)
    return F.when(x < 0.30, "green").when(x < 0.70, "yellow").otherwise("red")


def irregularity_band(score: Column | str) -> Column:
    """> 0.60 suspicious, >= 0.40 borderline, else normal."""
    x = _c(score)
    return F.when(x > 0.60, "suspicious").when(x >= 0.40, "borderline").otherwise("normal")


def similarity_band(score: Column | str) -> Column:
    """> 0.80 strong, >= 0.60 possible, else coincidental."""
    x = _c(score)
    return F.when(x > 0.80, "strong").when(x >= 0.60, "possible").otherwise("coincidental")


# Fixed values (C9): documented interpretation bands.  Values in the gaps
# between documented bands are ``unclassified``.
#   response time (s): 10-30 ai_fast, 60-180 normal, 200-300 struggling
#   accuracy (%):      85-95 ai_high, 70-85 good, 50-70 average, 30-50 struggling
#   stddev (s):        < 10 automation, 30-60 human, > 100 inconsistent


def response_time_band(rt: Column | str) -> Column:
    x = _c(rt)
    return (F.when(x.between(10, 30), "ai_fast").when(x.between(60, 180), "normal")
            .when(x.between(200, 300), "struggling").otherwise("unclassified"))


def accuracy_band(acc: Column | str) -> Column:
    x = _c(acc)
    return (F.when((x >= 85) & (x <= 95), "ai_high").when((x >= 70) & (x < 85), "good")
            .when((x >= 50) & (x < 70), "average").when((x >= 30) & (x < 50), "struggling")
            .otherwise("unclassified"))


def variance_band(sd: Column | str) -> Column:
    x = _c(sd)
    return (F.when(x < 10, "automation").when(x.between(30, 60), "human")
            .when(x > 100, "inconsistent").otherwise("unclassified"))


def session_indicators(tabs: Column | str = "tab_switches",
                       focus: Column | str = "focus_loss_count",
                       idle: Column | str = "idle_time_seconds",
                       duration_minutes: Column | str = "duration_minutes") -> list[Column]:
    """Tabs > 10; focus losses > 5; idle > 30 % of the exam duration."""
    return [
        (_c(tabs) > 10).alias("excessive_tab_switches"),
        (_c(focus) > 5).alias("excessive_focus_loss"),
        (_c(idle) > _c(duration_minutes) * 60 * 0.3).alias("excessive_idle"),
    ]


def flag_attempt(ai: Column | str, threshold: float = 0.7) -> Column:
    """C11: flagged = ai_usage_score > 0.7."""
    return _c(ai) > F.lit(threshold)


def ai_usage_bucket(ai: Column | str) -> Column:
    """A15 buckets: [0, .3) low, [.3, .7) medium, [.7, 1.0) high, else other
    (exactly 1.0 and null land in ``other``)."""
    x = _c(ai)
    return (F.when((x >= 0.0) & (x < 0.3), "low").when((x >= 0.3) & (x < 0.7), "medium")
            .when((x >= 0.7) & (x < 1.0), "high").otherwise("other"))
