"""Risk, dependence and growth classes. Every threshold is a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds from the most to the least severe class.
CONCENTRATION_STEPS = (("HIGH RISK", 2500.0, 50.0), ("MEDIUM RISK", 1500.0, 40.0))
DEPENDENCE_STEPS = (("CRITICAL", 5.0, 40.0), ("HIGH", 2.0, 15.0), ("MODERATE", 0.5, 4.0))
CONCENTRATION_POINTS = {"HIGH RISK": 3, "MEDIUM RISK": 2}
DEPENDENCE_POINTS = {"CRITICAL": 3, "HIGH": 2, "MODERATE": 1}
COMBINED_STEPS = (("EXTREME RISK", 7.5), ("HIGH RISK", 5.0), ("MODERATE RISK", 3.0))


def _either(first: Column, second: Column, steps, default: str) -> Column:
    """First class of which either threshold is reached; nulls reach none."""
    result = F.lit(default)
    for name, first_floor, second_floor in reversed(steps):
        result = F.when((first >= first_floor) | (second >= second_floor), name).otherwise(result)
    return result


def concentration_class(hhi: Column, top_share: Column, steps=CONCENTRATION_STEPS) -> Column:
    return _either(hhi, top_share, steps, "LOW RISK")


def dependence_class(share: Column, billions: Column, steps=DEPENDENCE_STEPS) -> Column:
    return _either(share, billions, steps, "LOW")


def _points(c: Column, table: dict[str, int], default: int) -> Column:
    result = F.lit(default)
    for name, points in table.items():
        result = F.when(c == name, points).otherwise(result)
    return result


def combined_score(concentration: Column, dependence: Column) -> Column:
    """Points of both classes on a scale of 0 to 10."""
    points = _points(concentration, CONCENTRATION_POINTS, 1) + _points(
        dependence, DEPENDENCE_POINTS, 0
    )
    return points / F.lit(6.0) * 10


def combined_class(score: Column, steps=COMBINED_STEPS) -> Column:
    result = F.lit("LOW RISK")
    for name, floor in reversed(steps):
        result = F.when(score >= floor, name).otherwise(result)
    return result


def growth_class(growth: Column) -> Column:
    return (
        F.when(growth > 0, "growing").when(growth < 0, "shrinking").when(growth == 0, "stable")
    )
