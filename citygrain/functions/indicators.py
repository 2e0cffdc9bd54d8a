"""Affordability and quality-of-life formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citygrain.functions.numbers import clip, round_even

# Weights of the score, share of noise and air in the pressure index, flat size.
QUALITY_WEIGHTS = {"noise": 0.30, "air": 0.30, "high_noise": 0.25, "environment": 0.15}
NOISE_PRESSURE = 60.0
AIR_PRESSURE = 40.0
REFERENCE_FLAT_M2 = 50


def months_income(price_m2: Column, income: Column) -> Column:
    """Months of median income that one square metre costs."""
    return round_even(F.try_divide(price_m2, income / 12.0), 2)


def rent_effort(rent_m2: Column, income: Column) -> Column:
    """Share of the monthly income that the reference flat's rent takes, in percent."""
    return round_even(F.try_divide(rent_m2 * REFERENCE_FLAT_M2, income / 12.0) * 100.0, 1)


def social_per_100_sales(units: Column, transactions: Column) -> Column:
    ratio = F.try_divide(units.cast("double"), transactions.cast("double")) * 100.0
    return round_even(F.coalesce(ratio, F.lit(0.0)), 1)


def _class_excess(score: Column) -> Column:
    """Class 1..3 to 0..1."""
    return (score - 1.0) / 2.0


def environmental_pressure(noise: Column, air: Column) -> Column:
    raw = _class_excess(noise) * NOISE_PRESSURE + _class_excess(air) * AIR_PRESSURE
    return round_even(clip(raw, 0.0, 100.0), 1)


def quality_of_life(noise: Column, air: Column, high_noise_pct: Column, pressure: Column) -> Column:
    """Weighted score out of ten; each ingredient is first turned into 1 = good, 0 = bad."""
    good = {
        "noise": 1.0 - _class_excess(noise),
        "air": 1.0 - _class_excess(air),
        "high_noise": 1.0 - high_noise_pct / 100.0,
        "environment": 1.0 - pressure / 100.0,
    }
    total = None
    for name, weight in QUALITY_WEIGHTS.items():
        term = F.lit(weight) * clip(good[name], 0.0, 1.0)
        total = term if total is None else total + term
    return round_even(F.lit(10.0) * total, 2)
