"""Scalar expressions on readings; all of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, digits: int) -> Column:
    """Scale, round to the nearest integer with ties to even, scale back (NumPy's rule)."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def health_score(battery: Column, temp: Column, voltage: Column, rate: Column) -> Column:
    """0..100 summary of a vehicle: charge 40, temperature 30, voltage 20, discharge 10 points.

    The discharge term has a floor but no ceiling, so a charging vehicle can earn more
    than 10 points there; only the total is limited.
    """
    # fixed values: weights and operating ranges of the score
    charge = battery / F.lit(100.0) * F.lit(40.0)
    heat = F.greatest(
        F.lit(0.0),
        F.lit(30.0) - F.greatest(F.lit(0.0), temp - F.lit(40.0)) * F.lit(30.0 / 80.0),
    )
    volts = clamp((voltage - F.lit(300.0)) / F.lit(80.0) * F.lit(20.0), 0.0, 20.0)
    drain = F.greatest(F.lit(0.0), F.lit(10.0) - rate / F.lit(1.5) * F.lit(10.0))
    return clamp(charge + heat + volts + drain, 0.0, 100.0)


def relative_deviation(x: Column, mean: Column) -> Column:
    """``|x - mean| / |mean|``; 0 where the mean is 0 or unknown."""
    return F.coalesce(F.abs(F.try_divide(x - mean, mean)), F.lit(0.0))


def worsened(current: Column, previous: Column, factor: float) -> Column:
    """True when a score moved further from zero than ``factor`` times the earlier one."""
    return F.abs(current) > F.abs(previous) * F.lit(float(factor))


def unit_label(prefix: str, number: Column) -> Column:
    """Zero-padded label of at least three digits; longer numbers stay whole."""
    return F.format_string(prefix.replace("%", "%%") + "%03d", number)


def number_text(x: Column) -> Column:
    """A double as text: shortest digits, plain from 0.0001 up to sixteen digits, else with an exponent."""
    shown = x.cast("string")
    mantissa = F.split_part(shown, F.lit("E"), F.lit(1))
    power = F.split_part(shown, F.lit("E"), F.lit(2)).try_cast("int")
    sign = F.when(x < 0, "-").otherwise("")
    digits = F.regexp_replace(F.regexp_replace(mantissa, "^-|[.]", ""), "(.)0$", "$1")
    whole = F.rpad(digits, power + 1, "0")
    rest = F.substring(digits, power + 2, F.lit(20))
    plain = F.when(power >= 0, F.concat(
        sign, F.substring(whole, F.lit(1), power + 1), F.lit("."), F.when(rest == "", "0").otherwise(rest)))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    tail = F.substring(digits, 2, 20)
    scientific = F.concat(
        sign, F.substring(digits, 1, 1), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)), F.lit("e"),
        F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), F.greatest(
            F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return (
        F.when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf")))
        .when(power.isNull(), shown).when((power >= 0) & (power < 16), plain)
        .when((power < 0) & (power >= -4), small).otherwise(scientific)
    )
