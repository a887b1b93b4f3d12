"""Rounding, unit conversion and reducers chosen by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridzonal.schema import conversions


EXACT_DIGITS = 9
EXACT_BELOW = 1e18


def round_to(value: Column, digits: int = 2) -> Column:
    """Round half up on the decimal value, so that 2.675 gives 2.68 on every engine.

    The decimal has ``EXACT_DIGITS`` places, so more digits are refused. From ``EXACT_BELOW`` on a double has no
    decimals left to round, and the value stays as it is, as do NaN and the infinities.
    """
    if digits > EXACT_DIGITS:
        raise ValueError(f"cannot round to {digits} digits; at most {EXACT_DIGITS} are exact")
    inside = F.abs(value) < F.lit(EXACT_BELOW)
    return F.when(inside, F.round(value.cast("decimal(28,9)"), digits).cast("double")).otherwise(value.cast("double"))


def present(value: Column) -> Column:
    """NaN marks a missing cell in model files; aggregates skip NULL but not NaN."""
    return F.when(~F.isnan(value), value)


def convert_units(
    value: Column,
    variable: Column,
    table: Mapping[str, tuple[float, float, str]] | None = None,
    profile: str = "default",
) -> Column:
    """``value * scale + offset`` by variable.

    The table is a fixed handful of entries, so it is a CASE expression inside the
    projection rather than a join. An unlisted variable stops the job: passing its values
    on unconverted, or dropping them, would both be silent errors.
    """
    rules = conversions(profile) if table is None else table
    result = None
    for name, (scale, offset, _unit) in rules.items():
        converted = value * F.lit(float(scale)) + F.lit(float(offset))
        hit = variable == F.lit(name)
        result = F.when(hit, converted) if result is None else result.when(hit, converted)
    if result is None:
        raise ValueError("the conversion table is empty")
    unknown = F.concat(F.lit("no unit conversion for variable "), F.coalesce(variable, F.lit("NULL")))
    return result.otherwise(F.raise_error(unknown).cast("double"))


REDUCERS: dict[str, Callable[[Column], Column]] = {"mean": F.avg, "max": F.max, "min": F.min}


def reducer(name: str, strict: bool = False) -> Callable[[Column], Column]:
    """The reducer called ``name``; ``strict`` makes one missing input give a missing result."""
    if name not in REDUCERS:
        raise ValueError(f"unknown reducer {name!r}; choose from {sorted(REDUCERS)}")
    plain = REDUCERS[name]
    if not strict:
        return plain
    return lambda value: F.when(F.count(value) == F.count(F.lit(1)), plain(value))
