"""Aggregate helpers whose result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEGREE_SUM = "decimal(38,12)"
PICO_SUM = "decimal(30,0)"

_PICO = 10**12
_LOW_BITS = 24


def pico_degrees(name: str) -> Column:
    """Degrees as a whole number of 10^-12 degrees: as exact as the double itself."""
    return F.expr(f"bigint(rint({name} * {_PICO}D))")


def pico_sums(name: str) -> list[Column]:
    """Exact sum of a pico-degree column as two long sums.

    Splitting the number keeps every partial sum a primitive long, which is far
    cheaper than decimals per row and holds for 5 x 10^11 rows in one group.
    """
    return [
        F.expr(f"sum(shiftright({name}, {_LOW_BITS}))").alias(f"{name}_high"),
        F.expr(f"sum({name} & {(1 << _LOW_BITS) - 1}L)").alias(f"{name}_low"),
    ]


def joined_sum(name: str) -> Column:
    """The exact pico-degree total of the two long sums."""
    return F.expr(
        f"cast(cast({name}_high AS decimal(19,0)) * {1 << _LOW_BITS} + {name}_low AS {PICO_SUM})"
    )


def rounded_mean(total: str, rows: str) -> Column:
    """Mean degrees from a pico-degree total, rounded half-up to six decimals.

    Whole-number arithmetic: a tie is always rounded up, never left to the
    order in which doubles were added.
    """
    unit = f"(cast({rows} AS decimal(19,0)) * 1000000)"
    return F.expr(f"sign({total}) * ((2 * abs({total}) + {unit}) div (2 * {unit})) / 1000000D")


def mean_of_sum(total: Column, rows: Column) -> Column:
    """Mean from an exact decimal sum and a count, divided before it becomes a double.

    The double then is the nearest to the true mean, so a later decimal
    rounding sees a tie as a tie.
    """
    return (total.cast("decimal(26,12)") / rows.cast("decimal(12,0)")).cast("double")


def weighted_sum(value: Column, weight: Column) -> Column:
    """Exact sum of degrees times an integer weight."""
    return F.sum((value.cast("decimal(16,12)") * weight.cast("decimal(18,0)")).cast(DEGREE_SUM))


def describe(value: Column, name: str) -> list[Column]:
    """count, mean, sample std, min, quartiles and max of one column."""
    value = value.cast("double")
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return [
        F.count(value).alias(f"{name}_count"),
        F.avg(value).alias(f"{name}_mean"),
        F.stddev_samp(value).alias(f"{name}_std"),
        F.min(value).alias(f"{name}_min"),
        quartiles.getItem(0).alias(f"{name}_p25"),
        quartiles.getItem(1).alias(f"{name}_p50"),
        quartiles.getItem(2).alias(f"{name}_p75"),
        F.max(value).alias(f"{name}_max"),
    ]
