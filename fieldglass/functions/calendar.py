"""Calendar and Fourier expressions over a time column."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Monday is day 0 of the week."""
    return {
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "year": F.year(ts),
        "day_of_year": F.dayofyear(ts),
    }


def fourier_columns(ts: Column, periods: Sequence[int] = (7, 30, 365), orders: Sequence[int] = (1, 2, 3)) -> dict[str, Column]:
    out = {}
    for period in periods:
        for order in orders:
            angle = F.lit(order * 2 * pi) * F.dayofyear(ts) / F.lit(period)
            out[f"sin_{period}_{order}"] = F.sin(angle)
            out[f"cos_{period}_{order}"] = F.cos(angle)
    return out


def day_of_week_flags(ts: Column) -> dict[str, Column]:
    return {f"day_of_week_{i}": (F.weekday(ts) == i).cast("int") for i in range(7)}


def month_flags(ts: Column) -> dict[str, Column]:
    return {f"month_{i}": (F.month(ts) == i).cast("int") for i in range(1, 13)}


def hour_flags(ts: Column) -> dict[str, Column]:
    return {f"hour_{i}": (F.hour(ts) == i).cast("int") for i in range(24)}
