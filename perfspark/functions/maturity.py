"""Maturity classification from skeletal age and predicted adult height."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import round_py


def maturity_offset(skeletal_age: Column, age: Column) -> Column:
    """Skeletal minus chronological age, two decimals."""
    return round_py(skeletal_age - age, 2)


def maturity_status(offset: Column) -> Column:
    """One year behind or more is Late, one ahead or more is Early."""
    return (F.when(offset <= -1, "Late").when(offset >= 1, "Early")
            .when(offset.isNotNull(), "Normal"))


def growth_phase(pct_adult_height: Column) -> Column:
    """Peak-height-velocity band of the share of predicted adult height reached."""
    return (F.when(pct_adult_height < 85, "Pre PHV").when(pct_adult_height < 90, "Approaching PHV")
            .when(pct_adult_height < 96, "Circa PHV")
            .when(pct_adult_height.isNotNull(), "Post PHV"))
