"""Numeric witness checks over parameter grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import columns as c
from corpusgate.operators import linking, ordering


def sweep(rows: DataFrame, name: str, value: Column, **axes: Sequence[float]) -> DataFrame:
    """Evaluate a column expression on every row and every combination of the axis values."""
    return linking.parameter_grid(rows, **axes).withColumn(name, value)


def out_of_bounds(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows whose value leaves ``[low, high]``; NaN leaves it too."""
    v = F.col(value)
    return df.where((v < low) | (v > high) | F.isnan(v))


def not_equal(df: DataFrame, a: Column, b: Column, rel_tol: float = 1e-9, abs_tol: float = 1e-12) -> DataFrame:
    """Rows where two expressions that must agree do not (product invariance, homogeneity)."""
    return df.where(~F.coalesce(c.is_close(a, b, rel_tol, abs_tol), F.lit(False)))


def grid_monotone_breaks(df: DataFrame, fixed: Sequence[str], argument: str, value: str, tol: float = 1e-9) -> DataFrame:
    """Breaks of monotonicity in one argument with the others fixed."""
    return ordering.monotone_breaks(df, fixed, [argument], value, tol)


def unexpected_nan(df: DataFrame, value: str, in_domain: Column) -> DataFrame:
    """Rows that are NaN inside the domain or a number outside it."""
    return df.where(F.isnan(F.col(value)) == in_domain)
