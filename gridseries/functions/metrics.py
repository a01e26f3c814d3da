"""Forecast error metrics as aggregate Column expressions.

They are plain aggregates, so ``groupBy(...).agg(*all_metrics(...))`` runs
with partial (map-side) aggregation and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def abs_error(y: Column, yhat: Column) -> Column:
    return F.abs(y - yhat)


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(abs_error(y, yhat))


def rmse(y: Column, yhat: Column) -> Column:
    e = y - yhat
    return F.sqrt(F.avg(e * e))


def mape_percent(y: Column, yhat: Column, epsilon: float = 1e-3) -> Column:
    """Mean absolute percentage error with the denominator floored at ``epsilon``."""
    return F.avg(abs_error(y, yhat) / F.greatest(F.abs(y), F.lit(epsilon))) * F.lit(100.0)


def smape_percent(y: Column, yhat: Column) -> Column:
    """Symmetric MAPE; rows whose denominator is zero are skipped (NULL if none remain)."""
    den = (F.abs(y) + F.abs(yhat)) / F.lit(2.0)
    return F.avg(F.try_divide(abs_error(y, yhat), F.when(den > 0, den))) * F.lit(100.0)


def all_metrics(y: Column, yhat: Column, epsilon: float = 1e-3, prefix: str = "") -> list[Column]:
    return [
        F.count(F.lit(1)).alias(f"{prefix}n"),
        mae(y, yhat).alias(f"{prefix}MAE"),
        rmse(y, yhat).alias(f"{prefix}RMSE"),
        mape_percent(y, yhat, epsilon).alias(f"{prefix}MAPE_percent"),
        smape_percent(y, yhat).alias(f"{prefix}sMAPE_percent"),
    ]
