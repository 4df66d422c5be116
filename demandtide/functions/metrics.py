"""Forecast error measures as aggregate expressions: one pass, partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("MAE", "RMSE", "MAPE", "SMAPE", "R2")
HIGHER_IS_BETTER = ("R2",)


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def mape(y: Column, p: Column) -> Column:
    """Percent, over rows with y <> 0; NULL when there is none."""
    return F.avg(F.when(y != 0, F.abs((y - p) / y))) * 100


def smape(y: Column, p: Column) -> Column:
    """Percent, 0 to 200; rows where both values are 0 do not count."""
    half = (F.abs(y) + F.abs(p)) / 2
    return F.avg(F.when(half != 0, F.abs(y - p) / half)) * 100


def r2(y: Column, p: Column) -> Column:
    """1 - SSres/SStot over rows with a prediction. ``var_pop`` merges centred moments, so one pass stays stable."""
    y = F.when(p.isNotNull(), y)
    sse = F.sum((y - p) * (y - p))
    n = F.count(y)
    sst = F.var_pop(y) * n
    return F.when(n >= 2, F.when(sst > 0, 1 - sse / F.nullif(sst, F.lit(0.0))).otherwise(F.when(sse == 0, 1.0).otherwise(0.0)))


def all_metrics(y: Column, p: Column) -> list[Column]:
    return [
        mae(y, p).alias("MAE"),
        rmse(y, p).alias("RMSE"),
        mape(y, p).alias("MAPE"),
        smape(y, p).alias("SMAPE"),
        r2(y, p).alias("R2"),
    ]
