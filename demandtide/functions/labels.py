"""Names of models and methods as shown in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title(name: Column) -> Column:
    """``lag_regression`` becomes ``Lag Regression``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def last_part(name: Column) -> Column:
    """The part after the last underscore, used to name one file per method."""
    return F.element_at(F.split(name, "_"), -1)


def file_name(name: Column) -> Column:
    """``Lag Regression`` becomes ``lag_regression``: lower case, no white space."""
    return F.regexp_replace(F.lower(F.trim(name)), r"\s+", "_")


def metric_line(model: Column, *values: Column) -> Column:
    """One line of the metrics report."""
    return F.format_string("%-20s" + " %10.2f" * len(values), model, *values)
