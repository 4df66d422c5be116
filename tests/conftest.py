from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandtide.session import build_session

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(shuffle_partitions=4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def make_series(spark):
    """Values to a series; a dict gives one series per key ``k``."""

    def make(values, start="2024-01-01", test_size=0.2):
        groups = values if isinstance(values, dict) else {None: values}
        parts = []
        for k, y in groups.items():
            t = np.arange(len(y), dtype="int64")
            pdf = pd.DataFrame({"ts": pd.Timestamp(start) + pd.to_timedelta(t, "h"), "idx": t, "n": np.int64(len(y)), "y": np.asarray(y, dtype=float)})
            if k is not None:
                pdf.insert(0, "k", k)
            parts.append(pdf)
        df = spark.createDataFrame(pd.concat(parts)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        return df.withColumn("cut", F.floor(F.col("n") * (1 - test_size)).cast("bigint"))

    return make


def season(n=960, seed=0):
    t = np.arange(n)
    return 50 + 0.01 * t + 10 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(seed).normal(size=n)


def rmse(df):
    return df.agg(F.sqrt(F.avg((F.col("y") - F.col("pred")) * (F.col("y") - F.col("pred"))))).collect()[0][0]


def ordered(df, *cols, keys=("idx",)):
    pdf = df.toPandas().sort_values(list(keys)).reset_index(drop=True)
    return pdf[list(cols)] if cols else pdf
