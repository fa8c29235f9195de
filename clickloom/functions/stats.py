"""Normal-distribution pieces Spark has no built-in for."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    """P(|Z| >= |z|). Applied to aggregated rows only, never to fact rows."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), na_action="ignore")


def critical_value(confidence_level: float) -> float:
    return NormalDist().inv_cdf(1 - (1 - confidence_level) / 2)
