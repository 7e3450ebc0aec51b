"""Compatibility folding, which Spark has no function for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v), na_action="ignore")
