"""Checks of declared constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose reference is not null and points nowhere."""
    p = parent.select(F.col(parent_key).alias("_k"))
    return child.filter(F.col(key).isNotNull()).join(p, F.col(key) == F.col("_k"), "left_anti")


def invalid_status(df: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    return df.filter(~F.coalesce(F.col(column).isin(*vocabulary), F.lit(False)))


def missing_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)
