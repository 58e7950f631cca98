"""Filters of models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.columns import at

#: Lists up to this long are literals, which reach the scan; longer ones are joined.
LITERAL_VALUES = 200


def limit_data_in_dev(df: DataFrame, column: str, target: str, days: int = 3, as_of: datetime | None = None) -> DataFrame:
    """In target ``dev`` the rows of the last ``days`` days, inclusive, without null dates; in others all rows."""
    if target != "dev":
        return df
    return df.where(F.col(column) >= F.date_sub(at(as_of).cast("date"), days).cast("timestamp_ntz"))


def in_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is listed; an empty list keeps none."""
    if len(values) <= LITERAL_VALUES:
        return df.where(F.col(column).isin(values)) if values else df.where(F.lit(False))
    kind = df.schema[column].dataType.simpleString()
    listed = df.sparkSession.createDataFrame([(v,) for v in values], f"_value {kind}").distinct()
    return df.join(listed, F.col(column) == F.col("_value"), "left_semi")


def active_statements(activity: DataFrame, pattern: str = "%ANALYZE%", own: str = "%activity%") -> DataFrame:
    """Statements that are not idle and match a pattern, but for those that look at the activity itself."""
    q = F.col("query")
    return activity.where((F.col("state") != "idle") & q.ilike(pattern) & ~q.ilike(own))
