"""Column functions of staging models, reports and checks: ``Column`` in, ``Column`` out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NULL_TOKEN = "_null_"
ESCAPE = "\x1b"


def clean_string(c: Column) -> Column:
    """Lower case, blanks cut at both ends, empty becomes null."""
    return F.nullif(F.trim(F.lower(c)), F.lit(""))


def safe_divide(n: Column, d: Column) -> Column:
    """``n / d`` as doubles; null where ``d`` is null or 0."""
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(n.cast("double") / d.cast("double"))


def iso_day_of_week(d: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(d) + 1


def day_of_quarter(d: Column) -> Column:
    return F.datediff(d, F.trunc(d, "quarter")) + 1


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def at(as_of: datetime | None) -> Column:
    """The given moment without time zone, else the query's own."""
    return (F.current_timestamp() if as_of is None else F.lit(as_of)).cast("timestamp_ntz")


def audit_columns(loaded_at: str | None = None, as_of: datetime | None = None) -> dict[str, Column]:
    """``_loaded_at`` (a given column, else now) and ``_updated_at`` (now), for ``withColumns``."""
    return {"_loaded_at": F.col(loaded_at) if loaded_at else at(as_of), "_updated_at": at(as_of)}


def case_map(c: Column, mapping: dict) -> Column:
    """``CASE`` without ``ELSE``: values that are not named become null."""
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return F.lit(None).cast("string") if out is None else out


def surrogate_key(*columns: Column) -> Column:
    """MD5 of the values as text, joined by ``-``, with a token for null."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns]))


def epoch_ms_to_timestamp(ms: Column, zone: str = "UTC", source_zone: str = "UTC") -> Column:
    """Whole seconds of an epoch in milliseconds, as a local time of ``zone``."""
    utc = F.timestamp_seconds(F.floor(ms / 1000)).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), utc)


def quoted_name(c: Column) -> Column:
    """An identifier in backticks, its own ones doubled."""
    return F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`"))


def maintenance_command(schema: Column, table: Column) -> Column:
    return F.concat(F.lit("ANALYZE TABLE "), quoted_name(schema), F.lit("."), quoted_name(table), F.lit(" COMPUTE STATISTICS;"))


def hours_between(later: Column, earlier: Column) -> Column:
    """Hours between two timestamps, two decimals."""
    return F.round(seconds_between(later, earlier) / 3600, 2)


def seconds_between(later: Column, earlier: Column) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(later) - micros(earlier)) / 1e6


def shortened(c: Column, size: int = 500) -> Column:
    """The first characters of a message."""
    return F.left(c, F.lit(size))


def without_escapes(c: Column) -> Column:
    return F.replace(c, F.lit(ESCAPE), F.lit(""))


def all_matches(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def first_match(c: Column, pattern: str, default: str, group: int = 1) -> Column:
    """The first match, or ``default`` where there is none or the text is null."""
    return F.coalesce(F.nullif(F.regexp_extract(c, pattern, group), F.lit("")), F.lit(default))


def test_name(unique_id: Column) -> Column:
    """The part after ``test.dw.`` up to the next dot; null without it."""
    return F.nullif(F.substring_index(F.get(F.split(unique_id, r"test\.dw\."), F.lit(1)), ".", 1), F.lit(""))


def short_message(message: Column) -> Column:
    """Up to the first comma; a text for null and empty."""
    return F.coalesce(F.substring_index(F.nullif(message, F.lit("")), ",", 1), F.lit("No message"))


def file_name(columns: list[str], pattern: str | None = None, functions: dict[str, Callable[[Column], Column]] | None = None, as_of: datetime | None = None, extension: str = "csv") -> Column:
    """Of each row's group: ``pattern`` with every ``{column}`` replaced, else the values joined by ``_``.

    ``functions`` changes single values first; ``as_of`` adds ``_YYYYMMDD``; the extension follows a dot.
    """
    value = {c: (functions or {}).get(c, lambda x: x)(F.col(c)).cast("string") for c in columns}
    if pattern is None:
        name = F.concat_ws("_", *value.values())
    else:
        name = F.lit(pattern)
        for c, v in value.items():
            name = F.replace(name, F.lit("{" + c + "}"), v)
    parts = [name] + ([F.lit("_"), F.date_format(F.lit(as_of), "yyyyMMdd")] if as_of else [])
    return F.concat(*parts, F.lit("." + extension))


#: The same functions for ``spark.sql``.
SQL_FUNCTIONS = {
    "clean_string": ("c STRING", "STRING", "nullif(trim(lower(c)), '')"),
    "safe_divide": ("n DOUBLE, d DOUBLE", "DOUBLE", "CASE WHEN d IS NULL OR d = 0 THEN NULL ELSE n / d END"),
    "iso_day_of_week": ("d DATE", "INT", "weekday(d) + 1"),
    "in_dev_window": ("c TIMESTAMP_NTZ, target STRING, days INT, as_of DATE", "BOOLEAN", "target <> 'dev' OR c >= CAST(date_sub(as_of, days) AS TIMESTAMP_NTZ)"),
    "loaded_at": ("c TIMESTAMP_NTZ, now TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "coalesce(c, now)"),
    "day_of_quarter": ("d DATE", "INT", "datediff(d, trunc(d, 'quarter')) + 1"),
    "is_weekend": ("d DATE", "BOOLEAN", "weekday(d) >= 5"),
    "quoted_name": ("s STRING", "STRING", "concat('`', replace(s, '`', '``'), '`')"),
    "short_message": ("s STRING", "STRING", "coalesce(substring_index(nullif(s, ''), ',', 1), 'No message')"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create temporary SQL functions; their names."""
    for name, (arguments, kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    return list(SQL_FUNCTIONS)
