"""Staging, dimension and job plans composed of the operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.calendar import date_spine, dim_date, holidays
from brindle.functions.columns import audit_columns, clean_string
from brindle.operators import checks, exports, loads, shaping
from brindle.operators.filters import in_values, limit_data_in_dev
from brindle.sources.scans import sample_records

#: State and territory codes of the customer dimension's filter.
US_STATES = [
    "AL", "AK", "AS", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FM", "FL", "GA", "GU", "HI", "ID", "IL", "IN", "IA", "KS",
    "KY", "LA", "ME", "MH", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "MP",
    "OH", "OK", "OR", "PW", "PA", "PR", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VI", "VA", "WA", "WV", "WI", "WY",
]


def stage_orders(raw: DataFrame, target: str = "prod", days: int = 3, as_of: datetime | None = None, loaded_at: str | None = None) -> DataFrame:
    """``raw`` (``id``, ``status``, ``amount``, ``created_at``) limited in dev, renamed, cleaned, with audit columns."""
    limited = limit_data_in_dev(raw, "created_at", target, days, as_of)
    cleaned = limited.select(F.col("id").alias("order_id"), clean_string(F.col("status")).alias("status"), "amount", "created_at", *([loaded_at] if loaded_at and loaded_at != "created_at" else []))
    audit = audit_columns(loaded_at, as_of)
    return cleaned.withColumns(audit).select("order_id", "status", "amount", "created_at", *audit)


def dim_customer(raw: DataFrame, states: list[str] = US_STATES, id: str = "id", state: str = "state") -> DataFrame:
    """Customers of the listed states, their key as ``customer_id``."""
    return in_values(raw, state, states).withColumnRenamed(id, "customer_id")


def calendar_of(dates: DataFrame, column: str) -> DataFrame:
    """``start`` and ``end`` of the whole years that a date column spans."""
    d = F.col(column)
    return dates.agg(F.trunc(F.min(d), "year").alias("start"), F.add_months(F.trunc(F.max(d), "year"), 12).alias("end"))


def date_dimension(bounds: DataFrame) -> DataFrame:
    return dim_date(date_spine(bounds), holidays(bounds))


def etl(spark: SparkSession, source_name: str) -> tuple[DataFrame, str]:
    """Extract, transform, summarise: the records and the summary text."""
    records = shaping.enrich(sample_records(spark, source_name))
    return records, f"Pipeline complete for '{source_name}': {shaping.load_summary(records).first()['summary']}"


def run_report(rows: DataFrame, folder: str, headers: dict[str, str] | None = None, files: str | None = None, by: tuple[str, ...] = (), as_of: datetime | None = None) -> str:
    """Rename and export the rows of any query to ``folder``: one file, or one for each value of ``by``, named by
    the template ``files``. Where they lie."""
    named = exports.rename_columns(rows, headers)
    if by:
        exports.export_groups(exports.with_file(named, list(by), files, as_of=as_of), folder)
    else:
        exports.export_one(named, folder)
    return folder


class StepFailed(RuntimeError):
    """A step of the job failed; the steps after it have not run."""


def full_job(spark: SparkSession, raw: dict[str, DataFrame], folder: str, started: datetime, as_of: datetime, target: str = "prod", hours: float = checks.HOURS) -> DataFrame:
    """Load ``orders`` and ``customers``, build the models, test them, judge freshness; the result table of all checks.

    Raises ``StepFailed`` if a test fails, before freshness is looked at.
    """
    placed = loads.load(raw, f"{folder}/raw")
    landed = {name: spark.read.parquet(path) for name, path in placed.items()}
    models = loads.load({"stg_orders": stage_orders(landed["orders"], target, as_of=as_of), "dim_customer": dim_customer(landed["customers"])}, f"{folder}/models")
    orders = spark.read.parquet(models["stg_orders"])
    tests = checks.report(checks.unique(orders, "order_id"), checks.not_null(orders, ["order_id"]), checks.not_empty(orders, "orders_not_empty"))
    failed = [r["check"] for r in tests.where("NOT passed").collect()]  # a row for each check
    if failed:
        raise StepFailed(f"tests failed: {', '.join(failed)}")
    log = orders.agg(F.lit("orders").alias("asset"), F.max("_loaded_at").alias("loaded_at"))
    fresh = checks.freshness(log, log.select("asset"), hours=hours, as_of=as_of)
    late = checks.run_duration(log.limit(1).select(F.lit(started).cast("timestamp_ntz").alias("pipeline_start")), hours=hours, as_of=as_of)
    more = fresh.select(F.concat(F.lit("freshness_"), "asset").alias("check"), F.when(F.col("passed"), 0).otherwise(1).cast("long").alias("failures"), "passed")
    last = late.select(F.lit("run_duration").alias("check"), F.when(F.col("passed"), 0).otherwise(1).cast("long").alias("failures"), "passed")
    return checks.report(tests, more, last)
