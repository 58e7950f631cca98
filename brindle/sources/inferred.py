"""Records without a declared schema: inferred as one aggregate, kept with the table, nested lists as tables of their own."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.sources import ledger


def infer_schema(records: DataFrame, column: str = "value") -> T.StructType:
    """The schema that holds all of a column's JSON texts: an aggregate over variant values, merged before the shuffle.

    Numbers with a point are doubles, whole ones longs, columns that are null everywhere strings. Texts that are no JSON
    objects say nothing. What the driver gets is a schema's text.
    """
    value = F.try_parse_json(column)
    objects = records.where(F.schema_of_variant(value).startswith("OBJECT<"))
    told = objects.agg(F.schema_of_variant_agg(value)).first()[0]
    return declared(told) if told and told.startswith("OBJECT<") else T.StructType()


def declared(variant: str) -> T.StructType:
    """The schema that a variant's schema text stands for."""
    text = re.sub(r"\bOBJECT<", "STRUCT<", variant)
    text = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)|\bFLOAT\b", "DOUBLE", text)
    text = re.sub(r"(?<=[:<] )VOID\b|(?<=<)VOID\b|\bVARIANT\b", "STRING", text)
    return _widest(T.StructType.fromDDL(f"r {text}")["r"].dataType) if text != "STRUCT<>" else T.StructType()


def _widest(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _widest(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_widest(kind.elementType))
    return T.LongType() if isinstance(kind, T.IntegralType) else T.StringType() if isinstance(kind, T.NullType) else kind


def parsed(records: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """One column for each top-level field."""
    return records.select(F.from_json(column, schema).alias("_record")).select("_record.*")


def normalised(df: DataFrame, name: str, key: str) -> dict[str, DataFrame]:
    """Tables of nested records: structs as columns ``outer__inner``, each list as a table ``{name}__{list}`` of its own.

    A list's table has ``key`` of the record it came from, ``_position`` (from 0, of all lists above it from the outside in, joined
    by dots) and its fields, or ``value`` where it holds no structs. Null and empty lists have no rows; ``key`` names a
    top-level column that tells records apart.
    """
    out: dict[str, DataFrame] = {}

    def add(table: str, rows: DataFrame, kept: list[str]) -> None:
        """``rows``: columns ``kept`` and ``_item``, a struct."""
        flat: list[Column] = []
        lists: list[tuple[str, Column]] = []

        def walk(kind: T.StructType, at: Column, prefix: str) -> None:
            for f in kind:
                if isinstance(f.dataType, T.StructType):
                    walk(f.dataType, at[f.name], f"{prefix}{f.name}__")
                elif isinstance(f.dataType, T.ArrayType):
                    lists.append((f"{prefix}{f.name}", at[f.name]))
                else:
                    flat.append(at[f.name].alias(f"{prefix}{f.name}"))

        walk(rows.schema["_item"].dataType, F.col("_item"), "")
        out[table] = rows.select(*kept, *flat)
        for label, items in lists:
            place = "_position" if "_position" in kept else None
            exploded = rows.select(F.col(key) if key in kept else F.col("_item")[key].alias(key), *[F.col(p).alias("_above") for p in [place] if p], F.posexplode(items).alias("_at", "_item"))
            position = F.concat_ws(".", *(["_above"] if place else []), F.col("_at").cast("string")).alias("_position")
            kind = exploded.schema["_item"].dataType
            item = F.col("_item") if isinstance(kind, T.StructType) else F.struct(F.col("_item").alias("value"))
            add(f"{table}__{label}", exploded.select(key, position, item.alias("_item")), [key, "_position"])

    add(name, df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_item")), [])
    return out


def load_records(spark: SparkSession, records: DataFrame, folder: str, name: str, key: str, column: str = "value", writer: str | None = None, batch: int = 0) -> dict[str, str]:
    """Append JSON records to a table with a ledger, and their nested lists to tables beside it; where each lies.

    Each table has a commit of its own. With ``writer`` a load is that writer's numbered ``batch``: run again after a crash
    between two of them, it adds to each table what that one lacks and doubles nothing (``ledger.append_once``).

    A table's schema is in its ledger, so a load reads no earlier file to learn it: the batch's own schema is inferred and
    merged with that one (``ledger.evolved``), new columns come last.
    """
    tables = normalised(parsed(records, infer_schema(records, column), column), name, key)
    for table, df in tables.items():
        if writer is None:
            ledger.append(df, f"{folder}/{table}")
        else:
            ledger.append_once(df, f"{folder}/{table}", writer, batch)
    return {table: f"{folder}/{table}" for table in tables}
