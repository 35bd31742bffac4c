"""Table schemas from JSON descriptors."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of data types in a descriptor (fixed values).
DATA_TYPES = {
    "STRING": T.StringType(),
    "LONG": T.LongType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BOOLEAN": T.BooleanType(),
}


def schema_from_json(text: str) -> T.StructType:
    """Fields in the order of their offsets; flags and search settings go to the field metadata."""
    fields = sorted(json.loads(text), key=lambda field: field["offset"])
    offsets = [field["offset"] for field in fields]
    if len(set(offsets)) != len(offsets):
        raise ValueError(f"offsets repeat: {offsets}")
    return T.StructType(
        [
            T.StructField(
                field["name"],
                DATA_TYPES[field["dataType"].upper()],
                not field.get("isPrimaryKey", False),
                {k: v for k, v in field.items() if k not in ("name", "dataType")},
            )
            for field in fields
        ]
    )


def primary_key(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if field.metadata.get("isPrimaryKey")]


def unique_fields(schema: T.StructType) -> list[str]:
    """Fields that each have to be unique by themselves, beside the primary key."""
    return [field.name for field in schema if field.metadata.get("isUnique")]


def violations(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns named as in a descriptor -> field, violation, value, n: what breaks it.

    `missing key`: a part of the primary key is null (value null, n rows). `repeated key` and
    `repeated value`: n rows have one primary key or one value of a unique field; nulls repeat
    nothing. `not a TYPE`: n rows have a text that is no such value. A key of several fields is
    shown with all of them, joined by commas. Rows are read once, and each turns into the values to
    be counted, which are combined on the map side: no group is gathered, however often a key repeats.
    """
    keys, entries = primary_key(schema), []

    def entry(field: str, kind: str, value: Column, when: Column, least: int) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(field).alias("field"),
                F.lit(kind).alias("violation"),
                value.alias("value"),
                F.lit(least).alias("least"),
            ),
        )

    if keys:
        name, null = ",".join(keys), F.lit(None).cast("string")
        whole = F.lit(True)
        for key in keys:
            whole &= F.col(key).isNotNull()
            entries.append(entry(key, "missing key", null, F.col(key).isNull(), 1))
        entries.append(entry(name, "repeated key", F.concat_ws(",", *keys), whole, 2))
    for field in unique_fields(schema):
        entries.append(entry(field, "repeated value", F.col(field), F.col(field).isNotNull(), 2))
    names = {kind: name for name, kind in reversed(DATA_TYPES.items())}
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            continue
        text = F.col(field.name)
        bad = text.isNotNull() & text.try_cast(field.dataType).isNull()
        entries.append(entry(field.name, f"not a {names[field.dataType]}", text, bad, 1))
    if not entries:
        return raw.limit(0).selectExpr(
            "'' AS field", "'' AS violation", "'' AS value", "CAST(0 AS BIGINT) AS n"
        )
    found = raw.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    counted = found.groupBy("field", "violation", "value", "least").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= F.col("least")).drop("least")
