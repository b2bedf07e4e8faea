"""Explicit schemas of the input tables, and a check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


def cases_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _table(
        ("case_id", id_type),
        ("intake_ts", T.TimestampNTZType()),
        ("case_type", T.StringType()),
        ("tier", T.StringType()),
        ("team_tz", T.StringType()),
        ("intake_date", T.DateType()),
    )


def events_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return _table(
        ("event_id", T.StringType()),
        ("case_id", id_type),
        ("status", T.StringType()),
        ("event_ts", T.TimestampNTZType()),
        ("ingestion_ts", T.TimestampNTZType()),
        ("event_tz", T.StringType()),
        ("is_duplicate", T.BooleanType()),
        ("is_late_arriving", T.BooleanType()),
        ("intake_date", T.DateType()),
    )


CALENDAR = _table(
    ("cal_date", T.DateType()),
    ("dow", T.ShortType()),
    ("is_weekend", T.BooleanType()),
    ("is_holiday", T.BooleanType()),
    ("holiday_name", T.StringType()),
)

STAFFING = _table(
    ("shift_date", T.DateType()),
    ("team_tz", T.StringType()),
    ("shift_name", T.StringType()),
    ("shift_start_hour", T.IntegerType()),
    ("shift_end_hour", T.IntegerType()),
    ("planned_agents", T.IntegerType()),
    ("shrinkage_rate", T.DoubleType()),
    ("deterioration_multiplier", T.DoubleType()),
    ("effective_agents", T.IntegerType()),
)


def require(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Return the columns of ``schema`` in order; fail where one is absent or typed otherwise.

    Whole numbers of another width are cast.
    """
    found = {f.name: f.dataType for f in df.schema.fields}

    def fits(have: T.DataType | None, want: T.DataType) -> bool:
        whole = isinstance(have, T.IntegralType) and isinstance(want, T.IntegralType)
        return whole or have == want

    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        f"{found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in schema.fields
        if not fits(found.get(f.name), f.dataType)
    ]
    if wrong:
        raise ValueError(f"{table} does not fit its schema: " + "; ".join(wrong))
    return df.select(
        *[
            F.col(f.name) if found[f.name] == f.dataType else F.col(f.name).cast(f.dataType)
            for f in schema.fields
        ]
    )
