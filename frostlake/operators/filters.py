"""Row filters and result cleaning that are not part of one layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.functions.columns import nan_to_null as _nan_to_null


def fault_or_breach_condition(healthy_code: str = "0") -> Column:
    """a fault code other than the healthy one, or an SLA breach.

    Three-valued logic is kept: a null code passes only when there is a breach.
    """
    return (F.col("Active_Fault_Code") != F.lit(healthy_code)) | (F.col("SLA_Breach_Flag") == 1)


def fault_or_breach(df: DataFrame, healthy_code: str = "0") -> DataFrame:
    return df.where(fault_or_breach_condition(healthy_code))


def live_present(column: str = "Entering_Chilled_Water_Temperature_Sensor") -> Column:
    """the entering temperature is present."""
    return F.col(column).isNotNull()


def live_non_null(df: DataFrame, column: str = "Entering_Chilled_Water_Temperature_Sensor") -> DataFrame:
    """keep a live reading only when the entering temperature is present."""
    return df.where(live_present(column))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every float/double column.

    Columns are taken by position, so unaliased expressions and columns of
    the same name (``SELECT *`` over a join) pass through.
    """
    fields = df.schema.fields
    places = [f"c{i}" for i in range(len(fields))]
    cols = [
        (_nan_to_null(F.col(c)) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(c)).alias(f.name)
        for c, f in zip(places, fields)
    ]
    return df.toDF(*places).select(*cols)
