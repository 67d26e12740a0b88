"""Date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.functions import date_key
from dimwright.operators.joins import balanced_join


def date_dimension(
    df: DataFrame, date_col: Column | str, existing: DataFrame | None = None
) -> DataFrame:
    """One row per distinct date of ``date_col``.

    With ``existing`` only the dates it does not hold are returned. The
    distinct runs on the bare date, so partial aggregation leaves at most one
    row per date and task to shuffle.
    """
    day = F.col(date_col) if isinstance(date_col, str) else date_col
    days = df.select(day.cast("date").alias("dt_data_completa")).distinct()
    dim = days.filter(F.col("dt_data_completa").isNotNull()).select(
        date_key("dt_data_completa").alias("dt_sk"),
        "dt_data_completa",
        (F.dayofweek("dt_data_completa") - 1).alias("dt_dia_semana"),  # 0 = Sunday
        F.dayofmonth("dt_data_completa").alias("dt_dia_mes"),
        F.month("dt_data_completa").alias("dt_mes"),
        F.year("dt_data_completa").alias("dt_ano"),
        F.quarter("dt_data_completa").alias("dt_trimestre"),
    )
    if existing is None:
        return dim
    return balanced_join(dim, existing.select("dt_sk"), "dt_sk", "left_anti")
