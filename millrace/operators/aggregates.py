"""Monthly averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_text(moment: Column) -> Column:
    """``yyyy-MM`` of a date or timestamp."""
    return F.date_format(moment, "yyyy-MM")


def _column(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def monthly_average(
    df: DataFrame,
    moment: str | Column,
    area: str | Column,
    value: str | Column,
    area_name: str = "area",
    value_name: str = "temp",
) -> DataFrame:
    """Average of ``value`` per month and area: columns ``ym``, area and value.

    Groups on the first day of the month, a fixed-width key that needs no text formatting per row,
    and formats the month after the aggregation, once per group.
    """
    month_start = F.trunc(_column(moment).cast("date"), "MM")
    return (
        df.groupBy(month_start.alias("_month"), _column(area).alias(area_name))
        .agg(F.avg(_column(value)).alias(value_name))
        .select(month_text(F.col("_month")).alias("ym"), area_name, value_name)
    )


def monthly_totals(df: DataFrame, moment: str | Column, area: str | Column, value: str | Column) -> DataFrame:
    """What an average can be made of later: ``month_start``, ``area``, ``total`` and ``entries``."""
    month_start = F.trunc(_column(moment).cast("date"), "MM")
    return df.groupBy(month_start.alias("month_start"), _column(area).alias("area")).agg(
        F.sum(_column(value)).alias("total"), F.count(_column(value)).alias("entries")
    )


def average_of_totals(totals: DataFrame) -> DataFrame:
    """Monthly averages over any number of :func:`monthly_totals`; the columns of :func:`monthly_average`."""
    summed = totals.groupBy("month_start", "area").agg(F.sum("total").alias("total"), F.sum("entries").alias("entries"))
    average = F.try_divide(F.col("total"), F.col("entries"))
    return summed.select(month_text(F.col("month_start")).alias("ym"), "area", average.alias("temp"))
