"""Business figures over the marts. Line amounts are summed; repeated order totals never are."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F


def month_number(column: str = "order_date"):
    return (F.year(column) * 100 + F.month(column)).alias("month")


def kpi_daily(fact: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Orders, revenue and margin per day; lines fold into orders before days."""
    per_order = (
        fact.where(F.col("order_date") >= F.date_sub(F.lit(as_of), days))
        .groupBy("order_date", "order_id")
        .agg(F.sum("line_total").alias("revenue"), F.sum("gross_margin").alias("margin"))
    )
    return per_order.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin")
    )


def last_days(daily: DataFrame, n: int = 10) -> DataFrame:
    return daily.orderBy(F.desc("order_date")).limit(n)


def revenue_by_month(fact: DataFrame, *dimensions: str) -> DataFrame:
    return fact.groupBy(month_number(), *dimensions).agg(F.sum("line_total").alias("revenue"))


def avg_ticket_by(fact: DataFrame, dimension: str = "channel") -> DataFrame:
    per_order = fact.groupBy(dimension, "order_id").agg(F.sum("line_total").alias("value"))
    return per_order.groupBy(dimension).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("value").alias("revenue"),
        (F.sum("value").cast("double") / F.count(F.lit(1))).alias("avg_ticket"),
    )


def label_distribution(features: DataFrame, label: str = "churn_label") -> DataFrame:
    counts = features.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def monthly_report(fact: DataFrame, features: DataFrame) -> DataFrame:
    """Revenue and margin per month, with the churn rate of the snapshot taken at `report_date`.

    The rate belongs to the month of the snapshot; other months have none.
    """
    money = fact.groupBy(month_number()).agg(
        F.sum("line_total").alias("revenue"), F.sum("gross_margin").alias("margin")
    )
    churn = features.groupBy(month_number("report_date")).agg(
        (F.sum("churn_label") / F.count(F.lit(1))).alias("churn_rate")
    )
    figures = ["revenue", "margin", "churn_rate"]
    stacked = money.unionByName(churn, allowMissingColumns=True)  # one row per month on each side
    return stacked.groupBy("month").agg(*[F.max(c).alias(c) for c in figures])


def scd2_counts(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(F.col("is_current") == 1).alias("current_rows"),
    )


def grain_check(fact: DataFrame) -> DataFrame:
    """Order total summed per line against once per order, and the line amounts themselves."""
    per_order = fact.groupBy("order_id").agg(
        F.max("total_amount").alias("once"), F.sum("total_amount").alias("repeated"), F.sum("line_total").alias("lines")
    )
    return per_order.agg(
        F.sum("repeated").alias("repeated_total"),
        F.sum("once").alias("order_total"),
        F.sum("lines").alias("line_total"),
        (F.sum("repeated").cast("double") / F.sum("once").cast("double")).alias("inflation"),
    )


def gold_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("revenue"))


def gold_freshness(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("order_date").alias("last_order_date"), F.count(F.lit(1)).alias("rows"))
