"""Search history and position lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import pyfn
from palimpsest.operators import predicates, sequence


def newest_first(history: DataFrame, date: str, tie: str) -> DataFrame:
    return history.orderBy(F.col(date).desc(), tie)


def with_recency(history: DataFrame, date: str, tie: str) -> DataFrame:
    """history with position, 0 for the newest row."""
    aged = history.withColumn("__age__", -F.unix_micros(F.col(date).cast("timestamp"))).withColumn("__all__", F.lit(0))
    return sequence.positions(aged, ["__all__"], ["__age__", tie]).drop("__age__", "__all__")


def as_json(history: DataFrame) -> DataFrame:
    return history.select(F.to_json(F.struct(*history.columns)).alias("json"))


def fibonacci(n: int) -> int:
    """The value at a position from 1: 0, 1, 1, 2, … by doubling."""
    a, b = 0, 1
    for bit in bin(n - 1)[2:]:
        a, b = a * (2 * b - a), a * a + b * b
        if bit == "1":
            a, b = b, a + b
    return a


def looked_up(positions: DataFrame, position: str) -> DataFrame:
    """positions with value, the number at a valid position as text, and message for the others."""
    checked = positions.withColumn("message", predicates.number_message(F.col(position)))
    asked = checked.withColumn("__n__", F.when(F.col("message").isNull(), F.trim(F.col(position))))
    return pyfn.with_columns(asked, ["__n__"], "value string", lambda n: (None if n is None else str(fibonacci(int(n))),)).drop("__n__")


def fibonacci_table(spark: SparkSession, upto: int) -> DataFrame:
    """position and value for 1 to ``upto``."""
    return looked_up(spark.range(1, upto + 1).select(F.col("id").cast("string").alias("position")), "position").select(F.col("position").cast("int"), "value")


def message(position: Column) -> Column:
    return predicates.number_message(position)
