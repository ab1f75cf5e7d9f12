"""Key/value settings: lookup, update, ordered list union, switching off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regraft.functions.columns import list_union


def setting(settings: DataFrame, name: str) -> Column:
    """Value of one setting as a scalar subquery; null when it is not there."""
    return settings.where(F.col("Name") == name).agg(F.max("Value").alias("Value")).scalar()


def set_values(settings: DataFrame, updates: DataFrame) -> DataFrame:
    """Put in the values of ``updates(Name, Value)``; unknown names do nothing."""
    new = updates.select(F.col("Name").alias("new_name"), F.col("Value").alias("new_value"))
    return settings.join(new, F.col("Name") == F.col("new_name"), "left").select(
        *[
            F.coalesce("new_value", "Value").alias(c) if c == "Value" else F.col(c)
            for c in settings.columns
        ]
    )


def merged_lists(source: DataFrame, target: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(Name, Value)`` of the list settings that gain something from the source."""
    added = source.where(F.col("Name").isin(*names)).select(
        F.col("Name").alias("source_name"), F.col("Value").alias("source_value")
    )
    merged = list_union("Value", "source_value")
    return (
        target.where(F.col("Name").isin(*names))
        .join(added, F.col("Name") == F.col("source_name"), "inner")
        .select("Name", merged.alias("Value"), F.col("Value").alias("old_value"))
        .where(F.col("Value") != F.col("old_value"))
        .drop("old_value")
    )


def switched_off(settings: DataFrame, names: Sequence[str]) -> DataFrame:
    """Settings in ``names`` that are ``1`` become ``0``."""
    on = F.col("Name").isin(*names) & (F.col("Value") == "1")
    return settings.withColumn("Value", F.when(on, F.lit("0")).otherwise(F.col("Value")))
