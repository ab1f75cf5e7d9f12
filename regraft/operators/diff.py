"""Differences between frames and between schemas; widening and upserting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_COLUMNS = "Field STRING, Type STRING, Null STRING, Key STRING, Default STRING, Extra STRING"


def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def _rows_in(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    shared = _shared(rows, other)
    have = other.select(*[F.col(c).alias(f"have_{c}") for c in shared]).distinct()
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"have_{c}")) for c in shared])
    return rows.select(*shared).join(have, on, how)


def frame_difference(first: DataFrame, second: DataFrame, which: str | None = None) -> DataFrame:
    """Rows on one side only, labelled ``left_only`` (second) or ``right_only`` (first).

    Compares all shared columns with nulls equal and keeps repeats. ``which``
    picks one label; ``both`` gives the rows the two have in common, each once
    with ``copies``: how many pairs its repeats on the two sides make. They are
    counted and not paired, as a row repeated often on both would swamp a task.
    """

    def labelled(frame: DataFrame, label: str) -> DataFrame:
        return frame.withColumn("_merge", F.lit(label))

    if which == "left_only":
        return labelled(_rows_in(second, first, "left_anti"), "left_only")
    if which == "right_only":
        return labelled(
            _rows_in(first, second, "left_anti").select(*_shared(second, first)), "right_only"
        )
    if which == "both":
        return labelled(_common_rows(second, first), "both")
    return frame_difference(first, second, "left_only").unionByName(
        frame_difference(first, second, "right_only")
    )


def _common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    shared = _shared(left, right)
    sides = left.select(*shared, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*shared, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counted = sides.groupBy(*shared).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return counted.where("l > 0 AND r > 0").select(*shared, F.expr("l * r AS copies"))


def schema_rows(spark: SparkSession, schema: T.StructType, key: str = "Id") -> DataFrame:
    """A schema as rows, one per column."""
    rows = [
        (
            f.name,
            f.dataType.simpleString(),
            "YES" if f.nullable else "NO",
            "PRI" if f.name == key else "",
            None,
            "",
        )
        for f in schema.fields
    ]
    return spark.createDataFrame(rows, SCHEMA_COLUMNS)


def column_types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def missing_columns(source: T.StructType, target: T.StructType) -> dict[str, str]:
    """Columns, with their types, the source has and the target lacks."""
    have = set(target.names)
    return {name: kind for name, kind in column_types(source).items() if name not in have}


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Widen a frame with empty columns; those it has already stay."""
    new = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(new) if new else df


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The target with the rows added; columns either side lacks are null."""
    return target.unionByName(rows, allowMissingColumns=True)


def upsert(target: DataFrame, rows: DataFrame, key: str = "Id") -> DataFrame:
    """Replace target rows of the same key by the new row, whole; add the others."""
    untouched = target.join(rows.select(F.col(key).alias("new_key")), F.col(key) == F.col("new_key"), "left_anti")
    return append_rows(untouched, rows)
