"""Tables of a Spark catalog as a target: read, widened, appended to and updated there.

Where the catalog's table format takes ``MERGE`` (row-level operations), updates go
through it. The formats built into Spark don't, so there the table is written anew
beside the old one, under a name of its own, and the names are exchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regraft.operators.diff import column_types
from regraft.sources.sinks import check_keys, fresh_rows, in_types_of, with_updates


def quoted(name: str) -> str:
    """A name of one to three parts, each in back quotes."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def missing_columns(target: StructType, rows: StructType) -> list[str]:
    """Columns to add, as ``name type``; names are compared as Spark does, whatever their case."""
    there = {f.name.lower() for f in target.fields}
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.fields if f.name.lower() not in there]


def widen_table(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """Adds the columns that a table lacks; its rows have nulls there. Returns the table."""
    if lacking := missing_columns(spark.table(quoted(table)).schema, rows.schema):
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({', '.join(lacking)})")
    return spark.table(quoted(table))


def in_columns_of(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows with all columns of the target, in its order; those they lack are null."""
    named = {c.lower(): c for c in rows.columns}
    kinds = column_types(target.schema)
    return rows.select(*[
        F.col(named[c.lower()]).alias(c) if c.lower() in named else F.lit(None).cast(kinds[c]).alias(c) for c in target.columns
    ])


def append_table(rows: DataFrame, table: str, keys: Sequence[str] = ("Id",)) -> None:
    """Rows that the table lacks, in its types; a column it lacks is added to it first."""
    spark = rows.sparkSession
    target = widen_table(spark, table, rows)
    spelled = {c.lower(): c for c in target.columns}
    rows = rows.select(*[F.col(c).alias(spelled[c.lower()]) for c in rows.columns])
    fresh = in_columns_of(fresh_rows(rows, target, keys), target)
    fresh.write.mode("append").insertInto(quoted(table))


def update_table(updates: DataFrame, table: str, key: str) -> None:
    """Columns of keyed rows set anew, keys that the table lacks added; updates have each key once."""
    check_keys(updates, key)
    spark = updates.sparkSession
    target = widen_table(spark, table, updates)
    updates = in_types_of(updates, target)
    view = f"updates_{uuid.uuid4().hex}"
    updates.createOrReplaceTempView(view)
    try:
        _merge(spark, table, view, updates.columns, key)
    except PySparkException as refused:
        if refused.getCondition() != "UNSUPPORTED_FEATURE.TABLE_OPERATION":
            raise
        _exchange(spark, table, with_updates(target, updates, key))
    finally:
        spark.catalog.dropTempView(view)


def _merge(spark: SparkSession, table: str, view: str, columns: Sequence[str], key: str) -> None:
    rest = [c for c in columns if c != key]
    sets = f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.`{c}` = u.`{c}`' for c in rest)}" if rest else ""
    names, values = ", ".join(f"`{c}`" for c in columns), ", ".join(f"u.`{c}`" for c in columns)
    spark.sql(
        f"MERGE INTO {quoted(table)} AS t USING {view} AS u ON t.`{key}` = u.`{key}` {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def _exchange(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Puts a table written beside it in the place of one; the old one goes last."""
    space, _, name = table.rpartition(".")
    beside = lambda what: f"{space}.{name}_{what}" if space else f"{name}_{what}"
    fresh, old = beside(f"fresh_{uuid.uuid4().hex}"), beside("aside")
    recovered_table(spark, table)
    kind = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Provider'").first()
    rows.write.format(kind.data_type if kind else "parquet").saveAsTable(quoted(fresh))
    spark.sql(f"DROP TABLE IF EXISTS {quoted(old)}")
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(old)}")
    try:
        spark.sql(f"ALTER TABLE {quoted(fresh)} RENAME TO {quoted(table)}")
    except Exception:
        spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(table)}")
        raise
    spark.sql(f"DROP TABLE {quoted(old)}")


def recovered_table(spark: SparkSession, table: str) -> None:
    """Gives a table its name back that an exchange put aside and never ended."""
    if not spark.catalog.tableExists(quoted(table)) and spark.catalog.tableExists(quoted(f"{table}_aside")):
        spark.sql(f"ALTER TABLE {quoted(f'{table}_aside')} RENAME TO {quoted(table)}")
