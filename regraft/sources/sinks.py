"""Where rows go: appended, updated by key, or as a snapshot to look at.

Each sink writes from the executors. Nothing is left out without a word: columns
that the target lacks widen it, a value that doesn't fit the target's type stops
the write, and so does an id that another row holds. Rows that are there already
as a whole are not added twice, so publishing again after a failure is safe.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regraft.operators.diff import append_rows, column_types, pick
from regraft.operators.integrity import without_existing
from regraft.sources.files import Files

BATCH_ROWS = 10_000
SHOWN = 5
#: After the name of a table that a swap puts aside.
ASIDE = ".aside"


class IdsTaken(ValueError):
    """Rows to publish whose ids other rows of the target hold."""


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with all columns that any of its files has."""
    recovered(spark, path)
    return spark.read.option("mergeSchema", True).parquet(path)


def in_types_of(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows with the target's types where it has the column; their other columns stay.

    A value that the type can't hold raises an error, whatever the session's mode.
    """
    kinds, own = column_types(target.schema), column_types(rows.schema)
    return rows.select(*[strictly(F.col(c), kinds[c]).alias(c) if kinds.get(c, own[c]) != own[c] else c for c in rows.columns])


def fresh_rows(rows: DataFrame, target: DataFrame, keys: Sequence[str] = ("Id",)) -> DataFrame:
    """The rows whose keys the target lacks; stops if an id is held by a row that differs."""
    shaped = in_types_of(rows, target)
    if tuple(keys) == ("Id",):
        shared = [c for c in shaped.columns if c in target.columns]
        held = target.select(*[F.col(c).alias(f"held_{c}") for c in shared])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"held_{c}")) for c in shared])
        # a column that the target lacks would be null there
        same = reduce(and_, [F.col(c).isNull() for c in shaped.columns if c not in shared], same)
        taken = shaped.join(held, F.col("Id") == F.col("held_Id")).where(~same).select("Id").limit(SHOWN)
        if found := [r.Id for r in taken.collect()]:
            raise IdsTaken(f"other rows hold ids of ours, such as {found}")
    return without_existing(shaped, target, keys, nulls_equal=True)


def append_parquet(rows: DataFrame, path: str, keys: Sequence[str] = ("Id",)) -> None:
    """Adds files in the rows' own columns; :func:`read_wide` shows the columns that are new."""
    fresh_rows(rows, read_wide(rows.sparkSession, path), keys).write.mode("append").parquet(path)


def replace_parquet(table: DataFrame, path: str) -> None:
    """Writes a table beside the one at ``path`` and swaps them.

    The old one is put aside under a fixed name and goes last. If the swap fails it
    is put back; if the program ends in the middle of it, :func:`recovered` does so
    before the next read or write.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    files, fresh, old = Files(table.sparkSession, folder), f"{name}-{uuid.uuid4().hex}", f"{name}{ASIDE}"
    recovered(table.sparkSession, path)
    table.write.parquet(f"{folder}/{fresh}")
    there = files.exists(name)
    if there:
        files.remove(old)
        files.rename(name, old)
    try:
        files.rename(fresh, name)
    except OSError:
        if there:
            files.rename(old, name)
        raise
    files.remove(old)


def recovered(spark: SparkSession, path: str) -> None:
    """Puts back the table at ``path`` if a swap put it aside and never ended."""
    folder, _, name = path.rstrip("/").rpartition("/")
    files = Files(spark, folder)
    if not files.exists(name) and files.exists(f"{name}{ASIDE}"):
        files.rename(f"{name}{ASIDE}", name)


def check_keys(updates: DataFrame, key: str) -> None:
    """Stops at updates that repeat a key or lack it: which one counts would be anyone's guess."""
    wrong = updates.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).limit(SHOWN)
    if found := [r[key] for r in wrong.collect()]:
        raise ValueError(f"updates repeat or lack {key}, such as {found}")


def with_updates(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The target as it is now with the updated columns of the keyed rows; keys it lacks are added."""
    renamed = updates.select(*[F.col(c).alias(f"new_{c}") for c in updates.columns])
    joined = target.join(renamed, F.col(key) == F.col(f"new_{key}"), "left")
    hit = F.col(f"new_{key}").isNotNull()
    kept = joined.select(
        *[F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in updates.columns else c for c in target.columns]
    )
    have = target.select(F.col(key).alias("have_key"))
    return append_rows(kept, updates.join(have, F.col(key) == F.col("have_key"), "left_anti"))


def update_parquet(updates: DataFrame, path: str, key: str) -> None:
    """Keyed rows only: what else changed in the table meanwhile stays as it is."""
    check_keys(updates, key)
    replace_parquet(with_updates(read_wide(updates.sparkSession, path), updates, key), path)


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def append_jdbc(rows: DataFrame, table: str, options: Mapping[str, str], keys: Sequence[str] = ("Id",)) -> None:
    """As :func:`append_parquet`; a database isn't widened, columns that its table lacks stop the write."""
    target = read_jdbc(rows.sparkSession, table, options)
    if lacking := [c for c in rows.columns if c not in target.columns]:
        raise ValueError(f"{table} lacks the columns {lacking}")
    writer = fresh_rows(rows, target, keys).write.format("jdbc").options(**options).option("dbtable", table)
    writer.option("batchsize", BATCH_ROWS).mode("append").save()


def update_jdbc(updates: DataFrame, table: str, options: Mapping[str, str], key: str, value: str) -> None:
    """One statement for each row; for settings, of which there is a fixed number of names."""
    context = updates.sparkSession.sparkContext
    properties = context._jvm.java.util.Properties()
    for name, text in options.items():
        properties.setProperty(name, text)
    connection = context._jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        statement = connection.prepareStatement(f"UPDATE {table} SET {value} = ? WHERE {key} = ?")
        for row in updates.select(key, value).collect():
            statement.setString(1, row[value])
            statement.setString(2, row[key])
            statement.executeUpdate()
    finally:
        connection.close()


def snapshot(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """The prepared rows, for review before they are inserted; as text, times keep all their digits."""
    digits = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    writer = rows.write.mode("overwrite").option("header", True).option("timestampNTZFormat", digits)
    writer.option("timestampFormat", f"{digits}XXX").format(form).save(path)


def read_named_csv(spark: SparkSession, path: str, kinds: Mapping[str, str]) -> DataFrame:
    """Columns of a CSV by the names in its header; a missing one or a cell that doesn't fit stops the read."""
    cells = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if lacking := [c for c in kinds if c not in cells.columns]:
        raise ValueError(f"{path} lacks the columns {lacking}")
    if further := [c for c in cells.columns if c not in kinds]:
        raise ValueError(f"{path} has unknown columns {further}")
    return cells.select(*[strictly(F.col(c), kind).alias(c) for c, kind in kinds.items()])


def strictly(cell: Column, kind: str) -> Column:
    """A value as ``kind``; what can't be read or held raises an error, whatever the session's mode."""
    value = cell.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"CAST failed, not {kind}: "), cell.cast("string"))).cast(kind)
    return F.when(cell.isNotNull() & value.isNull(), wrong).otherwise(value)


def overridden(prepared: DataFrame, path: str | None) -> DataFrame:
    """Rows of a CSV in place of the prepared ones, when there is one."""
    if path is None:
        return prepared
    return read_named_csv(prepared.sparkSession, path, column_types(prepared.schema))


def insert_members(target: DataFrame, staged: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """The target with the staged rows whose ``column`` is a new id of ``members``."""
    new = members.select(F.col("new_id").alias("member"))
    chosen = staged.join(new, F.col(column) == F.col("member"), "left_semi")
    return append_rows(target, pick(chosen, target.columns))


def readable(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was finished."""
    return Files(spark, path).exists("_SUCCESS")
