"""An application: a named set of tables with a reader behind it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regraft.operators.diff import append_rows, column_types, schema_rows
from regraft.operators.ids import high_water
from regraft.operators.settings import setting
from regraft.sources.catalog import quoted, recovered_table
from regraft.sources.ledger import Book

Reader = Callable[[str], DataFrame]


def even_split(low: int | None, high: int | None, parallelism: int) -> dict[str, str]:
    """Options of a JDBC read in ranges of ids, two for each core; none for an empty table."""
    if low is None or high is None:
        return {}
    parts = max(1, min(2 * parallelism, high - low + 1))
    return {"partitionColumn": "Id", "lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(parts)}


class App:
    """Tables by name. Immutable: changes give a new ``App``."""

    def __init__(
        self,
        name: str,
        reader: Reader,
        tables: Mapping[str, DataFrame] | None = None,
        next_ids: Mapping[str, int] | None = None,
        place: str = "",
    ) -> None:
        self.name = name
        self.place = place
        self._reader = reader
        self._tables = dict(tables or {})
        self._next_ids = dict(next_ids or {})

    @classmethod
    def of(cls, name: str, tables: Mapping[str, DataFrame], **kwargs) -> App:
        def absent(table: str) -> DataFrame:
            raise KeyError(f"{name} has no table {table}")

        return cls(name, absent, tables, **kwargs)

    @classmethod
    def parquet(cls, spark: SparkSession, name: str, root: str, **kwargs) -> App:
        """Tables of a folder, all as its ledger has them now, whatever is published later."""
        return cls(name, Book(spark, root).read, place=root, **kwargs)

    @classmethod
    def catalog(cls, spark: SparkSession, name: str, database: str, **kwargs) -> App:
        """Tables of a database in a catalog of the session."""

        def read(table: str) -> DataFrame:
            recovered_table(spark, f"{database}.{table}")
            return spark.table(quoted(f"{database}.{table}"))

        return cls(name, read, place=f"catalog:{database}", **kwargs)

    @classmethod
    def jdbc(
        cls,
        spark: SparkSession,
        name: str,
        options: Mapping[str, str],
        split: Mapping[str, Mapping[str, str]] | None = None,
        **kwargs,
    ) -> App:
        """``split[table]`` holds partitionColumn, lowerBound, upperBound, numPartitions.

        Without it a table with a whole-number ``Id`` is split evenly between
        its least and greatest, which the database is asked for; other tables
        are read by one task.
        """

        def read(table: str) -> DataFrame:
            reader = spark.read.format("jdbc").options(**options)
            how = (split or {}).get(table)
            if how is None:
                kinds = dict(reader.option("dbtable", table).load().dtypes)
                if kinds.get("Id") in ("int", "bigint"):
                    asked = reader.option("dbtable", f"(SELECT MIN(Id) AS low, MAX(Id) AS high FROM {table}) AS bounds")
                    how = even_split(*asked.load().first(), spark.sparkContext.defaultParallelism)
            return spark.read.format("jdbc").options(**{**options, **(how or {}), "dbtable": table}).load()

        return cls(name, read, place=options["url"], **kwargs)

    def table(self, name: str, columns: Sequence[str] = ()) -> DataFrame:
        """A table, or the named columns of it only; they are pruned in the scan."""
        if name not in self._tables:
            self._tables[name] = self._reader(name)
        table = self._tables[name]
        return table.select(*columns) if columns else table

    def count(self, table: str, where: str | None = None) -> DataFrame:
        """One row ``(rows)``; the predicate follows three-valued SQL logic."""
        rows = self.table(table)
        return (rows.where(where) if where else rows).agg(F.count("*").alias("rows"))

    def columns(self, table: str) -> list[str]:
        return self.table(table).columns

    def column_types(self, table: str) -> dict[str, str]:
        return column_types(self.table(table).schema)

    def schema_rows(self, table: str) -> DataFrame:
        frame = self.table(table)
        return schema_rows(frame.sparkSession, frame.schema)

    def next_id(self, table: str) -> Column:
        """Next free id: as given for the table, else one past the greatest."""
        given = self._next_ids.get(table)
        greatest = high_water(self.table(table, ["Id"]))
        return greatest if given is None else F.greatest(greatest, F.lit(given))

    def setting(self, name: str) -> Column:
        return setting(self.table("AppSetting"), name)

    def replaced(self, **tables: DataFrame) -> App:
        return App(self.name, self._reader, {**self._tables, **tables}, self._next_ids, self.place)

    def appended(self, **rows: DataFrame) -> App:
        """The app as it will be once the rows are in."""
        return self.replaced(**{t: append_rows(self.table(t), r) for t, r in rows.items()})
