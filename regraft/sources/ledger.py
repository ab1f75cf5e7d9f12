"""All tables of a folder published together: files first, then one ledger that readers follow.

A publish writes new files below ``_versions`` of the folder, table by table, where
no reader looks. When all are there it writes the next ledger, a small file that
names for each table the folders its rows are in. Readers go by the greatest ledger.
Until it is there they see every table as it was; from then on, every table as it is
now. Nothing that a ledger names is moved, renamed or rewritten, so a publish that
fails, at whatever point, leaves files that nobody reads and no harm else.

A folder without a ledger is read as it lies: the tables are its folders.

Two publishes at once: the ledger's file is made only if it isn't there, so the
later of the two stops with ``Overtaken`` and can be repeated on the new state. On
stores where making a file isn't exclusive, let one publish at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from regraft.sources.files import Files
from regraft.sources.sinks import check_keys, in_types_of, read_wide

LEDGERS, VERSIONS = "_ledgers", "_versions"
#: Ranges that the ids of an updated table are cut into, each a folder of its own.
RANGES = 64


class Overtaken(RuntimeError):
    """Another publish was finished since this one began."""


@dataclass(frozen=True)
class Part:
    """A folder of rows, below the root. ``low`` and ``high`` bound the values of ``key`` in it, where they are known."""

    path: str
    key: str | None = None
    low: str | None = None
    high: str | None = None


@dataclass
class Ledger:
    """What readers see: a number, and for each table its parts and its schema."""

    number: int = 0
    tables: dict[str, list[Part]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        parts = {t: [[p.path, p.key, p.low, p.high] for p in own] for t, own in self.tables.items()}
        return json.dumps({"number": self.number, "tables": parts, "schemas": self.schemas}, sort_keys=True)

    @classmethod
    def of(cls, text: str) -> Ledger:
        read = json.loads(text)
        return cls(read["number"], {t: [Part(*p) for p in own] for t, own in read["tables"].items()}, read["schemas"])


class Book:
    """The tables of a folder as its greatest ledger has them, and the way to the next one."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.files = spark, Files(spark, root)
        self.root = self.files.root
        self.ledger = self._latest()

    def _latest(self) -> Ledger:
        numbers = [int(n) for n in self.files.names(LEDGERS) if n.isdigit()]
        return Ledger.of(self.files.read(f"{LEDGERS}/{max(numbers):012d}")) if numbers else Ledger()

    def parts(self, table: str) -> list[Part]:
        return self.ledger.tables.get(table) or ([Part(table)] if self.files.exists(table) else [])

    def read(self, table: str) -> DataFrame:
        """A table with all columns that any of its parts has.

        With a ledger the schema comes from there; the footers of all files are
        read only once for a table that never was in one.
        """
        parts = self.parts(table)
        if not parts:
            raise KeyError(f"{self.root} has no table {table}")
        if schema := self.ledger.schemas.get(table):
            return self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*self._paths(parts))
        return read_wide(self.spark, f"{self.root}/{parts[0].path}")

    def _paths(self, parts: Sequence[Part]) -> list[str]:
        return [f"{self.root}/{p.path}" for p in parts]

    def begin(self) -> Publish:
        return Publish(self)


class Publish:
    """New parts of any number of tables, seen by nobody until :meth:`commit`."""

    def __init__(self, book: Book) -> None:
        self.book = book
        self.name = f"{VERSIONS}/{book.ledger.number + 1:012d}-{uuid.uuid4().hex}"
        self.tables: dict[str, list[Part]] = {}
        self.schemas: dict[str, StructType] = {}

    def parts(self, table: str) -> list[Part]:
        return self.tables.get(table) or self.book.parts(table)

    def read(self, table: str) -> DataFrame:
        """The table as it will be."""
        if table not in self.tables:
            return self.book.read(table)
        return self.book.spark.read.schema(self.schemas[table]).parquet(*self.book._paths(self.tables[table]))

    def append(self, table: str, rows: DataFrame, key: str = "Id") -> None:
        """Further rows in the table's types; a column that the table lacks widens it."""
        if self.parts(table):
            before = self.read(table)
            rows, before = in_types_of(rows, before), before.schema
        else:
            before = StructType()
        path = f"{self.name}/{table}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.book.root}/{path}")
        part = Part(path)
        if key in rows.columns and isinstance(rows.schema[key].dataType, NumericType):
            written = self.book.spark.read.schema(rows.schema).parquet(f"{self.book.root}/{path}")
            low, high = written.agg(F.min(key).cast("string"), F.max(key).cast("string")).first()
            part = Part(path, key, low, high)
        self._set(table, [*self.parts(table), part], widened(before, rows.schema))

    def replace(self, table: str, rows: DataFrame) -> None:
        """The whole table anew."""
        path = f"{self.name}/{table}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.book.root}/{path}")
        self._set(table, [Part(path)], rows.schema)

    def update(self, table: str, updates: DataFrame, key: str) -> None:
        """Columns of keyed rows set anew, keys that the table lacks added; updates have each key once.

        Only parts that may hold one of the keys are written again: those whose
        bounds include one. A part whose bounds aren't known is cut into ranges
        of keys then, so that a later update rewrites little of it.
        """
        check_keys(updates, key)
        before = self.read(table)
        updates, schema = in_types_of(updates, before), widened(before.schema, updates.schema)
        touched, kept = self._touched(table, updates, key)
        if touched:
            rows = self.book.spark.read.schema(schema).parquet(*self.book._paths(touched))
            updates = with_changes(rows, updates, key, schema)
        # a key of a part that is kept would lie within its bounds
        self._set(table, [*kept, *self._cut(table, updates, key)], schema)

    def _touched(self, table: str, updates: DataFrame, key: str) -> tuple[list[Part], list[Part]]:
        parts = self.parts(table)
        known = [p for p in parts if p.key == key and p.low is not None]
        hit = {p.path for p in parts if p not in known}
        if known:
            kind = updates.schema[key].dataType.simpleString()
            spans = F.array(*[F.struct(F.lit(p.path).alias("path"), F.lit(p.low).cast(kind).alias("low"), F.lit(p.high).cast(kind).alias("high")) for p in known])
            inside = F.filter(spans, lambda s: F.col(key).between(s["low"], s["high"]))
            # at most one row for each of the table's parts
            found = updates.select(F.explode(F.transform(inside, lambda s: s["path"])).alias("path")).distinct()
            hit |= {r.path for r in found.collect()}
        return [p for p in parts if p.path in hit], [p for p in parts if p.path not in hit]

    def _cut(self, table: str, rows: DataFrame, key: str) -> list[Part]:
        """Rows written in one folder for each range of keys, with the bounds that the keys in it really have."""
        base = f"{self.name}/{table}-{uuid.uuid4().hex}"
        dealt = rows.repartitionByRange(RANGES, key).withColumn("_range", F.spark_partition_id())
        dealt.write.partitionBy("_range").parquet(f"{self.book.root}/{base}")
        written = self.book.spark.read.schema(StructType([*rows.schema.fields, *dealt.select("_range").schema.fields])).parquet(f"{self.book.root}/{base}")
        ends = written.groupBy("_range").agg(F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high"))
        return [Part(f"{base}/_range={r._range}", key, r.low, r.high) for r in sorted(ends.collect())]

    def _set(self, table: str, parts: list[Part], schema: StructType) -> None:
        self.tables[table], self.schemas[table] = parts, schema

    def commit(self) -> Ledger:
        """The next ledger, with what wasn't touched as it was."""
        last = self.book.ledger
        schemas = {t: json.dumps(s.jsonValue()) for t, s in self.schemas.items()}
        following = Ledger(last.number + 1, {**last.tables, **self.tables}, {**last.schemas, **schemas})
        if not self.book.files.create(f"{LEDGERS}/{following.number:012d}", following.text()):
            raise Overtaken(f"ledger {following.number} of {self.book.root} is there already")
        self.book.ledger = following
        return following


def widened(before: StructType, rows: StructType) -> StructType:
    """A schema with further columns at its end, all of which may be null."""
    names = set(before.fieldNames())
    out = StructType([*before.fields, *(f for f in rows.fields if f.name not in names)])
    for f in out.fields:
        f.nullable = True
    return out


def with_changes(rows: DataFrame, updates: DataFrame, key: str, schema: StructType) -> DataFrame:
    """Rows with the updated columns, and updates whose key they lack, in the schema's columns."""
    hit = updates.withColumn("_hit", F.lit(True)).select(F.col(key).alias("_key"), "_hit", *[F.col(c).alias(f"new_{c}") for c in updates.columns])
    joined = rows.join(hit, F.col(key).eqNullSafe(F.col("_key")), "full")
    pick = lambda c: F.when(F.col("_hit"), F.col(f"new_{c}")).otherwise(F.col(c)) if c in updates.columns else F.col(c)
    kinds = {f.name: f.dataType for f in schema.fields}
    return joined.select(*[pick(c).cast(kinds[c]).alias(c) for c in schema.fieldNames()])


def unread(book: Book) -> list[str]:
    """Folders of versions that the current ledger names nothing of: left by failed or older publishes."""
    named = {p.path.split("/")[1] for own in book.ledger.tables.values() for p in own if p.path.startswith(VERSIONS)}
    return sorted(n for n in book.files.names(VERSIONS) if n not in named)
