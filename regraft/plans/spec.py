"""Declared table moves: what a table's rows need on their way to the target.

Keys are settled on a narrow frame of the id and foreign key columns only. The
other columns join it once, by the row's old id, whatever the number of foreign
keys; the two scans read different columns, so nothing is read twice. One or two
numbers or dates ride along with the keys: that is less than a join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from regraft.operators.ids import fill_new_ids
from regraft.operators.match import Keep, buckets_of, lazily
from regraft.operators.relationship import Relationship
from regraft.operators.remap import remap, remap_list, remap_or_default, with_hot_answers

Relationships = Mapping[str, Relationship]

#: Columns besides the keys that are carried through their joins rather than joined at the end.
MOST_RIDING = 2
SMALL = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)


@dataclass(frozen=True)
class TableSpec:
    """One table. Relationship names are the values of the mappings.

    ``parents``: foreign keys that must resolve, or the row stays behind.
    ``lookups``: foreign keys that become null when they do not resolve.
    ``fallbacks``: foreign keys that take a value given at the time when they do not.
    ``lists``: comma-separated lists of foreign keys.
    ``constants``: columns set to one value.
    ``numbers_all``: ids are given before rows are dropped, which leaves gaps.
    """

    table: str
    offset: int = 0
    parents: Mapping[str, str] = field(default_factory=dict)
    lookups: Mapping[str, str] = field(default_factory=dict)
    fallbacks: Mapping[str, str] = field(default_factory=dict)
    lists: Mapping[str, str] = field(default_factory=dict)
    strict_lists: bool = True
    constants: Mapping[str, object] = field(default_factory=dict)
    numbers_all: bool = False
    identities: tuple[int, ...] = ()


@dataclass(frozen=True)
class Moved:
    """Rows to append, ids given, and the ids of the rows really kept."""

    rows: DataFrame
    relationship: Relationship
    kept: Relationship


@dataclass(frozen=True)
class Outcome:
    """What a transfer leaves: rows to append, settings ``(Name, Value)`` to update, relationships."""

    rows: Mapping[str, DataFrame] = field(default_factory=dict)
    updated: Mapping[str, DataFrame] = field(default_factory=dict)
    rels: Mapping[str, Relationship] = field(default_factory=dict)

    def and_then(self, other: Outcome) -> Outcome:
        return Outcome(
            {**self.rows, **other.rows},
            {**self.updated, **other.updated},
            {**self.rels, **other.rels},
        )


def _typed(rows: DataFrame, name: str, value: object) -> str:
    """A constant as an expression, in the column's type where it exists."""
    if name in rows.columns:
        kind = rows.schema[name].dataType.simpleString()
    else:
        kind = "bigint" if isinstance(value, int) else "string"
    text = "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)
    return f"CAST({text} AS {kind}) AS `{name}`"


def set_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Set columns to one value each; columns the frame lacks come at the end."""
    if not constants:
        return df
    added = [c for c in constants if c not in df.columns]
    return df.selectExpr(
        *[_typed(df, c, constants[c]) if c in constants else f"`{c}`" for c in df.columns],
        *[_typed(df, c, constants[c]) for c in added],
    )


def _named(names: Mapping[str, str], rels: Relationships) -> dict[str, Relationship]:
    return {column: rels[name] for column, name in names.items()}


def _with_parents(spec: TableSpec, keys: DataFrame, rels: Relationships) -> DataFrame:
    parents = with_hot_answers(keys, _named(spec.parents, rels))
    return remap(keys, parents, required=True, row_id="old_id")


def _keys(spec: TableSpec, rows: DataFrame) -> list[str]:
    return [c for c in (*spec.parents, *spec.lookups, *spec.fallbacks) if c in rows.columns]


def _riding(spec: TableSpec, rows: DataFrame) -> list[str]:
    """The other columns, if they are so few and small that they ride along with the keys."""
    settled = {"Id", *_keys(spec, rows), *spec.constants}
    rest = [f for f in rows.schema if f.name not in settled]
    small = len(rest) <= MOST_RIDING and all(isinstance(f.dataType, SMALL) and f.name not in spec.lists for f in rest)
    return [f.name for f in rest] if small else []


def _narrow(spec: TableSpec, rows: DataFrame, whole: bool) -> DataFrame:
    riding = _riding(spec, rows) if whole else []
    return rows.selectExpr(
        "CAST(Id AS BIGINT) AS old_id",
        "CAST(NULL AS BIGINT) AS new_id",
        *[f"`{c}`" for c in (*_keys(spec, rows), *riding)],
    )


def give_ids(
    spec: TableSpec,
    rows: DataFrame,
    next_id: Column,
    rels: Relationships,
    keep: Keep = lazily,
    whole: bool = True,
) -> DataFrame:
    """The narrow frame with new ids; parents are settled first unless all count.

    Without ``whole`` only ids and keys are asked for, not the rows.
    """
    narrow = _narrow(spec, rows, whole)
    if spec.parents and not spec.numbers_all:
        settled = _with_parents(spec, narrow, rels)
        narrow = keep(f"{spec.table}_members", settled)
    numbered = fill_new_ids(narrow, next_id + spec.offset).drop("created")
    return keep(f"{spec.table}_ids", numbered)


def members(
    spec: TableSpec, numbered: DataFrame, rels: Relationships, keep: Keep = lazily
) -> DataFrame:
    """The numbered rows whose parents all resolve, parents rewritten."""
    if not spec.numbers_all:
        return numbered
    settled = _with_parents(spec, numbered, rels)
    return keep(f"{spec.table}_members", settled)


def assemble(
    spec: TableSpec, rows: DataFrame, keys: DataFrame, rels: Relationships, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """The members' whole rows: other keys looked up, the other columns joined."""
    payload = [
        c for c in rows.columns if c != "Id" and c not in keys.columns and c not in spec.constants
    ]
    # What was numbered has a new id of its own; without a join to come the old one can go.
    own = "old_id" if payload else "new_id"
    if not payload:
        keys = keys.where("old_id IS NOT NULL").drop("old_id")
    keys = remap(keys, with_hot_answers(keys, _named(spec.lookups, rels)), row_id=own)
    for column, rel in with_hot_answers(keys, _named(spec.fallbacks, rels)).items():
        if column in keys.columns:
            keys = remap_or_default(keys, column, rel, (defaults or {})[column], row_id=own)
    whole = keys
    if payload:
        rest = rows.selectExpr("Id AS row_id", *[f"`{c}`" for c in payload])
        for column, rel in _named(spec.lists, rels).items():
            if column in payload:
                rest = remap_list(rest, column, rel, strict=spec.strict_lists, row_id="row_id")
        whole = rest.join(keys, F.expr("row_id = old_id"), "inner")
    added = [c for c in spec.constants if c not in rows.columns]
    columns = [
        "new_id AS Id"
        if c == "Id"
        else _typed(rows, c, spec.constants[c])
        if c in spec.constants
        else f"`{c}`"
        for c in [*rows.columns, *added]
    ]
    return whole.selectExpr(*columns)


def settle(
    spec: TableSpec,
    rows: DataFrame,
    numbered: DataFrame,
    rels: Relationships,
    keep: Keep = lazily,
    defaults: Mapping[str, Column] | None = None,
) -> Moved:
    """Settle the keys of a numbered table and put its rows together."""
    kept = members(spec, numbered, rels, keep)
    return Moved(
        assemble(spec, rows, kept, rels, defaults),
        Relationship(numbered.select("old_id", "new_id"), spec.identities, buckets_of(keep)),
        Relationship(kept.select("old_id", "new_id"), buckets=buckets_of(keep)),
    )


def move(
    spec: TableSpec,
    rows: DataFrame,
    next_id: Column,
    rels: Relationships,
    keep: Keep = lazily,
) -> Moved:
    """Number and settle a table that only depends on others."""
    numbered = give_ids(spec, rows, next_id, rels, keep)
    return settle(spec, rows, numbered, rels, keep)
