"""Matching source rows to target rows on natural keys, and creating the rest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regraft.operators.ids import fill_new_ids
from regraft.operators.relationship import Relationship

Keep = Callable[[str, DataFrame], DataFrame]


def lazily(name: str, frame: DataFrame) -> DataFrame:
    """The default ``keep``: nothing is written, the plan just goes on."""
    return frame


def buckets_of(keep: Keep) -> int:
    """Number of buckets that ``keep`` puts pairs in, 0 if it doesn't."""
    return getattr(keep, "buckets", 0)


@dataclass(frozen=True)
class Created:
    """Rows to append to the target, and the relationship they belong to."""

    rows: DataFrame
    relationship: Relationship


def best_match(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One target row per natural key: the one with the greatest id."""
    return target.groupBy(*[F.col(k).alias(f"key_{k}") for k in keys]).agg(
        F.expr("CAST(max(Id) AS BIGINT) AS new_id")
    )


def same_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality. It plans as a hashed equi-join, nulls included."""
    return F.expr(" AND ".join(f"`{k}` <=> `key_{k}`" for k in keys))


def _matched(source: DataFrame, target: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    narrow = source.selectExpr("CAST(Id AS BIGINT) AS old_id", *[f"`{k}`" for k in keys])
    return narrow.join(best_match(target, keys), same_keys(keys), how).select(
        "old_id", "new_id"
    )


def natural_match(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(old_id, new_id)`` with a null ``new_id`` where the target has no match.

    The target is reduced to one row per key before the join, so a source row
    gives exactly one result row however often the key repeats on either side.
    The null-safe join shuffles that reduced side again under its own hash,
    which leaves the skew-join rule free to split a hot key of the source.
    """
    return _matched(source, target, keys, "left")


def inner_match(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``natural_match``, but only matched rows; null keys match nothing."""
    return _matched(source.dropna(subset=list(keys)), target, keys, "inner")


def with_new_ids(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows that have a pair, under their new id, columns in their order."""
    numbered = pairs.selectExpr("old_id AS pair_old", "new_id AS pair_new")
    return rows.join(numbered, F.expr("Id = pair_old"), "inner").selectExpr(
        *["pair_new AS Id" if c == "Id" else f"`{c}`" for c in rows.columns]
    )


def _first_of_each_key(source: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(old_id, stand_in)``: the smallest created id that has the same key."""
    missing = source.select(F.col("Id").alias("old_id"), *keys).join(
        pairs.where(F.col("new_id").isNull()), "old_id", "left_semi"
    )
    firsts = missing.groupBy(*[F.col(k).alias(f"key_{k}") for k in keys]).agg(
        F.min("old_id").alias("stand_in")
    )
    return missing.join(firsts, same_keys(keys), "left").select("old_id", "stand_in")


def match_or_create(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    start: int | Column,
    *,
    rows: DataFrame | None = None,
    name: str = "match",
    keep: Keep = lazily,
    dedupe_source_keys: bool = False,
) -> Created:
    """Match on ``keys``; give unmatched source rows new ids and return them.

    ``rows`` are the rows to insert when their foreign keys were rewritten
    after matching; they default to ``source``. Unmatched source rows that
    share a key are all created, unless ``dedupe_source_keys`` asks for one
    row per key, to which the others are then related.
    """
    matches = natural_match(source, target, keys)
    if dedupe_source_keys:
        stand_ins = keep(f"{name}_stand_ins", _first_of_each_key(source, matches, keys))
        lone = stand_ins.where(F.col("old_id") != F.col("stand_in"))
        numbered = fill_new_ids(matches.join(lone, "old_id", "left_anti"), start)
        numbered = keep(name, numbered)
        followers = lone.join(
            numbered.select(F.col("old_id").alias("stand_in"), "new_id"), "stand_in"
        ).select("old_id", "new_id")
        pairs = numbered.select("old_id", "new_id").unionByName(followers)
    else:
        numbered = keep(name, fill_new_ids(matches, start))
        pairs = numbered.select("old_id", "new_id")
    created = with_new_ids(source if rows is None else rows, numbered.where("created"))
    return Created(created, Relationship(pairs, buckets=0 if dedupe_source_keys else buckets_of(keep)))
