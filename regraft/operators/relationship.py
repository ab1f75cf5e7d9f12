"""Old id to new id, kept as a DataFrame from beginning to end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAIR_SCHEMA = "old_id BIGINT, new_id BIGINT"


@dataclass(frozen=True)
class Relationship:
    """``pairs(old_id, new_id)``, unique on ``old_id``, plus self-mapped ids.

    ``identities`` are reserved ids such as 0 (unassigned) and -1 (the system
    user). They are answered by an expression and never take part in a join:
    in most foreign keys 0 is by far the most frequent value. ``answers`` does the
    same for other keys that are frequent in the frame at hand. ``buckets`` is the
    number of files that the pairs lie in by hash, if they do: joins then leave
    them where they are.
    """

    pairs: DataFrame
    identities: tuple[int, ...] = ()
    buckets: int = 0
    answers: Mapping[int, int | None] = field(default_factory=dict)

    @cached_property
    def lookup(self) -> DataFrame:
        """The pairs under names that clash with no table's columns."""
        return self.pairs.selectExpr("old_id AS rel_old", "new_id AS rel_new")

    def with_identities(self, *ids: int) -> Relationship:
        return replace(self, identities=tuple(ids))

    def complete(self) -> DataFrame:
        """All pairs with the reserved ones as rows, for export."""
        pairs = self.pairs.select("old_id", "new_id")
        if not self.identities:
            return pairs
        return pairs.where(~F.col("old_id").isin(*self.identities)).unionByName(
            reserved_pairs(pairs.sparkSession, self.identities)
        )

    def only(self, old_ids: Sequence[int]) -> Relationship:
        return replace(self, pairs=self.pairs.where(F.col("old_id").isin(*old_ids)))


def reserved_pairs(spark: SparkSession, ids: Sequence[int]) -> DataFrame:
    return spark.createDataFrame([(i, i) for i in ids], PAIR_SCHEMA)


def empty_relationship(spark: SparkSession, *identities: int) -> Relationship:
    return Relationship(spark.createDataFrame([], PAIR_SCHEMA), identities)


def prefer_later(*pairs: DataFrame) -> DataFrame:
    """Union of pair frames; for an ``old_id`` in several, the last frame wins.

    Inside one frame the greatest ``new_id`` wins. One aggregation with map-side
    combine, so an ``old_id`` with very many candidates is not collected.
    """
    ranked = [
        frame.select("old_id", "new_id", F.lit(rank).alias("rank"))
        for rank, frame in enumerate(pairs)
    ]
    merged = ranked[0]
    for frame in ranked[1:]:
        merged = merged.unionByName(frame)
    return merged.groupBy("old_id").agg(
        F.max_by("new_id", F.struct("rank", "new_id")).alias("new_id")
    )
