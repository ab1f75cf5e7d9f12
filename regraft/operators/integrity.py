"""Which rows go along: children of kept parents, rows not there yet, no repeats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_children(children: DataFrame, column: str, parents: DataFrame, key: str = "Id") -> DataFrame:
    """Children whose parent is among ``parents``, which are unique on their key."""
    return children.join(
        parents.select(F.col(key).alias("parent_key")),
        F.col(column) == F.col("parent_key"),
        "left_semi",
    )


def cascade(
    tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, str]]
) -> dict[str, DataFrame]:
    """Apply ``(child, column, parent)`` links in order; a chain of semi-joins.

    All frames stay in their old ids, so a child is compared with the parents
    that were really kept.
    """
    kept = dict(tables)
    for child, column, parent in links:
        kept[child] = keep_children(kept[child], column, kept[parent])
    return kept


def without_existing(
    rows: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    nulls_equal: bool = False,
    repeats: bool = True,
) -> DataFrame:
    """Rows whose key the target lacks; a null in the key counts as lacking.

    The target's keys are combined before their shuffle, so a key it repeats
    very often costs one row. If ``rows`` may repeat keys too, the join is keyed
    null-safely: it then shuffles the combined keys anew, which leaves the
    skew-join rule free to split a hot key of ``rows``.
    """
    have = target.select(
        *[F.col(k).cast(rows.schema[k].dataType).alias(f"have_{k}") for k in keys]
    ).distinct()
    equal = "<=>" if nulls_equal or repeats else "="
    terms = [f"`{k}` {equal} `have_{k}`" for k in keys]
    if not nulls_equal:
        terms += [f"`{k}` IS NOT NULL" for k in keys]
    return rows.join(have, F.expr(" AND ".join(terms)), "left_anti")


def first_per_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, nulls equal: the first by ``order_by``, then all columns.

    A minimum over the other columns instead of a ranking window, so repeats of
    a hot key are combined before the shuffle. Nulls sort last.
    """
    rest = [c for c in order_by if c not in keys]
    rest += [c for c in rows.columns if c not in keys and c not in rest]
    if not rest:
        return rows.select(*keys).distinct()
    if len(rest) == 1:
        picked = rows.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0]))
        return picked.select(*rows.columns)
    ordered = [f for c in rest for f in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    picked = rows.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("first"))
    return picked.select(*[c if c in keys else F.col(f"first.{c}").alias(c) for c in rows.columns])


def grouped_list(rows: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Sorted distinct values per key; rows without a key are left out.

    Repeats go before the lists are put together, so a list is no longer than
    the number of distinct values, whatever the number of rows of its key.
    """
    distinct = rows.where(F.col(key).isNotNull()).select(key, value).distinct()
    return distinct.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(alias))


def in_use(rows: DataFrame, column: str, alias: str) -> DataFrame:
    """Distinct values of a column."""
    return rows.select(F.col(column).alias(alias)).distinct()


def count_report(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame:
    """``(object, before, after, transferred)``, one row per object."""
    parts = []
    for phase, frames in (("before", before), ("after", after)):
        for name, frame in frames.items():
            parts.append(
                frame.agg(F.count("*").alias("rows")).select(
                    F.lit(name).alias("object"), F.lit(phase).alias("phase"), "rows"
                )
            )
    counts = reduce(DataFrame.unionByName, parts)

    def rows_in(phase: str):
        return F.coalesce(F.sum(F.when(F.col("phase") == phase, F.col("rows"))), F.lit(0))

    return counts.groupBy("object").agg(
        rows_in("before").alias("before"),
        rows_in("after").alias("after"),
        (rows_in("after") - rows_in("before")).alias("transferred"),
    )
