"""Dense id allocation in id order without a global sort.

A row's new id follows from the number of rows before it. A window over the
whole table would put all rows in one task, so the number is put together from
two parts:

* rows are exchanged by ``id >> 16``. A bucket spans 2**16 ids and ids are
  unique, so ranking a bucket never takes more than 2**16 narrow rows;
* the buckets are counted and their totals summed up in bucket order.

The totals are summed in steps of 2**16 buckets, so that no window sees more
than 2**16 rows, dense ids or strewn over the 64-bit range.

The result depends on values only, so a retried task gives the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16
ID_BITS = 64
STEP = 2

_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def high_water(table: DataFrame, id_column: str = "Id") -> Column:
    """Next free id of a table, as a scalar subquery inside the plan."""
    top = table.agg(F.max(id_column).alias("top")).scalar()
    return (F.coalesce(top, F.lit(0)) + 1).cast("bigint")


def _summed_before(counts: DataFrame, bits_left: int) -> DataFrame:
    """``(bucket, n)`` to ``(bucket, before)``: rows in all smaller buckets."""
    if bits_left <= DIGIT_BITS:
        return counts.selectExpr("bucket", f"sum(n) OVER (ORDER BY bucket {_SO_FAR}) - n AS before")
    grouped = counts.selectExpr("bucket AS inner_bucket", "n", f"bucket >> {DIGIT_BITS} AS bucket")
    groups = grouped.groupBy("bucket").agg(F.sum("n").alias("n"))
    bases = _summed_before(groups, bits_left - DIGIT_BITS).withColumnRenamed("before", "base")
    within = f"sum(n) OVER (PARTITION BY bucket ORDER BY inner_bucket {_SO_FAR}) - n AS within"
    return (
        grouped.selectExpr("inner_bucket", "bucket", within)
        .join(bases, "bucket", "left")
        .selectExpr("inner_bucket AS bucket", "base + within AS before")
    )


def fill_new_ids(
    matches: DataFrame, start: int | Column, step: int = STEP
) -> DataFrame:
    """Give every unmatched row of ``(old_id, new_id, ...)`` a fresh id.

    The i-th unmatched row in ``old_id`` order gets ``start + step * i``;
    matched rows keep theirs. ``created`` tells the two apart. Further columns
    ride along, so keep the frame narrow.
    """
    start = F.lit(start) if isinstance(start, int) else start
    bucket = f"old_id >> {DIGIT_BITS}"
    keyed = matches.repartition(F.expr(bucket))

    # Pairs alone share their exchange with the counts. With further columns the
    # two would differ; then the ids are counted where they are read, which
    # shuffles a row per bucket and task.
    counted = keyed if len(matches.columns) == 2 else matches
    counts = counted.groupBy(F.expr(f"{bucket} AS bucket")).agg(
        F.expr("count(CASE WHEN new_id IS NULL THEN old_id END) AS n")
    )
    before = _summed_before(counts, ID_BITS - DIGIT_BITS)

    missing_so_far = f"""
        sum(CASE WHEN new_id IS NULL THEN 1 ELSE 0 END)
            OVER (PARTITION BY {bucket} ORDER BY old_id {_SO_FAR}) AS missing_so_far"""
    fresh = start + step * F.expr("before + missing_so_far - 1")
    new_id = F.when(F.expr("new_id IS NULL"), fresh).otherwise(F.col("new_id")).cast("bigint")
    return (
        keyed.selectExpr("*", f"{bucket} AS own_bucket", missing_so_far)
        .join(before, F.expr("own_bucket = bucket"), "left")
        .select(
            *[new_id.alias(c) if c == "new_id" else c for c in matches.columns],
            F.expr("new_id IS NULL AS created"),
        )
    )


def allocate_ids(
    rows: DataFrame,
    start: int | Column,
    step: int = STEP,
    id_column: str = "Id",
) -> DataFrame:
    """``(old_id, new_id)`` for every row, none of them matched to anything."""
    unmatched = rows.selectExpr(
        f"CAST({id_column} AS BIGINT) AS old_id", "CAST(NULL AS BIGINT) AS new_id"
    )
    return fill_new_ids(unmatched, start, step).select("old_id", "new_id")
