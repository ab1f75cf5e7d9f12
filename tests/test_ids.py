import random

import pytest
from pyspark.sql import functions as F

from regraft.operators.ids import DIGIT_BITS, allocate_ids, fill_new_ids, high_water
from regraft.sources.app import App


def expected(ids, start, step=2):
    return {old: start + step * i for i, old in enumerate(sorted(ids))}


def test_matches_global_order_over_many_buckets(spark):
    rng = random.Random(7)
    ids = set(range(1, 3000))
    ids |= {rng.randrange(1, 1 << 40) for _ in range(2000)}
    ids |= {-5, -1, 0, (1 << DIGIT_BITS) - 1, 1 << DIGIT_BITS, (1 << 62) + 3, (1 << 63) - 1, -(1 << 63)}
    table = spark.createDataFrame([(i,) for i in ids], "Id BIGINT").repartition(5)
    got = {r.old_id: r.new_id for r in allocate_ids(table, 100).collect()}
    assert got == expected(ids, 100)


def test_only_unmatched_rows_are_numbered(frame, rows):
    matches = frame("old_id BIGINT, new_id BIGINT", (1, 12), (2, 11), (3, None), (4, None), (5, None))
    assert rows(fill_new_ids(matches, 14)) == [
        (1, 12, False), (2, 11, False), (3, 14, True), (4, 16, True), (5, 18, True),
    ]


def test_further_columns_ride_along(frame, rows):
    matches = frame("old_id BIGINT, new_id BIGINT, Note STRING", (7, None, "x"), (3, None, "y"))
    assert rows(fill_new_ids(matches, 1)) == [(3, 1, "y", True), (7, 3, "x", True)]


def test_does_not_depend_on_partitioning(spark):
    table = spark.range(5000).select((F.col("id") * 37).alias("Id"))
    first = allocate_ids(table.repartition(3), 10).orderBy("old_id").collect()
    second = allocate_ids(table.repartition(11), 10).orderBy("old_id").collect()
    assert first == second


def test_row_exchange_is_shared_with_the_counts(spark):
    table = spark.range(5000).select(F.col("id").alias("Id")).where("Id % 3 <> 1")
    allocated = allocate_ids(table, 10)
    allocated.collect()
    plan = allocated._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


def test_high_water(frame, spark):
    def value(table):
        return spark.range(1).select(high_water(table).alias("n")).first().n

    assert value(frame("Id BIGINT", (4,), (9,))) == 10
    assert value(frame("Id BIGINT")) == 1


def test_given_next_id_is_a_floor(frame, spark):
    tables = {"T": frame("Id BIGINT", (4,))}
    given = App.of("a", tables, next_ids={"T": 50})
    behind = App.of("a", tables, next_ids={"T": 2})
    assert spark.range(1).select(given.next_id("T")).first()[0] == 50
    assert spark.range(1).select(behind.next_id("T")).first()[0] == 5
