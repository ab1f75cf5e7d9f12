"""Hot keys: reserved ones are spread, others are split by adaptive execution."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from regraft.operators.integrity import first_per_key, keep_children, without_existing
from regraft.operators.match import inner_match, natural_match
from regraft.operators.relationship import Relationship
from regraft.operators.remap import remap

SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, **values):
    values = {**SPLITTING, **values}
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def facts(spark):
    """A third of all rows under key 7."""
    return spark.range(0, 90_000, 1, 8).select(
        F.col("id").alias("Id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("Fk"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("Name"),
    )


@pytest.fixture
def rel(spark):
    return Relationship(spark.range(5000).selectExpr("id AS old_id", "id * 10 AS new_id"), (0,))


def test_hot_foreign_key_is_split(spark, facts, rel):
    with settings(spark):
        got = remap(facts, {"Fk": rel})
        assert got.where("Id % 3 = 0 AND Fk <> 70").isEmpty()
        got = remap(facts, {"Fk": rel})
        assert got.collect() and "skew=true" in final_plan(got)


def test_hot_foreign_key_is_split_when_children_are_kept(spark, facts, rel):
    with settings(spark):
        kept = keep_children(facts, "Fk", rel.pairs, "old_id")
        assert len(kept.collect()) == 90_000
        assert "skew=true" in final_plan(kept)


def test_hot_natural_key_is_split(spark, facts):
    target = spark.range(5000).selectExpr(
        "id + 1000000 AS Id", "CASE WHEN id % 50 = 0 THEN 'hot' ELSE concat('k', id) END AS Name"
    )
    with settings(spark):
        got = natural_match(facts, target, ["Name"])
        assert len(got.collect()) == 90_000
        assert "skew=true" in final_plan(got)


def test_hot_key_of_an_inner_match_is_split(spark, facts):
    target = spark.range(5000).selectExpr("id AS Id", "CASE WHEN id = 9 THEN 'hot' ELSE concat('k', id) END AS Name")
    with settings(spark):
        got = inner_match(facts, target, ["Name"])
        assert len(got.collect()) > 80_000
        assert "skew=true" in final_plan(got)


def test_hot_key_among_existing_rows_is_split_and_combined(spark, facts):
    have = facts.where("Fk > 100 OR Fk = 7").select("Fk")
    with settings(spark):
        got = without_existing(facts, have, ["Fk"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan
        assert {r.Fk for r in got.collect()} == set(range(101)) - {7}
        got = without_existing(facts, have, ["Fk"])
        got.collect()
        assert "skew=true" in final_plan(got)


def test_null_natural_key_is_split(spark, facts):
    nulls = facts.withColumn("Name", F.nullif("Name", F.lit("hot")))
    target = spark.range(5000).selectExpr("id AS Id", "CASE WHEN id > 9 THEN concat('k', id) END AS Name")
    with settings(spark):
        got = natural_match(nulls, target, ["Name"])
        assert {r.new_id for r in got.where("old_id % 3 = 0").collect()} == {9}
        got = natural_match(nulls, target, ["Name"])
        got.collect()
        assert "skew=true" in final_plan(got)


@pytest.mark.parametrize("hot", ["CAST(0 AS BIGINT)", "CAST(NULL AS BIGINT)"])
def test_reserved_and_null_keys_are_spread(spark, facts, rel, hot):
    mostly = facts.withColumn("Fk", F.expr(f"CASE WHEN Id % 10 > 0 THEN {hot} ELSE Fk END"))
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):
        sizes = (
            remap(mostly, {"Fk": rel})
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .agg(F.max("count"))
            .first()[0]
        )
    assert sizes < 2 * 90_000 / 16


def test_repeats_are_combined_before_the_shuffle(spark, facts):
    got = first_per_key(facts.select("Fk", "Id"), ["Fk"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
