"""Relationships in buckets: read where they lie, found again, hot keys answered by expression."""

import re

import pytest
from pyspark.sql import functions as F
from test_skew import settings

from regraft.operators.relationship import Relationship
from regraft.operators.remap import remap, remap_list, with_hot_answers
from regraft.plans import sales
from regraft.plans.crm import ORDER_TABLES
from regraft.sources.staging import Staging
from workload.queries import Work

FOLDER = "/root/testdata/sf0.001"
PAIRS = "ReadSchema: struct<old_id:bigint,new_id:bigint>"


def ancestors(plan, line):
    """Nodes above a line of a plan, nearest first."""
    depth = lambda x: len(re.match(r"[\s:+|-]*", x).group())
    level, out = depth(plan[line]), []
    for above in reversed(plan[:line]):
        if depth(above) < level:
            level = depth(above)
            out.append(above.strip(" :+-|"))
    return out


def scans_of_pairs(df):
    """For each scan of pairs, the nodes up to its join."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(plan):
        if "FileScan" in line and PAIRS in line:
            up = ancestors(plan, i)
            join = next((k for k, node in enumerate(up) if "Join" in node), len(up))
            yield line, up[:join]


@pytest.fixture(scope="module")
def family(spark):
    work = Work(spark, FOLDER)
    work.keep = Staging(spark, buckets=4).keeper()
    made = sales.Orders(work.source, work.target, work.rels("contact", "user", "product", "plan", "card"), work.keep)
    made.stage_all()
    return made


@pytest.mark.parametrize("name", [*ORDER_TABLES])
def test_pairs_are_not_shuffled(spark, family, name):
    with settings(spark, **{"spark.sql.shuffle.partitions": "4"}):
        found = list(scans_of_pairs(family.rows(name)))
        spec = ORDER_TABLES[name]
        # invoices look products up in lists, others have keys of their own
        assert found or not (spec.lookups or spec.lists)
        for line, up in found:
            assert "Bucketed: true" in line
            assert not any("Exchange" in node for node in up), up


def test_a_bucketed_stage_is_found_again(spark, rows, tmp_path):
    pairs = spark.range(500).selectExpr("id AS old_id", "id * 2 AS new_id", "CAST(id AS STRING) AS more")
    staging = Staging(spark, str(tmp_path / "it's a run"), buckets=3)
    staging.write("a/pairs", pairs)
    staging.write("a/pairs", pairs.where("old_id < 400"))
    staging.write("a/other", spark.range(3))
    assert len(list((tmp_path / "it's a run" / "a" / "pairs").glob("part-*"))) == 3
    spark.sql(f"DROP TABLE {staging._table('a/pairs')}")
    # a later session that was given no number of buckets
    later = Staging(spark, str(tmp_path / "it's a run"))
    assert later.has("a/pairs") and set(rows(later.read("a/pairs"))) == {(i, 2 * i, str(i)) for i in range(400)}
    assert later.read("a/other").count() == 3
    with settings(spark, **{"spark.sql.shuffle.partitions": "3"}):
        got = remap(spark.range(400).selectExpr("id AS Id", "id AS Fk"), {"Fk": Relationship(later.read("a/pairs"))})
        scans = list(scans_of_pairs(got))
        assert len(scans) == 1 and "Bucketed: true" in scans[0][0]
        assert got.where("Fk <> 2 * Id").isEmpty()


def test_hot_keys_are_answered_and_spread(spark, tmp_path):
    facts = spark.range(0, 90_000, 1, 8).select(
        F.col("id").alias("Id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 6000).otherwise(F.col("id") % 5000).alias("Fk"),
    )
    pairs = Staging(spark, str(tmp_path / "run"), buckets=16).write("p", spark.range(5000).selectExpr("id AS old_id", "id * 10 AS new_id"))
    plain, clustered = Relationship(pairs, (0,)), Relationship(pairs, (0,), buckets=16)
    assert with_hot_answers(facts, {"Fk": clustered})["Fk"].answers == {}
    assert with_hot_answers(facts, {"Fk": plain}, 100)["Fk"].answers == {}
    hot = with_hot_answers(facts, {"Fk": clustered, "None": clustered}, 100)
    assert hot["Fk"].answers == {7: 70, 6000: None} and hot["None"].answers == {}
    with settings(spark):
        for required in (False, True):
            want = sorted(map(tuple, remap(facts, {"Fk": plain}, required=required).collect()), key=str)
            assert sorted(map(tuple, remap(facts, hot, required=required).collect()), key=str) == want
        sizes = remap(facts, hot).groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert sizes < 2 * 90_000 / 16


def test_hot_entries_of_lists(spark, rows, monkeypatch):
    monkeypatch.setattr("regraft.operators.remap.HOT_ROWS", 10)
    lists = spark.range(300).selectExpr("id AS Id", "concat('7,', id, ',0,9000') AS L")
    pairs = spark.range(300).selectExpr("id AS old_id", "id + 1000 AS new_id")
    for identities in ((), (0,)):
        want = rows(remap_list(lists, "L", Relationship(pairs, identities)))
        assert rows(remap_list(lists, "L", Relationship(pairs, identities, buckets=4))) == want
