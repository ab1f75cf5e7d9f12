"""What is shuffled and written on the way of a table: nothing twice."""

from pyspark.sql import functions as F

from regraft.operators.relationship import Relationship
from regraft.plans import sales
from regraft.plans.crm import ORDER_TABLES
from regraft.plans.spec import TableSpec, move
from regraft.sources.staging import Staging
from workload.queries import QUERIES, Work

FOLDER = "/root/testdata/sf0.001"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_lines_are_numbered_once(spark):
    for name in ("q18_remap_list_strict", "q30_invoice_items", "q30_invoices", "q34_order_subscription_bridge"):
        assert "row_number()" not in executed(QUERIES[name](spark, FOLDER)), name


def test_few_small_columns_ride_with_the_keys(spark, frame, rows):
    spec = TableSpec("T", parents={"P": "p"}, lookups={"L": "l"}, numbers_all=True)
    pairs = frame("old_id BIGINT, new_id BIGINT", *[(i, 100 + i) for i in range(1, 6)])
    rels = {"p": Relationship(pairs, (0,)), "l": Relationship(pairs)}
    data = frame(
        "Id BIGINT, P BIGINT, Qty INT, L BIGINT, Day DATE",
        (1, 1, 10, 2, None), (2, 0, None, 9, None), (3, 77, 30, 1, None), (4, 5, 40, None, None), (None, 1, 50, 1, None),
    )
    small = move(spec, data, F.lit(1000), rels).rows
    wide = move(spec, data.withColumn("Text", F.lit("x")), F.lit(1000), rels).rows
    assert small.columns == data.columns and small.dtypes == data.dtypes
    assert rows(small) == rows(wide.drop("Text")) and small.count() == 3
    assert executed(small).count("row_id") == 0 < executed(wide).count("row_id")


def test_a_table_that_is_looked_up_in_is_numbered_by_ids_alone(spark, rows):
    work = Work(spark, FOLDER)
    family = sales.Orders(work.source, work.target, work.rels("contact", "user", "product", "plan"), Staging(spark).keeper())
    family.rows("order_item")
    assert "invoice_item" not in family._numbered and family._pairs["invoice_item"].columns == ["old_id", "new_id"]
    known = rows(family._pairs["invoice_item"])
    assert known == rows(family.numbered("invoice_item"), "old_id", "new_id")
    assert set(family._pairs) < set(ORDER_TABLES)
