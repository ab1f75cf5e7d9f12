"""The whole transfer over the given tables: invariants, resume, publishing."""

from datetime import datetime

import pytest

from regraft.plans import contacts as people
from regraft.plans.transfer import Selection, Transfer, stage_report
from regraft.sources.app import App
from regraft.sources.sinks import replace_parquet
from regraft.sources.staging import Staging, at_once
from workload.inputs import SHAPES, Inputs

FOLDER = "/root/testdata/sf0.001"
RUN_TIME = datetime(2024, 6, 1, 12, 0, 0)
PARENTS = {
    "CompanyOwner": ("MainContactId", "Contact"),
    "Opportunity": ("ContactID", "Contact"),
    "ContactAction": ("ContactId", "Contact"),
    "CreditCard": ("ContactId", "Contact"),
    "JobRecurring": ("ContactId", "Contact"),
    "Job": ("ContactId", "Contact"),
    "Invoice": ("JobId", "Job"),
    "PayPlan": ("InvoiceId", "Invoice"),
    "InvoiceItem": ("InvoiceId", "Invoice"),
    "OrderItem": ("OrderId", "Job"),
    "Payment": ("InvoiceId", "Invoice"),
    "InvoicePayment": ("PaymentId", "Payment"),
    "PayPlanItem": ("PayPlanId", "PayPlan"),
    "SubscriptionPlan": ("ProductId", "Product"),
}


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return tmp_path_factory.mktemp("transfer")


@pytest.fixture(scope="module")
def source(spark):
    return Inputs(spark, FOLDER).source_with_groups()


@pytest.fixture(scope="module")
def target_root(spark, place):
    target = Inputs(spark, FOLDER).target()
    root = str(place / "target")
    names = [*SHAPES, "CreditCard_from_src"]
    at_once([lambda t=t: replace_parquet(target.table(t), f"{root}/{t}") for t in names])
    return root


@pytest.fixture(scope="module")
def done(spark, source, target_root, place):
    selection = Selection(product_interests=True)
    staging = Staging(spark, str(place / "run"))
    target = App.parquet(spark, "dst", target_root)
    return Transfer(spark, source, target, selection, staging, RUN_TIME).run()


def fresh(done, table):
    rows = done.appended[table][0]
    for more in done.appended[table][1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows


def test_relationships_are_unique(done):
    for name, rel in done.rels.items():
        assert rel.pairs.groupBy("old_id").count().where("count > 1").isEmpty(), name


def test_new_ids_are_new_even_and_distinct(done):
    for table in done.appended:
        rows = fresh(done, table)
        if "Id" not in rows.columns or table in ("ContactGroupAssign", "CompanyOwner"):
            continue
        top = done.before.table(table).agg({"Id": "max"}).first()[0]
        lowest, count, distinct = rows.selectExpr("min(Id)", "count(Id)", "count(DISTINCT Id)").first()
        assert lowest is None or lowest > top, table
        assert count == distinct, table


def test_no_child_without_its_parent(done):
    for table, (column, parent) in PARENTS.items():
        rows = fresh(done, table).where(f"{column} <> 0").select(column)
        ids = done.target.table(parent).selectExpr("Id AS parent_id")
        assert rows.join(ids, rows[column] == ids.parent_id, "left_anti").isEmpty(), table


def test_report_adds_up(done):
    report = {r.object: r for r in done.report().collect()}
    assert all(r.before + r.transferred == r.after for r in report.values())
    assert report["Lead Sources"].transferred == 15
    assert report["Tags"].transferred == 4
    assert report["Orders"].transferred == fresh(done, "Job").count() > 1000
    lines = [r.line for r in stage_report(done.report()).collect()]
    assert "15 Lead Sources Transferred." in lines
    assert done.dropdowns_modified()


def test_marker_is_on_every_contact_but_the_reserved_one(done):
    marker = fresh(done, "ContactGroup").where("GroupName = 'Data Transferred - src > dst'").collect()
    assert len(marker) == 1
    applied = fresh(done, "ContactGroupAssign").where(f"GroupId = {marker[0].Id}")
    assert applied.count() == done.rels["contact"].pairs.count()
    assert applied.where("ContactId = 0").isEmpty()


def test_settings_are_updated(done):
    values = {r.Name: r.Value for r in done.target.table("AppSetting").collect()}
    assert values["runPurchaseActionsOnManualOrders"] == "0"
    assert values["invoicepayments"] == "never"
    assert values["stagewin"] not in ("1", None)
    assert values["stageloss"] == "2"


def test_rerun_reads_the_finished_stages(spark, done, source, target_root, place):
    staging = Staging(spark, str(place / "run"))

    def forbidden(name, frame):
        raise AssertionError(f"{name} was written again")

    staging.write = forbidden
    target = App.parquet(spark, "dst", target_root)
    again = Transfer(spark, source, target, done.selection, staging, RUN_TIME).run()
    assert again.rels.keys() == done.rels.keys()
    assert again.report().collect() == done.report().collect()


def test_another_selection_or_app_refuses_the_run_folder(spark, done, source, target_root, place):
    staging = Staging(spark, str(place / "run"))
    target = App.parquet(spark, "dst", target_root)
    for selection, app in ((Selection(tag_ids=(1,)), target), (done.selection, App.of("other", {}))):
        with pytest.raises(ValueError, match="another run"):
            Transfer(spark, source, app, selection, staging, RUN_TIME)


def test_publishing_twice_is_publishing_once(spark, done, source, target_root):
    expected = {t: done.target.table(t).count() for t in ("Contact", "Job", "Custom_Contact")}
    fresh_jobs = {tuple(map(str, r)) for r in fresh(done, "Job").collect()}
    columns = fresh(done, "Job").columns
    wanted = {r.Name: r.Value for r in done.target.table("AppSetting").collect()}
    settings = spark.read.parquet(f"{target_root}/AppSetting")
    meanwhile = settings.selectExpr("Name", "CASE WHEN Name = 'untouched' THEN 'changed' ELSE Value END AS Value")
    replace_parquet(meanwhile, f"{target_root}/AppSetting")
    done.publish_parquet(target_root)
    done.publish_parquet(target_root)
    published = App.parquet(spark, "dst", target_root)
    assert {t: published.table(t).count() for t in expected} == expected
    jobs = published.table("Job", columns).where("ContactId IS NOT NULL").collect()
    assert {tuple(map(str, r)) for r in jobs} == fresh_jobs
    assert "Balance0" in published.columns("Custom_Contact")
    values = {r.Name: r.Value for r in published.table("AppSetting").collect()}
    assert values["untouched"] == "changed" and values["runPurchaseActionsOnManualOrders"] == "0"
    assert values == wanted | {"untouched": "changed"}
    assert sorted(map(tuple, done.report(published).collect())) == sorted(map(tuple, done.report().collect()))
    assert people.lead_sources(source, published).rows["LeadSource"].isEmpty()
    assert people.tags(source, published).rows["ContactGroup"].isEmpty()


def test_selection_is_checked_first(spark, source):
    wrong = Selection(contacts=False, products=False)
    assert "tags needs contacts" in wrong.problems()
    assert "orders needs products" in wrong.problems()
    with pytest.raises(ValueError, match="tags needs contacts"):
        Transfer(spark, source, source, wrong, None, RUN_TIME)
    assert Selection().problems() == []
