"""A run that starts from the relationships of an earlier one."""

from datetime import datetime

import pytest

from regraft.operators.relationship import Relationship
from regraft.plans.transfer import Selection, Transfer
from regraft.sources.app import App
from regraft.sources.ledger import Book
from regraft.sources.relationships import RelationshipsDiffer, checked_pairs, read_relationships, write_json
from regraft.sources.sinks import replace_parquet
from regraft.sources.staging import Staging, at_once
from workload.inputs import SHAPES, Inputs

FOLDER = "/root/testdata/sf0.001"
RUN_TIME = datetime(2024, 6, 1, 12, 0, 0)
PAIRS = "old_id BIGINT, new_id BIGINT"
FIRST = {
    "custom_fields": False, "contact_actions": False, "opportunities": False, "credit_cards": False, "orders": False, "subscriptions": False,
}


def test_pairs_are_checked(frame, rows):
    target = frame("Id BIGINT", (11,), (12,))
    good = frame(PAIRS, (0, 0), (1, 11), (2, 12), (3, 0))
    assert rows(checked_pairs("user", good, target, (0, -1))) == [(1, 11), (2, 12), (3, 0)]
    with pytest.raises(RelationshipsDiffer, match=r"user repeats old ids, such as \[1\]"):
        checked_pairs("user", frame(PAIRS, (1, 11), (1, 12)), target)
    with pytest.raises(RelationshipsDiffer, match=r"lacks, such as \[99\]"):
        checked_pairs("user", frame(PAIRS, (1, 11), (2, 99)), target)


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("import")
    target = Inputs(spark, FOLDER).target()
    names = [*SHAPES, "CreditCard_from_src"]
    for root in ("one", "two"):
        at_once([lambda t=t, r=root: replace_parquet(target.table(t), str(where / r / t)) for t in names])
    return where


def transfer(spark, place, root, run, selection, given=None):
    source = Inputs(spark, FOLDER).source_with_groups()
    target = App.parquet(spark, "dst", str(place / root))
    made = Transfer(spark, source, target, selection, Staging(spark, str(place / run)), RUN_TIME, given).run()
    made.publish_parquet(str(place / root))
    return made


def test_two_runs_give_the_same_target_as_one(spark, place):
    rest = {"opportunities": True, "contact_actions": True, "orders": True}
    transfer(spark, place, "one", "run", Selection(**FIRST | rest))
    first = transfer(spark, place, "two", "run-first", Selection(**FIRST))
    for name, rel in first.rels.items():
        write_json(rel, str(place / "rels" / f"{name}.json"))
    given = read_relationships(spark, str(place / "rels"))
    assert set(given) >= {"contact", "user", "tag", "product", "plan"}
    second = transfer(spark, place, "two", "run-second", Selection(**FIRST | rest), given)
    assert "Contact" not in second.appended and "Job" in second.appended
    assert isinstance(second.rels["contact"], Relationship)
    one, two = Book(spark, str(place / "one")), Book(spark, str(place / "two"))
    for table in ("Contact", "LeadSource", "Product", "Job", "InvoiceItem", "Opportunity", "ContactAction", "AppSetting"):
        a, b = one.read(table), two.read(table)
        assert a.columns == b.columns
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), table


def test_relationships_that_do_not_fit_stop_the_run(spark, place, frame):
    given = read_relationships(spark, str(place / "rels"))
    for i, (wrong, said) in enumerate((
        ({"contact": given["contact"]}, "needed too"),
        ({**given, "product": frame(PAIRS, (1, 5), (1, 6))}, "product repeats"),
        ({**given, "tag": frame(PAIRS, (1, -7))}, "tag has new ids"),
    )):
        with pytest.raises(RelationshipsDiffer, match=said):
            transfer(spark, place, "two", f"run-wrong-{i}", Selection(**FIRST), wrong)
