"""Options and corner cases of single transfers, on tiny tables."""

from datetime import datetime

import pytest

from regraft.operators.relationship import Relationship
from regraft.plans import contacts as people
from regraft.plans import sales
from regraft.plans import settings as switches
from regraft.plans.spec import TableSpec, move, set_constants
from regraft.sources.app import App

PAIRS = "old_id BIGINT, new_id BIGINT"
RUN_TIME = datetime(2024, 6, 1, 12, 30, 15)
CONTACT = "Id BIGINT, Email STRING, IsUser INT, CompanyID BIGINT, CreatedBy BIGINT, LeadSourceId BIGINT, Groups STRING"
TAG = "Id BIGINT, GroupName STRING, GroupCategoryId BIGINT"
CATEGORY = "Id BIGINT, CategoryName STRING"
APPLIED = "Id BIGINT, ContactId BIGINT, GroupId BIGINT, DateCreated TIMESTAMP"


@pytest.fixture
def source(frame):
    return App.of(
        "old",
        {
            "User": frame("Id BIGINT, GlobalUserId BIGINT", (1, 100), (2, None), (3, 300)),
            "Contact": frame(
                CONTACT,
                (1, "a@x", 1, 0, 0, 0, None),
                (2, "b@x", 1, 0, 0, 0, None),
                (3, "", 1, 0, 0, 0, None),
                (10, "p@x", 0, 10, 1, 5, "7,8"),
                (11, "q@x", 0, 10, 2, 0, ""),
                (12, None, 0, 99, -1, 6, None),
            ),
            "CompanyOwner": frame("Id BIGINT, MainContactId BIGINT", (10, 11), (10, 1)),
            "LeadSourceCategory": frame("Id BIGINT, Name STRING", (1, "web")),
            "LeadSource": frame(
                "Id BIGINT, Name STRING, LeadSourceCategoryId BIGINT", (5, "ad", 1), (6, "mail", 0)
            ),
            "ContactGroup": frame(TAG, (7, "vip", 1), (8, "new", 2)),
            "ContactGroupCategory": frame(CATEGORY, (1, "kind"), (2, "age"), (3, "unused")),
            "ContactGroupAssign": frame(
                APPLIED,
                (1, 10, 7, RUN_TIME), (2, 10, 7, RUN_TIME), (3, 11, 8, RUN_TIME),
                (4, None, 7, RUN_TIME), (5, 1, 7, RUN_TIME),
            ),
            "ContactAction": frame(
                "Id BIGINT, ContactId BIGINT, UserID BIGINT, Note STRING",
                (1, 10, 1, "x"), (2, 1, 1, "y"), (3, 0, 0, "z"),
            ),
        },
    )


@pytest.fixture
def target(frame):
    return App.of(
        "new",
        {
            "User": frame("Id BIGINT, GlobalUserId BIGINT", (50, 100), (51, 999), (52, None)),
            "Contact": frame(
                CONTACT,
                (50, "zz@x", 1, 0, 0, 0, None),
                (51, "b@x", 1, 0, 0, 0, None),
                (52, "a@x", 1, 0, 0, 0, None),
            ),
            "LeadSourceCategory": frame("Id BIGINT, Name STRING"),
            "LeadSource": frame("Id BIGINT, Name STRING, LeadSourceCategoryId BIGINT", (70, "mail", 0)),
            "ContactGroup": frame(TAG, (80, "vip", 0)),
            "ContactGroupCategory": frame(CATEGORY, (1, "age")),
            "ContactGroupAssign": frame(APPLIED, (1, 553, 80, RUN_TIME)),
            "ContactAction": frame("Id BIGINT, ContactId BIGINT"),
            "CompanyOwner": frame("Id BIGINT, MainContactId BIGINT"),
        },
    )


def test_email_overrides_global_id_and_unmatched_is_zero(source, target, rows):
    # 1: global id says 50, email says 52. 2: null global id meets null, email says 51.
    assert rows(people.user_relationship(source, target).pairs) == [(1, 52), (2, 51), (3, 0)]


def test_contacts_with_everything(source, target, rows):
    made = people.contacts(source, target, run_time=RUN_TIME)
    assert rows(made.rels["contact"].pairs) == [(10, 553), (11, 555), (12, 557)]
    assert rows(made.rows["Contact"]) == [
        (553, "p@x", 0, 553, 52, 71, "80,81"),
        (555, "q@x", 0, 553, 51, None, ""),
        (557, None, 0, None, -1, 70, None),
    ]
    assert rows(made.rows["CompanyOwner"]) == [(553, 555)]
    assert rows(made.rows["LeadSource"]) == [(71, "ad", 1)]
    tags = rows(made.rows["ContactGroup"], "Id", "GroupName", "GroupCategoryId")
    assert tags == [(81, "new", 1), (92, "Data Transferred - old > new", 0)]
    assert rows(made.rows["ContactGroupAssign"]) == [
        (553, 92, RUN_TIME), (555, 92, RUN_TIME), (557, 92, RUN_TIME),
    ]


def test_contacts_with_nothing_else(source, target, rows):
    made = people.contacts(
        source,
        target,
        with_tags=False,
        with_lead_sources=False,
        with_companies=False,
        only_tag=7,
        run_time=RUN_TIME,
    )
    assert rows(made.rows["Contact"], "Id", "LeadSourceId", "Groups") == [(553, 0, "7,8")]
    assert set(made.rows) == {"Contact", "ContactGroup", "ContactGroupAssign"}
    assert rows(made.rows["ContactGroup"], "Id") == [(91,)]


def test_tags_of_a_subset_bring_only_their_categories(source, target, rows):
    made = people.tags(source, target, tag_ids=[7])
    assert rows(made.rows["ContactGroupCategory"]) == [(2, "kind")]
    assert rows(made.rels["tag"].pairs) == [(7, 80)]
    assert rows(made.rows["ContactGroup"]) == []


def test_tag_applications_skip_existing_and_repeats(source, target, rows, frame):
    contact = Relationship(frame(PAIRS, (10, 553), (11, 555)), (0,))
    tag = Relationship(frame(PAIRS, (7, 80), (8, 81)))
    got = people.tag_applications(source, target, contact, tag)
    assert rows(got) == [(555, 81, RUN_TIME)]
    assert rows(people.tag_applications(source, target, contact, tag, tag_ids=[7])) == []


def test_actions_and_their_override(source, target, rows, frame, tmp_path):
    contact = Relationship(frame(PAIRS, (10, 553)), (0,))
    user = Relationship(frame(PAIRS, (1, 52)), (0, -1))
    shot = str(tmp_path / "snap")
    moved = people.contact_actions(source, target, contact, user, snapshot_path=shot)
    assert rows(moved.rows, "Id", "ContactId", "UserID", "Note", "FunnelId") == [
        (101, 553, 52, "x", 0), (103, 0, 0, "z", 0),
    ]
    assert rows(moved.relationship.pairs) == [(1, 101), (3, 103)]
    assert contact.pairs.sparkSession.read.parquet(shot).count() == 2
    path = tmp_path / "actions.csv"
    path.write_text("Id,ContactId,UserID,Note\n9,4,4,from file\n8,5,5,too\n")
    moved = people.contact_actions(source, target, contact, user, override_path=str(path))
    assert rows(moved.rows) == [(101, 5, 5, "too"), (103, 4, 4, "from file")]
    assert rows(moved.relationship.pairs) == [(8, 101), (9, 103)]


def test_cards_of_a_stranger_do_not_slip_in_by_their_old_contact_id(frame, rows, spark):
    # Contact 553 is an old id nobody moved and at the same time a new id.
    staged = frame("Id BIGINT, ContactId BIGINT", (1, 10), (2, 553), (3, 0))
    contact = Relationship(frame(PAIRS, (10, 553)), (0,))
    target = App.of("t", {"CreditCard": frame("Id BIGINT", (9,))})
    moved = people.credit_cards(staged, target.next_id("CreditCard"), contact)
    assert rows(moved.rows) == [(60, 553), (64, 0)]
    assert rows(moved.relationship.pairs) == [(1, 60), (2, 62), (3, 64)]


def order_apps(frame):
    keys = {
        "Address": "Id BIGINT, Street STRING",
        "Job": "Id BIGINT, ContactId BIGINT, InvoiceId BIGINT, ShippingAddressId BIGINT",
        "Invoice": "Id BIGINT, ContactId BIGINT, JobId BIGINT, PayPlanId BIGINT, ProductSold STRING",
        "PayPlan": "Id BIGINT, InvoiceId BIGINT, CC1 BIGINT",
        "InvoiceItem": "Id BIGINT, InvoiceId BIGINT, JobId BIGINT, ContactId BIGINT, OrderItemId BIGINT",
        "OrderItem": "Id BIGINT, OrderId BIGINT, InvoiceItemId BIGINT, ProductId BIGINT, SourceOrderItemId BIGINT",
        "Payment": "Id BIGINT, ContactId BIGINT, InvoiceId BIGINT, RefundId BIGINT",
        "InvoicePayment": "Id BIGINT, InvoiceId BIGINT, PaymentId BIGINT",
        "PayPlanItem": "Id BIGINT, PayPlanId BIGINT",
    }
    content = {
        "Address": [(1, "s")],
        "Job": [(1, 10, 1, 1), (2, 99, 2, 5), (3, 0, 0, 0)],
        "Invoice": [(1, 10, 1, 1, "4, 5"), (2, 10, 2, 0, None), (3, 0, 3, 9, "")],
        "PayPlan": [(1, 1, 8), (2, 2, 8)],
        "InvoiceItem": [(1, 1, 1, 10, 2), (2, 2, 2, 10, 1), (3, 1, 1, 99, 1)],
        "OrderItem": [(1, 2, 2, 4, 0), (2, 1, 1, 4, 1), (3, 1, 0, 6, 77)],
        "Payment": [(1, 10, 1, 2), (2, 10, 2, 0)],
        "InvoicePayment": [(1, 1, 1), (2, 1, 2)],
        "PayPlanItem": [(1, 1), (2, 2)],
    }
    source = App.of("old", {t: frame(k, *content[t]) for t, k in keys.items()})
    target = App.of("new", {t: frame("Id BIGINT", (49,)) for t in keys})
    return source, target


def test_orders_follow_their_parents_on_old_ids(frame, rows):
    source, target = order_apps(frame)
    rels = {
        "contact": Relationship(frame(PAIRS, (10, 553)), (0,)),
        "user": Relationship(frame(PAIRS), (0, -1)),
        "product": Relationship(frame(PAIRS, (4, 400), (5, 500))),
        "plan": Relationship(frame(PAIRS)),
    }
    made = sales.orders(source, target, rels)
    got = {t: rows(r) for t, r in made.rows.items()}
    assert rows(made.rels["job"].pairs) == [(1, 100), (2, 102), (3, 104)]
    assert rows(made.rows["Job"], "Id", "ContactId", "InvoiceId", "ShippingAddressId", "OppId") == [
        (100, 553, 100, 100, 0), (104, 0, 0, None, 0),
    ]
    assert rows(made.rows["Invoice"], "Id", "JobId", "PayPlanId", "ProductSold") == [
        (100, 100, 100, "400,500"), (104, 104, None, ""),
    ]
    assert rows(made.rows["PayPlan"], "Id", "InvoiceId", "CC1", "PaymentSubType") == [
        (100, 100, 0, "USE_DEFAULT"),
    ]
    assert rows(made.rows["InvoiceItem"], "Id", "OrderItemId") == [(100, 102)]
    assert rows(made.rows["OrderItem"], "Id", "OrderId", "InvoiceItemId", "ProductId", "SourceOrderItemId") == [
        (102, 100, 100, 400, 100), (104, 100, 0, None, None),
    ]
    assert rows(made.rows["Payment"], "Id", "RefundId") == [(100, 102)]
    assert got["InvoicePayment"][0][:3] == (100, 100, 100) and len(got["InvoicePayment"]) == 1
    assert got["PayPlanItem"] == [(100, 100)]
    assert got["Address"] == [(100, "s")]


def test_cards_are_looked_up_when_they_moved(frame, rows):
    source, target = order_apps(frame)
    rels = {
        "contact": Relationship(frame(PAIRS, (10, 553)), (0,)),
        "card": Relationship(frame(PAIRS, (8, 800)), (0,)),
    }
    payplan = sales.Orders(source, target, rels).rows("payplan")
    assert rows(payplan, "Id", "CC1") == [(100, 800)]


def test_ids_before_or_after_the_filter(frame, rows, spark):
    table = frame("Id BIGINT, P BIGINT", (1, 5), (2, 6), (3, 5))
    rels = {"p": Relationship(frame(PAIRS, (5, 55)))}
    start = App.of("t", {"T": frame("Id BIGINT", (9,))}).next_id("T")
    after = move(TableSpec("T", parents={"P": "p"}), table, start, rels)
    before = move(TableSpec("T", parents={"P": "p"}, numbers_all=True), table, start, rels)
    assert rows(after.rows) == [(10, 55), (12, 55)]
    assert rows(before.rows) == [(10, 55), (14, 55)]
    assert rows(before.relationship.pairs) == [(1, 10), (2, 12), (3, 14)]
    assert rows(before.kept.pairs) == [(1, 10), (3, 14)]


def test_constants_take_the_column_type(frame):
    got = set_constants(frame("A STRING, B INT", ("x", 1)), {"A": 0, "B": None, "C": 0, "D": "t"})
    assert got.dtypes == [("A", "string"), ("B", "int"), ("C", "bigint"), ("D", "string")]
    assert tuple(got.first()) == ("0", None, 0, "t")


def test_unchanged_dropdowns_are_no_modification(frame, rows):
    kind = "Name STRING, Value STRING"
    source = App.of("a", {"AppSetting": frame(kind, ("optiontypes", "x"))})
    same = App.of("b", {"AppSetting": frame(kind, ("optiontypes", "y,x"))})
    lacking = App.of("b", {"AppSetting": frame(kind, ("optiontypes", "y"))})
    assert rows(switches.was_modified(switches.dropdown_updates(source, same))) == [(False,)]
    assert rows(switches.was_modified(switches.dropdown_updates(source, lacking))) == [(True,)]
    assert rows(switches.dropdowns_merged(source, lacking)) == [("optiontypes", "y,x")]


def test_product_category_parents_follow(frame, rows):
    kind = "Id BIGINT, CategoryDisplayName STRING, ParentId BIGINT"
    source = App.of("a", {"ProductCategory": frame(kind, (1, "top", None), (2, "sub", 1), (3, "deep", 2))})
    target = App.of("b", {"ProductCategory": frame(kind, (9, "sub", 0))})
    made = sales.product_categories(source, target)
    assert rows(made.rows["ProductCategory"]) == [(60, "top", 0), (62, "deep", 9)]
