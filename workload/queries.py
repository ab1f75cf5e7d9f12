"""Registered queries, each with the statement that checks it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regraft.functions.columns import filled, list_union
from regraft.operators.diff import add_columns, append_rows, frame_difference, pick, rename_columns, upsert
from regraft.operators.ids import allocate_ids, fill_new_ids
from regraft.operators.integrity import (
    cascade,
    count_report,
    first_per_key,
    grouped_list,
    in_use,
    keep_children,
    without_existing,
)
from regraft.operators.match import Keep, buckets_of, lazily, match_or_create, natural_match
from regraft.operators.names import free_names
from regraft.operators.relationship import Relationship
from regraft.operators.remap import bad_list_tokens, remap, remap_list, remap_or_default, remap_or_keep
from regraft.operators.settings import set_values, setting
from regraft.plans import contacts as people
from regraft.plans import sales
from regraft.plans import settings as switches
from regraft.plans.crm import CONTACT, CREDIT_CARD, DROPDOWN_SETTINGS, ORDER_TABLES
from regraft.plans.custom_fields import (
    custom_fields,
    drilldown_options,
    field_rows,
    match_fields,
    tabs_and_headers,
)
from regraft.plans.spec import give_ids
from regraft.plans.transfer import Selection, Transfer
from regraft.sources.app import App
from regraft.sources.catalog import append_table
from regraft.sources.ledger import Book
from regraft.sources.relationships import checked_pairs, csv_rows, pairs_from_json, pairs_to_json, read_csv, read_relationships, write_csv, write_json
from regraft.sources.sinks import fresh_rows, overridden, snapshot, with_updates
from regraft.sources.staging import Staging, at_once
from workload.inputs import Inputs, with_inputs

Query = Callable[[SparkSession, str], DataFrame]
RUN_TIME = datetime(2024, 6, 1, 12, 30, 15)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Work:
    """Inputs of one query with the relationships that several queries need.

    ``staged`` writes each relationship once, as a real transfer does; without
    it everything stays one plan.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.inputs = Inputs(spark, folder)
        self.source = self.inputs.source()
        self.target = self.inputs.target()
        self.keep: Keep = lazily

    def staged(self, buckets: int = 0) -> Work:
        self.keep = Staging(self.spark, buckets=buckets).keeper()
        return self

    def __getitem__(self, name: str) -> DataFrame:
        return self.inputs[name]

    @cached_property
    def contact(self) -> Relationship:
        rows = people.people(self.source).select("Id")
        numbered = give_ids(CONTACT, rows, self.target.next_id("Contact"), {}, self.keep)
        return Relationship(numbered.select("old_id", "new_id"), CONTACT.identities, buckets_of(self.keep))

    @cached_property
    def user(self) -> Relationship:
        return people.user_relationship(self.source, self.target, self.keep)

    @cached_property
    def tag(self) -> Relationship:
        return people.tags(self.source, self.target).rels["tag"]

    @cached_property
    def product(self) -> Relationship:
        return match_or_create(
            self["src_product"],
            self["dst_product"],
            ["ProductName"],
            self.target.next_id("Product"),
            name="Product_ids",
            keep=self.keep,
        ).relationship

    @cached_property
    def plan(self) -> Relationship:
        made = sales.subscription_plans(self.source, self.target, self.product, self.keep)
        return made.rels["plan"]

    @cached_property
    def card(self) -> Relationship:
        numbered = give_ids(
            CREDIT_CARD, self["staged_card"], self.target.next_id("CreditCard"), {}, self.keep
        )
        return Relationship(numbered.select("old_id", "new_id"), CREDIT_CARD.identities, buckets_of(self.keep))

    @cached_property
    def existing_contact(self) -> Relationship:
        """Contacts as if all of them were in the target already."""
        pairs = people.people(self.source).select(
            F.col("Id").alias("old_id"), (100000 + 3 * F.col("Id")).alias("new_id")
        )
        return Relationship(pairs, (0,))

    def rels(self, *names: str) -> dict[str, Relationship]:
        if self.keep is not lazily:
            at_once([partial(getattr, self, name) for name in names if name != "product"])
        return {name: getattr(self, name) for name in names}

    def orders(self, *names: str, whole: bool = True) -> sales.Orders:
        return sales.Orders(self.source, self.target, self.rels(*names), self.keep, whole)


#: Queries whose relationships are written once and read back, as in a transfer; for the
#: others one plan was as fast or faster at sf0.1, with exchanges reused.
STAGED = ("q30_orders_cascade", "q30_order_items", "q32_", "q33_")

#: Queries that read the order lines in several places. The lines get their ids by a shuffle
#: of whole rows, which is done once and written; the others would only write more.
LINES_ONCE = (
    "q18_", "q30_orders_cascade", "q30_order_items", "q30_invoices", "q30_invoice_items",
    "q34_", "q40_", "q54_",
)


def query(name: str, sql: str):
    def register(build: Callable[[Work], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            work = Work(spark, folder)
            if name.startswith(LINES_ONCE):
                work.inputs.once("line_base", Staging(spark).keeper("inputs/"))
            return build(work.staged() if name.startswith(STAGED) else work)

        QUERIES[name] = run
        ORACLES[name] = sql
        return build

    return register


# How the checking statements number, match and look up.


def _numbered(src: str, dst: str, offset: int, where: str = "") -> str:
    return (
        f"SELECT Id AS old_id, (SELECT max(Id) + 1 FROM {{{dst}}}) + {offset} "
        f"+ 2 * (row_number() OVER (ORDER BY Id) - 1) AS new_id FROM {{{src}}} {where}"
    )


def _matched(src: str, dst: str, keys: list[str], offset: int = 0, where: str = "") -> str:
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM d.{k}" for k in keys)
    cols = ", ".join(keys)
    return (
        f"SELECT old_id, new_id IS NULL AS created, coalesce(new_id, (SELECT max(Id) + 1 FROM {{{dst}}}) + {offset} "
        f"+ 2 * (row_number() OVER (PARTITION BY new_id IS NULL ORDER BY old_id) - 1)) AS new_id "
        f"FROM (SELECT s.Id AS old_id, d.Id AS new_id FROM (SELECT * FROM {{{src}}} {where}) AS s "
        f"LEFT JOIN (SELECT {cols}, max(Id) AS Id FROM {{{dst}}} {where} GROUP BY {cols}) AS d ON {on})"
    )


def _ident(column: str, alias: str, *identities: int) -> str:
    """Value of a joined relationship, reserved ids first."""
    if not identities:
        return f"{alias}.new_id"
    listed = ", ".join(map(str, identities))
    return f"CASE WHEN {column} IN ({listed}) THEN {column} ELSE {alias}.new_id END"


ORACLE_RELATIONS: dict[str, str] = {
    "rel_contact": _numbered("src_contact", "dst_contact", 500, "WHERE IsUser = 0"),
    "rel_user": """
        WITH by_gid AS (
            SELECT s.Id AS old_id, coalesce(max(d.Id), 0) AS new_id
            FROM {src_user} AS s LEFT JOIN {dst_user} AS d
              ON s.GlobalUserId IS NOT DISTINCT FROM d.GlobalUserId GROUP BY s.Id),
        by_mail AS (
            SELECT s.Id AS old_id, max(d.Id) AS new_id
            FROM {src_contact} AS s JOIN {dst_contact} AS d ON s.Email = d.Email
            WHERE s.Email <> '' AND s.Id IN (SELECT Id FROM {src_user})
              AND d.Id IN (SELECT Id FROM {dst_user}) GROUP BY s.Id)
        SELECT g.old_id, coalesce(m.new_id, g.new_id) AS new_id
        FROM by_gid AS g LEFT JOIN by_mail AS m ON g.old_id = m.old_id""",
    "rel_lead_source_category": _matched(
        "src_lead_source_category", "dst_lead_source_category", ["Name"]
    ),
    "rel_lead_source": _matched("src_lead_source", "dst_lead_source", ["Name"]),
    "rel_tag_category": _matched("src_tag_category", "dst_tag_category", ["CategoryName"]),
    "rel_tag": _matched("src_tag", "dst_tag", ["GroupName"]),
    "rel_product": _matched("src_product", "dst_product", ["ProductName"]),
    "exp_src_plan": """
        SELECT p.Id, r.new_id AS ProductId, coalesce(Cycle, 0) AS Cycle, coalesce(Frequency, 0) AS Frequency,
               coalesce(NumberOfCycles, 0) AS NumberOfCycles,
               coalesce(CAST(PlanPrice AS DOUBLE), 0) AS PlanPrice
        FROM {src_plan} AS p JOIN {rel_product} AS r ON p.ProductId = r.old_id""",
    "exp_dst_plan": """
        SELECT Id, coalesce(ProductId, 0) AS ProductId, coalesce(Cycle, 0) AS Cycle,
               coalesce(Frequency, 0) AS Frequency, coalesce(NumberOfCycles, 0) AS NumberOfCycles,
               coalesce(CAST(PlanPrice AS DOUBLE), 0) AS PlanPrice
        FROM {dst_plan}""",
    "rel_plan": _matched(
        "exp_src_plan",
        "exp_dst_plan",
        ["ProductId", "Cycle", "Frequency", "NumberOfCycles", "PlanPrice"],
    ),
    "rel_product_category": _matched(
        "src_product_category", "dst_product_category", ["CategoryDisplayName"], 50
    ),
    "rel_stage": _matched("src_stage", "dst_stage", ["StageName"], 10),
    "rel_card": _numbered("staged_card", "dst_card", 50),
    "rel_opportunity": """
        SELECT Id AS old_id, (SELECT max(Id) + 1 FROM {dst_opportunity}) + 50
               + 2 * (row_number() OVER (ORDER BY Id) - 1) AS new_id
        FROM {src_opportunity}
        WHERE ContactID = 0 OR ContactID IN (SELECT old_id FROM {rel_contact})""",
    "rel_subscription": """
        SELECT Id AS old_id, (SELECT max(Id) + 1 FROM {dst_subscription}) + 50
               + 2 * (row_number() OVER (ORDER BY Id) - 1) AS new_id
        FROM {src_subscription}
        WHERE ContactId = 0 OR ContactId IN (SELECT old_id FROM {rel_contact})""",
    "rel_tab": _matched("src_form_tab", "dst_form_tab", ["TabName"], 0, "WHERE FormId = -1"),
    "exp_src_header": """
        SELECT g.Id, t.new_id AS TabId, g.GroupName
        FROM {src_form_group} AS g LEFT JOIN {rel_tab} AS t ON g.TabId = t.old_id""",
    "rel_header": _matched("exp_src_header", "dst_form_group", ["TabId", "GroupName"]),
    "rel_field": _matched(
        "src_form_field", "dst_form_field", ["DisplayName", "DataType"], 50, "WHERE FormId = -1"
    ),
    **{
        f"rel_{n}": _numbered(f"src_{n}", f"dst_{n}", 50)
        for n in (
            "interest", "address", "job", "invoice", "payplan", "invoice_item", "order_item",
            "payment", "invoice_payment", "payplan_item", "order_subscription",
        )
    },
    # Old ids of the rows that stay, parents first.
    "kept_job": """
        SELECT Id FROM {src_job}
        WHERE ContactId = 0 OR ContactId IN (SELECT old_id FROM {rel_contact})""",
    "kept_invoice": """
        SELECT Id FROM {src_invoice}
        WHERE (ContactId = 0 OR ContactId IN (SELECT old_id FROM {rel_contact}))
          AND JobId IN (SELECT Id FROM {kept_job})""",
    "kept_payplan": """
        SELECT Id FROM {src_payplan} WHERE InvoiceId IN (SELECT Id FROM {kept_invoice})""",
    "kept_payment": """
        SELECT Id FROM {src_payment}
        WHERE (ContactId = 0 OR ContactId IN (SELECT old_id FROM {rel_contact}))
          AND InvoiceId IN (SELECT Id FROM {kept_invoice})""",
    "exp_taken": """
        SELECT DISTINCT replace(p_name, ' ', '') || CAST(p_size AS STRING) AS name
        FROM {part} WHERE p_type = 'SMALL' OR p_type = 'ECONOMY'
        UNION SELECT DISTINCT replace(p_name, ' ', '') FROM {part} WHERE p_type = 'SMALL'""",
}


def oracle_statements() -> dict[str, str]:
    return {name: with_inputs(sql, ORACLE_RELATIONS) for name, sql in ORACLES.items()}


# Scans.


@query("q01_scan_pruned", "SELECT Id, Email FROM {src_contact}")
def scan_pruned(w: Work) -> DataFrame:
    return pick(w.source.table("Contact"), ["Id", "Email", "NoSuchColumn"])


@query(
    "q02_count_where",
    """SELECT 'contacts' AS object, count(*) AS rows FROM {src_contact} WHERE IsUser = 0 AND Id <> CompanyID
       UNION ALL SELECT 'companies', count(*) FROM {src_contact} WHERE Id = CompanyID
       UNION ALL SELECT 'all', count(*) FROM {src_contact}""",
)
def count_where(w: Work) -> DataFrame:
    counts = {
        "contacts": w.source.count("Contact", "IsUser = 0 AND Id <> CompanyID"),
        "companies": w.source.count("Contact", "Id = CompanyID"),
        "all": w.source.count("Contact"),
    }
    named = [c.select(F.lit(n).alias("object"), "rows") for n, c in counts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("q03_high_water", "SELECT max(Id) + 1 AS next_id FROM {dst_contact}")
def next_free_id(w: Work) -> DataFrame:
    return w.spark.range(1).select(w.target.next_id("Contact").alias("next_id"))


@query(
    "q04_setting_lookup",
    """SELECT (SELECT Value FROM {src_setting} WHERE Name = 'optiontitles') AS titles,
              (SELECT Value FROM {src_setting} WHERE Name = 'nothing') AS missing""",
)
def setting_lookup(w: Work) -> DataFrame:
    settings = w["src_setting"]
    return w.spark.range(1).select(
        setting(settings, "optiontitles").alias("titles"), setting(settings, "nothing").alias("missing")
    )


# Matching and id allocation.


@query(
    "q05_natural_match",
    """SELECT s.Id AS old_id, d.Id AS new_id FROM {src_part} AS s
       LEFT JOIN (SELECT Name, max(Id) AS Id FROM {dst_part} GROUP BY Name) AS d
         ON s.Name IS NOT DISTINCT FROM d.Name""",
)
def match_by_name(w: Work) -> DataFrame:
    return natural_match(w["src_part"], w["dst_part"], ["Name"])


@query(
    "q06_composite_match",
    """SELECT s.Id AS old_id, d.Id AS new_id
       FROM (SELECT Id, Name, Brand, coalesce(Size, 0) AS Size,
                    coalesce(CAST(Price AS DOUBLE), 0) AS Price FROM {src_part}) AS s
       LEFT JOIN (SELECT Name, Brand, coalesce(Size, 0) AS Size,
                         coalesce(CAST(Price AS DOUBLE), 0) AS Price, max(Id) AS Id
                  FROM {dst_part} GROUP BY ALL) AS d
         ON s.Name IS NOT DISTINCT FROM d.Name AND s.Brand = d.Brand
            AND s.Size = d.Size AND s.Price = d.Price""",
)
def match_by_terms(w: Work) -> DataFrame:
    def comparable(parts: DataFrame) -> DataFrame:
        return parts.withColumns(
            {"Size": filled("Size", 0), "Price": filled(F.col("Price").cast("double"), 0)}
        )

    keys = ["Name", "Brand", "Size", "Price"]
    return natural_match(comparable(w["src_part"]), comparable(w["dst_part"]), keys)


@query("q07_match_or_create", "SELECT old_id, new_id FROM {rel_product}")
def product_relationship(w: Work) -> DataFrame:
    return w.product.pairs


@query(
    "q07_created_rows",
    """SELECT r.new_id AS Id, ProductName, Sku, Price
       FROM {src_product} AS s JOIN {rel_product} AS r ON s.Id = r.old_id WHERE r.created""",
)
def created_products(w: Work) -> DataFrame:
    return match_or_create(
        w["src_product"], w["dst_product"], ["ProductName"], w.target.next_id("Product")
    ).rows


@query(
    "q07_one_per_key",
    """WITH matched AS (
           SELECT s.Id AS old_id, s.Name, d.Id AS new_id FROM {src_part} AS s
           LEFT JOIN (SELECT Name, max(Id) AS Id FROM {dst_part} GROUP BY Name) AS d
             ON s.Name IS NOT DISTINCT FROM d.Name),
       firsts AS (
           SELECT Name, min(old_id) AS first_id,
                  7 + 2 * (row_number() OVER (ORDER BY min(old_id)) - 1) AS new_id
           FROM matched WHERE new_id IS NULL GROUP BY Name)
       SELECT m.old_id, coalesce(m.new_id, f.new_id) AS new_id
       FROM matched AS m LEFT JOIN firsts AS f ON m.Name IS NOT DISTINCT FROM f.Name""",
)
def one_per_key(w: Work) -> DataFrame:
    made = match_or_create(w["src_part"], w["dst_part"], ["Name"], 7, dedupe_source_keys=True)
    return made.relationship.pairs


@query(
    "q08_allocate_ids",
    "SELECT Id AS old_id, 10 + 2 * (row_number() OVER (ORDER BY Id) - 1) AS new_id FROM {line_base}",
)
def allocate_all(w: Work) -> DataFrame:
    return allocate_ids(w["line_base"], 10)


@query(
    "q09_allocate_after_filter",
    """SELECT Id AS old_id, 1000 + 2 * (row_number() OVER (ORDER BY Id) - 1) AS new_id
       FROM {order_base} WHERE ContactId IN (SELECT Id FROM {src_contact} WHERE IsUser = 0)""",
)
def allocate_kept(w: Work) -> DataFrame:
    kept = keep_children(w["order_base"], "ContactId", people.people(w.source))
    return allocate_ids(kept, 1000)


# Remapping.


@query(
    "q10_remap_fk",
    f"""SELECT o.Id, {_ident('o.ContactId', 'c', 0)} AS ContactId
        FROM {{order_base}} AS o LEFT JOIN {{rel_contact}} AS c ON o.ContactId = c.old_id""",
)
def remap_fk(w: Work) -> DataFrame:
    return remap(w["order_base"].select("Id", "ContactId"), {"ContactId": w.contact})


@query(
    "q11_remap_fallback",
    """SELECT o.Id, coalesce(s.new_id, (SELECT min(Id) FROM {dst_stage})) AS StageID
       FROM {src_opportunity} AS o LEFT JOIN {rel_stage} AS s ON o.StageID = s.old_id""",
)
def remap_stage(w: Work) -> DataFrame:
    default = w.target.setting("defaultstage").cast("bigint")
    rel = sales.stages(w.source, w.target).rels["stage"]
    return remap_or_default(w["src_opportunity"].select("Id", "StageID"), "StageID", rel, default)


@query(
    "q12_self_remap",
    f"""SELECT r.new_id AS Id, {_ident('s.CompanyID', 'c', 0)} AS CompanyID
        FROM {{src_contact}} AS s JOIN {{rel_contact}} AS r ON s.Id = r.old_id
        LEFT JOIN {{rel_contact}} AS c ON s.CompanyID = c.old_id""",
)
def self_remap(w: Work) -> DataFrame:
    rows = people.people(w.source).select("Id", "CompanyID")
    return remap(remap(rows, {"CompanyID": w.contact}), {"Id": w.contact}, required=True)


@query(
    "q13_update_join",
    """SELECT o.Id, coalesce(c.new_id, o.ContactId) AS ContactId
       FROM {order_base} AS o LEFT JOIN {rel_contact} AS c ON o.ContactId = c.old_id""",
)
def update_join(w: Work) -> DataFrame:
    return remap_or_keep(w["order_base"].select("Id", "ContactId"), "ContactId", w.contact)


# Which rows go along.


@query(
    "q14_semi_children",
    """SELECT Id, OrderId, Qty FROM {line_base}
       WHERE OrderId IN (SELECT Id FROM {order_base}
                         WHERE ContactId IN (SELECT Id FROM {src_contact} WHERE IsUser = 0))""",
)
def semi_children(w: Work) -> DataFrame:
    tables = {
        "contact": people.people(w.source),
        "order": w["order_base"],
        "line": w["line_base"].select("Id", "OrderId", "Qty"),
    }
    return cascade(tables, [("order", "ContactId", "contact"), ("line", "OrderId", "order")])["line"]


@query(
    "q15_anti_existing",
    """SELECT Id, 100000 + 3 * ContactId AS ContactId, 100000 + 3 * GroupId AS GroupId
       FROM {src_tag_application} AS s
       WHERE NOT EXISTS (SELECT 1 FROM {dst_tag_application} AS d
                         WHERE d.ContactId = 100000 + 3 * s.ContactId AND d.GroupId = 100000 + 3 * s.GroupId)""",
)
def anti_existing(w: Work) -> DataFrame:
    rows = w["src_tag_application"].select(
        "Id",
        (100000 + 3 * F.col("ContactId")).alias("ContactId"),
        (100000 + 3 * F.col("GroupId")).alias("GroupId"),
    )
    return without_existing(rows, w["dst_tag_application"], ["ContactId", "GroupId"])


@query(
    "q16_dedupe_subset",
    """SELECT Id, ContactId, GroupId, DateCreated FROM (
           SELECT *, row_number() OVER (PARTITION BY ContactId, GroupId ORDER BY DateCreated, Id) AS turn
           FROM {src_tag_application}) WHERE turn = 1""",
)
def dedupe_subset(w: Work) -> DataFrame:
    return first_per_key(w["src_tag_application"], ["ContactId", "GroupId"], ["DateCreated"])


# Lists inside cells.


@query(
    "q17_remap_list",
    """SELECT g.ContactId AS Id, coalesce(l.Groups, '') AS Groups
       FROM {contact_groups} AS g LEFT JOIN (
           SELECT ContactId, string_agg(r.new_id, ',' ORDER BY pos) AS Groups
           FROM (SELECT ContactId, unnest(string_split(Groups, ',')) AS token,
                        generate_subscripts(string_split(Groups, ','), 1) AS pos FROM {contact_groups}) AS t
           JOIN {rel_tag} AS r ON r.old_id = CASE WHEN regexp_full_match(token, '[0-9]+')
                                                  THEN CAST(token AS BIGINT) END
           GROUP BY ContactId) AS l ON g.ContactId = l.ContactId""",
)
def tag_lists(w: Work) -> DataFrame:
    rows = w["contact_groups"].withColumnRenamed("ContactId", "Id")
    return remap_list(rows, "Groups", w.tag)


_SOLD = """
    SELECT o.OrderId, coalesce(l.ProductSold, '') AS ProductSold
    FROM {product_sold} AS o LEFT JOIN (
        SELECT OrderId, string_agg(r.new_id, ',' ORDER BY pos) AS ProductSold
        FROM (SELECT OrderId, unnest(string_split(ProductSold, ',')) AS token,
                     generate_subscripts(string_split(ProductSold, ','), 1) AS pos FROM {product_sold}) AS t
        JOIN {rel_product} AS r ON r.old_id = TRY_CAST(trim(token) AS BIGINT)
        GROUP BY OrderId) AS l ON o.OrderId = l.OrderId"""


@query("q18_remap_list_strict", f"SELECT OrderId AS Id, ProductSold FROM ({_SOLD})")
def product_lists(w: Work) -> DataFrame:
    rows = w["product_sold"].withColumnRenamed("OrderId", "Id")
    return remap_list(rows, "ProductSold", w.product, strict=True)


# Differences.

_FIRST = """SELECT c_custkey AS Id, c_name AS Name, c_mktsegment AS Segment FROM {customer}
            UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM {customer} WHERE c_custkey % 10 = 3"""
_SECOND = """SELECT c_custkey AS Id, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS Name,
                    CASE WHEN c_nationkey > 12 THEN 'OTHER' ELSE c_mktsegment END AS Segment
             FROM {customer} UNION ALL SELECT c_custkey, c_name, 'EXTRA' FROM {customer}
             UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM {customer} WHERE c_custkey % 15 = 3"""


def _only_in(rows: str, other: str, label: str) -> str:
    return f"""SELECT Id, Name, Segment, '{label}' AS _merge FROM ({rows}) AS mine WHERE NOT EXISTS (
                   SELECT 1 FROM ({other}) AS theirs WHERE mine.Id = theirs.Id
                   AND mine.Name IS NOT DISTINCT FROM theirs.Name AND mine.Segment IS NOT DISTINCT FROM theirs.Segment)"""


@query("q19_frame_difference", f"{_only_in(_SECOND, _FIRST, 'left_only')} UNION ALL {_only_in(_FIRST, _SECOND, 'right_only')}")
def both_differences(w: Work) -> DataFrame:
    return frame_difference(w.inputs.sql(_FIRST), w.inputs.sql(_SECOND))


@query("q20_one_sided_difference", _only_in(_FIRST, _SECOND, "right_only"))
def one_difference(w: Work) -> DataFrame:
    return frame_difference(w.inputs.sql(_FIRST), w.inputs.sql(_SECOND), "right_only")


@query(
    "q20_common_rows",
    f"""SELECT Id, Name, Segment, count(*) AS copies, 'both' AS _merge
        FROM ({_FIRST}) AS l JOIN (SELECT Id AS Id2, Name AS Name2, Segment AS Segment2 FROM ({_SECOND})) AS r
          ON Id = Id2 AND Name IS NOT DISTINCT FROM Name2 AND Segment = Segment2
        GROUP BY Id, Name, Segment""",
)
def common_rows(w: Work) -> DataFrame:
    return frame_difference(w.inputs.sql(_FIRST), w.inputs.sql(_SECOND), "both")


_LISTS = """
    SELECT OrderId AS Id, <<CAST(ProductId AS STRING)|LineNumber>> AS have,
           <<CAST(SupplierKey + 1 AS STRING)|LineNumber>> AS more
    FROM {line_base} GROUP BY OrderId"""


@query(
    "q21_list_union",
    f"""SELECT Id, array_to_string(list_concat(string_split(have, ','),
               [x FOR x IN string_split(more, ',') IF NOT list_contains(string_split(have, ','), x)]), ',')
               AS merged FROM ({_LISTS})""",
)
def lists_merged(w: Work) -> DataFrame:
    return w.inputs.sql(_LISTS).select("Id", list_union("have", "more").alias("merged"))


# Names and schemas.


@query(
    "q22_free_names",
    """WITH cleaned AS (
           SELECT p_partkey + 1 AS Id,
                  replace(p_name, ' ', '') || CASE WHEN p_retailprice > 950 THEN '' ELSE CAST(p_size AS STRING) END AS clean
           FROM {part}),
       wanted AS (
           SELECT DISTINCT clean, regexp_extract(clean, '^(.*?)([0-9]*)$', 1) AS stem,
                  coalesce(TRY_CAST(regexp_extract(clean, '^(.*?)([0-9]*)$', 2) AS BIGINT) + 1, 0) AS first_number
           FROM cleaned),
       found AS (
           SELECT clean, stem || CAST(min(n) AS STRING) AS next_name
           FROM wanted, (SELECT unnest(generate_series(0, 200)) AS n) AS numbers
           WHERE n >= first_number AND stem || CAST(n AS STRING) NOT IN (SELECT name FROM {exp_taken})
           GROUP BY clean, stem)
       SELECT c.Id, CASE WHEN t.name IS NULL THEN c.clean ELSE f.next_name END AS free_name
       FROM cleaned AS c LEFT JOIN {exp_taken} AS t ON c.clean = t.name
       LEFT JOIN found AS f ON c.clean = f.clean""",
)
def names_free(w: Work) -> DataFrame:
    names = w.inputs.sql(
        """SELECT p_partkey + 1 AS Id,
                  p_name || CASE WHEN p_retailprice > 950 THEN '!' ELSE CAST(p_size AS STRING) END AS name
           FROM {part}"""
    )
    taken = w.inputs.sql(ORACLE_RELATIONS["exp_taken"])
    return free_names(names, taken, "name", "free_name").select("Id", "free_name")


@query(
    "q23_schema_diff",
    """SELECT 'Segment' AS Field, 'string' AS Type, 'right_only' AS _merge, count(c_mktsegment) AS filled FROM {customer}
       UNION ALL SELECT 'Nation', 'double', 'right_only', count(c_nationkey) FROM {customer}
       UNION ALL SELECT 'NoField', 'string', 'right_only', count(c_name) FROM {customer}""",
)
def schema_gap(w: Work) -> DataFrame:
    """Columns the source has and the target lacks, and how many rows fill each."""
    mine, theirs = (a.schema_rows("Custom_Contact").select("Field", "Type") for a in (w.source, w.target))
    gap = frame_difference(mine, theirs, "right_only")
    table = w.source.table("Custom_Contact")
    counts = table.agg(*[F.count(c).alias(c) for c in table.columns])
    filled_rows = counts.unpivot([], counts.columns, "Column", "filled")
    return gap.join(filled_rows, F.col("Field") == F.col("Column")).drop("Column")


_NEW_VALUES = """
    SELECT CASE WHEN Code9 < 12 THEN 100000 + 3 * Id ELSE 9000000000 + Id END AS Id,
           Segment AS MarketSegment, Code9 AS Code9, NoField AS Nickname FROM {src_custom}"""


@query(
    "q24_add_columns_upsert",
    f"""SELECT Id, MarketSegment, Balance, Nation, Code9, CAST(NULL AS VARCHAR) AS Nickname
        FROM {{dst_custom}} WHERE Id NOT IN (SELECT Id FROM ({_NEW_VALUES}))
        UNION ALL SELECT Id, MarketSegment, NULL, NULL, Code9, Nickname FROM ({_NEW_VALUES})""",
)
def widened_upsert(w: Work) -> DataFrame:
    rows = w.inputs.sql(
        "SELECT CASE WHEN Code9 < 12 THEN 100000 + 3 * Id ELSE 9000000000 + Id END AS Id, "
        "Segment, Code9, NoField FROM {src_custom}"
    )
    rows = rename_columns(rows, {"Segment": "MarketSegment", "NoField": "Nickname"})
    return upsert(add_columns(w["dst_custom"], {"Nickname": "string"}), rows)


# Contacts family.


@query("q25_user_relationship", "SELECT old_id, new_id FROM {rel_user}")
def users(w: Work) -> DataFrame:
    return w.user.pairs


@query(
    "q26_lead_sources",
    f"""SELECT r.new_id AS Id, s.Name, {_ident('s.LeadSourceCategoryId', 'c', 0)} AS LeadSourceCategoryId
        FROM {{src_lead_source}} AS s JOIN {{rel_lead_source}} AS r ON s.Id = r.old_id
        LEFT JOIN {{rel_lead_source_category}} AS c ON s.LeadSourceCategoryId = c.old_id WHERE r.created""",
)
def lead_sources(w: Work) -> DataFrame:
    return people.lead_sources(w.source, w.target).rows["LeadSource"]


@query(
    "q27_tags",
    f"""SELECT r.new_id AS Id, s.GroupName, {_ident('s.GroupCategoryId', 'c', 0)} AS GroupCategoryId,
               s.GroupDescription, s.ImportId
        FROM {{src_tag}} AS s JOIN {{rel_tag}} AS r ON s.Id = r.old_id
        LEFT JOIN {{rel_tag_category}} AS c ON s.GroupCategoryId = c.old_id WHERE r.created""",
)
def tags(w: Work) -> DataFrame:
    return people.tags(w.source, w.target).rows["ContactGroup"]


@query(
    "q28_contacts",
    f"""WITH lists AS (
            SELECT ContactId, string_agg(r.new_id, ',' ORDER BY pos) AS Groups
            FROM (SELECT ContactId, unnest(string_split(Groups, ',')) AS token,
                         generate_subscripts(string_split(Groups, ','), 1) AS pos FROM {{contact_groups}}) AS t
            JOIN {{rel_tag}} AS r ON r.old_id = CASE WHEN regexp_full_match(token, '[0-9]+')
                                                     THEN CAST(token AS BIGINT) END
            GROUP BY ContactId)
        SELECT r.new_id AS Id, s.Email, s.IsUser, {_ident('s.CompanyID', 'c', 0)} AS CompanyID,
               {_ident('s.CreatedBy', 'u1', 0, -1)} AS CreatedBy,
               {_ident('s.LastUpdatedBy', 'u2', 0, -1)} AS LastUpdatedBy,
               {_ident('s.OwnerID', 'u3', 0, -1)} AS OwnerID, ls.new_id AS LeadSourceId,
               s.OffSetTimeZone, s.FullName,
               CASE WHEN s.Groups IS NULL OR s.Groups = '' THEN s.Groups ELSE coalesce(l.Groups, '') END AS Groups
        FROM {{src_contact_grouped}} AS s JOIN {{rel_contact}} AS r ON s.Id = r.old_id
        LEFT JOIN {{rel_contact}} AS c ON s.CompanyID = c.old_id
        LEFT JOIN {{rel_user}} AS u1 ON s.CreatedBy = u1.old_id
        LEFT JOIN {{rel_user}} AS u2 ON s.LastUpdatedBy = u2.old_id
        LEFT JOIN {{rel_user}} AS u3 ON s.OwnerID = u3.old_id
        LEFT JOIN {{rel_lead_source}} AS ls ON s.LeadSourceId = ls.old_id
        LEFT JOIN lists AS l ON s.Id = l.ContactId""",
)
def contacts(w: Work) -> DataFrame:
    made = people.contacts(w.inputs.source_with_groups(), w.target, run_time=RUN_TIME)
    return made.rows["Contact"]


@query(
    "q28_companies",
    """SELECT i.new_id AS Id, m.new_id AS MainContactId, s.CompanyName
       FROM {src_company_owner} AS s JOIN {rel_contact} AS m ON s.MainContactId = m.old_id
       LEFT JOIN {rel_contact} AS i ON s.Id = i.old_id""",
)
def companies(w: Work) -> DataFrame:
    return people.company_owners(w.source, w.contact)


@query(
    "q28_transfer_marker",
    """SELECT c.new_id AS ContactId,
              (SELECT max(new_id) + 1 FROM {rel_tag}) + 10 AS GroupId,
              '2024-06-01 12:30:15' AS DateCreated
       FROM {rel_contact} AS c""",
)
def marker(w: Work) -> DataFrame:
    made = people.contacts(w.source, w.target, with_companies=False, run_time=RUN_TIME)
    applied = made.rows["ContactGroupAssign"]
    moment = F.date_format("DateCreated", "yyyy-MM-dd HH:mm:ss")
    return applied.withColumn("DateCreated", moment)


@query(
    "q29_tag_applications",
    """WITH moved AS (
           SELECT CASE WHEN a.ContactId = 0 THEN 0 ELSE 100000 + 3 * a.ContactId END AS ContactId,
                  t.new_id AS GroupId, a.DateCreated
           FROM {src_tag_application} AS a LEFT JOIN {rel_tag} AS t ON a.GroupId = t.old_id
           WHERE a.ContactId = 0 OR a.ContactId IN (SELECT Id FROM {src_contact} WHERE IsUser = 0))
       SELECT ContactId, GroupId, min(DateCreated) AS DateCreated FROM moved AS m
       WHERE NOT EXISTS (SELECT 1 FROM {dst_tag_application} AS d
                         WHERE d.ContactId = m.ContactId AND d.GroupId = m.GroupId)
       GROUP BY ContactId, GroupId""",
)
def tag_applications(w: Work) -> DataFrame:
    return people.tag_applications(w.source, w.target, w.existing_contact, w.tag)


# Orders family.

_CONTACT = "LEFT JOIN {rel_contact} AS c ON s.ContactId = c.old_id"


@query(
    "q30_orders_cascade",
    """SELECT 'address' AS entity, new_id AS Id FROM {rel_address}
       UNION ALL SELECT 'job', new_id FROM {rel_job} WHERE old_id IN (SELECT Id FROM {kept_job})
       UNION ALL SELECT 'invoice', new_id FROM {rel_invoice} WHERE old_id IN (SELECT Id FROM {kept_invoice})
       UNION ALL SELECT 'payplan', new_id FROM {rel_payplan} WHERE old_id IN (SELECT Id FROM {kept_payplan})
       UNION ALL SELECT 'invoice_item', r.new_id FROM {rel_invoice_item} AS r
                 JOIN {src_invoice_item} AS s ON r.old_id = s.Id
                 WHERE s.ContactId IN (SELECT old_id FROM {rel_contact})
                   AND s.InvoiceId IN (SELECT Id FROM {kept_invoice}) AND s.JobId IN (SELECT Id FROM {kept_job})
       UNION ALL SELECT 'order_item', r.new_id FROM {rel_order_item} AS r
                 JOIN {src_order_item} AS s ON r.old_id = s.Id WHERE s.OrderId IN (SELECT Id FROM {kept_job})
       UNION ALL SELECT 'payment', new_id FROM {rel_payment} WHERE old_id IN (SELECT Id FROM {kept_payment})
       UNION ALL SELECT 'invoice_payment', r.new_id FROM {rel_invoice_payment} AS r
                 JOIN {src_invoice_payment} AS s ON r.old_id = s.Id
                 WHERE s.InvoiceId IN (SELECT Id FROM {kept_invoice}) AND s.PaymentId IN (SELECT Id FROM {kept_payment})
       UNION ALL SELECT 'payplan_item', r.new_id FROM {rel_payplan_item} AS r
                 JOIN {src_payplan_item} AS s ON r.old_id = s.Id
                 WHERE s.PayPlanId IN (SELECT Id FROM {kept_payplan})""",
)
def orders_cascade(w: Work) -> DataFrame:
    """Which rows of the nine tables go along, and under which ids.

    Staged table by table, as a transfer does it.
    """
    family = w.orders("contact", whole=False)
    family.stage_all()
    parts = [
        family.members(name).select(F.lit(name).alias("entity"), F.col("new_id").alias("Id"))
        for name in ORDER_TABLES
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query(
    "q30_jobs",
    f"""SELECT r.new_id AS Id, {_ident('s.ContactId', 'c', 0)} AS ContactId,
               {_ident('s.CreatedBy', 'u1', 0, -1)} AS CreatedBy,
               {_ident('s.LastUpdatedBy', 'u2', 0, -1)} AS LastUpdatedBy,
               a.new_id AS ShippingAddressId, {_ident('s.InvoiceId', 'i', 0)} AS InvoiceId,
               CAST(0 AS BIGINT) AS AffiliateId, CAST(0 AS BIGINT) AS LeadAffiliateId,
               CAST(0 AS BIGINT) AS SalesId, CAST(0 AS BIGINT) AS TechId, CAST(0 AS BIGINT) AS OppId,
               CAST(0 AS BIGINT) AS ProductId, CAST(0 AS BIGINT) AS JumpLogId,
               CAST(0 AS BIGINT) AS MarketingEmailId, CAST(NULL AS BIGINT) AS JobRecurringId,
               CAST(NULL AS BIGINT) AS LegacyJobRecurringInstanceId, CAST(NULL AS BIGINT) AS FileBoxId,
               s.JobNotes, s.DateCreated
        FROM {{src_job}} AS s JOIN {{rel_job}} AS r ON s.Id = r.old_id {_CONTACT}
        LEFT JOIN {{rel_user}} AS u1 ON s.CreatedBy = u1.old_id
        LEFT JOIN {{rel_user}} AS u2 ON s.LastUpdatedBy = u2.old_id
        LEFT JOIN {{rel_address}} AS a ON s.ShippingAddressId = a.old_id
        LEFT JOIN {{rel_invoice}} AS i ON s.InvoiceId = i.old_id
        WHERE s.Id IN (SELECT Id FROM {{kept_job}})""",
)
def jobs(w: Work) -> DataFrame:
    return w.orders("contact", "user").rows("job")


@query(
    "q30_invoices",
    f"""SELECT r.new_id AS Id, {_ident('s.ContactId', 'c', 0)} AS ContactId,
               j.new_id AS JobId, {_ident('s.PayPlanId', 'p', 0)} AS PayPlanId,
               {_ident('s.UserCreate', 'u', 0, -1)} AS UserCreate,
               CASE WHEN s.ProductSold IS NULL THEN NULL ELSE l.ProductSold END AS ProductSold,
               CAST(0 AS BIGINT) AS AffiliateId, CAST(0 AS BIGINT) AS LeadAffiliateId,
               CAST(0 AS BIGINT) AS MarketingEmailId, s.InvoiceTotal
        FROM {{src_invoice}} AS s JOIN {{rel_invoice}} AS r ON s.Id = r.old_id {_CONTACT}
        JOIN {{rel_job}} AS j ON s.JobId = j.old_id
        LEFT JOIN {{rel_payplan}} AS p ON s.PayPlanId = p.old_id
        LEFT JOIN {{rel_user}} AS u ON s.UserCreate = u.old_id
        LEFT JOIN ({_SOLD}) AS l ON s.Id = l.OrderId
        WHERE s.Id IN (SELECT Id FROM {{kept_invoice}})""",
)
def invoices(w: Work) -> DataFrame:
    return w.orders("contact", "user", "product").rows("invoice")


@query(
    "q30_payplans",
    f"""SELECT r.new_id AS Id, i.new_id AS InvoiceId, {_ident('s.CC1', 'k', 0)} AS CC1,
               CAST(0 AS BIGINT) AS CC2, CAST(0 AS BIGINT) AS MerchantAccountId,
               CAST(0 AS BIGINT) AS PaymentGatewayId, 'USE_DEFAULT' AS PaymentSubType,
               CAST(NULL AS VARCHAR) AS PayPalRefTxnId, s.AmountDue
        FROM {{src_payplan}} AS s JOIN {{rel_payplan}} AS r ON s.Id = r.old_id
        JOIN {{rel_invoice}} AS i ON s.InvoiceId = i.old_id
        LEFT JOIN {{rel_card}} AS k ON s.CC1 = k.old_id
        WHERE s.Id IN (SELECT Id FROM {{kept_payplan}})""",
)
def payplans(w: Work) -> DataFrame:
    return w.orders("contact", "user", "product", "card").rows("payplan")


@query(
    "q30_invoice_items",
    f"""SELECT r.new_id AS Id, i.new_id AS InvoiceId, j.new_id AS JobId, c.new_id AS ContactId,
               {_ident('s.UserCreate', 'u', 0, -1)} AS UserCreate, o.new_id AS OrderItemId,
               CAST(NULL AS VARCHAR) AS ChargeIds, CAST(NULL AS VARCHAR) AS InvoiceGroup, s.Qty, s.Lines
        FROM {{src_invoice_item}} AS s JOIN {{rel_invoice_item}} AS r ON s.Id = r.old_id
        JOIN {{rel_contact}} AS c ON s.ContactId = c.old_id
        JOIN {{rel_invoice}} AS i ON s.InvoiceId = i.old_id
        JOIN {{rel_job}} AS j ON s.JobId = j.old_id
        LEFT JOIN {{rel_user}} AS u ON s.UserCreate = u.old_id
        LEFT JOIN {{rel_order_item}} AS o ON s.OrderItemId = o.old_id
        WHERE s.InvoiceId IN (SELECT Id FROM {{kept_invoice}}) AND s.JobId IN (SELECT Id FROM {{kept_job}})""",
)
def invoice_items(w: Work) -> DataFrame:
    return w.orders("contact", "user").rows("invoice_item")


@query(
    "q30_order_items",
    f"""SELECT r.new_id AS Id, j.new_id AS OrderId, p.new_id AS ProductId,
               {_ident('s.InvoiceItemId', 'i', 0)} AS InvoiceItemId, pl.new_id AS SubscriptionPlanId,
               {_ident('s.SourceOrderItemId', 'o', 0)} AS SourceOrderItemId,
               CAST(0 AS BIGINT) AS DiscountedOrderItemId, s.Qty
        FROM {{src_order_item}} AS s JOIN {{rel_order_item}} AS r ON s.Id = r.old_id
        JOIN {{rel_job}} AS j ON s.OrderId = j.old_id
        LEFT JOIN {{rel_product}} AS p ON s.ProductId = p.old_id
        LEFT JOIN {{rel_invoice_item}} AS i ON s.InvoiceItemId = i.old_id
        LEFT JOIN {{rel_plan}} AS pl ON s.SubscriptionPlanId = pl.old_id
        LEFT JOIN {{rel_order_item}} AS o ON s.SourceOrderItemId = o.old_id
        WHERE s.OrderId IN (SELECT Id FROM {{kept_job}})""",
)
def order_items(w: Work) -> DataFrame:
    return w.orders("contact", "user", "product", "plan").rows("order_item")


@query(
    "q30_payments",
    f"""SELECT r.new_id AS Id, {_ident('s.ContactId', 'c', 0)} AS ContactId, i.new_id AS InvoiceId,
               {_ident('s.UserId', 'u', 0, -1)} AS UserId, {_ident('s.RefundId', 'p', 0)} AS RefundId,
               CAST(0 AS BIGINT) AS ChargeId, CAST(NULL AS BIGINT) AS TransactionId,
               'MANUAL' AS CollectionMethod, 'MANUAL' AS PaymentSubType,
               CAST(0 AS BIGINT) AS PaymentGatewayId, s.Amount
        FROM {{src_payment}} AS s JOIN {{rel_payment}} AS r ON s.Id = r.old_id {_CONTACT}
        JOIN {{rel_invoice}} AS i ON s.InvoiceId = i.old_id
        LEFT JOIN {{rel_user}} AS u ON s.UserId = u.old_id
        LEFT JOIN {{rel_payment}} AS p ON s.RefundId = p.old_id
        WHERE s.Id IN (SELECT Id FROM {{kept_payment}})""",
)
def payments(w: Work) -> DataFrame:
    return w.orders("contact", "user", "product").rows("payment")


@query(
    "q30_invoice_payments",
    f"""SELECT r.new_id AS Id, i.new_id AS InvoiceId, p.new_id AS PaymentId,
               {_ident('s.RefundInvoicePaymentId', 'o', 0)} AS RefundInvoicePaymentId, s.Amount
        FROM {{src_invoice_payment}} AS s JOIN {{rel_invoice_payment}} AS r ON s.Id = r.old_id
        JOIN {{rel_invoice}} AS i ON s.InvoiceId = i.old_id
        JOIN {{rel_payment}} AS p ON s.PaymentId = p.old_id
        LEFT JOIN {{rel_invoice_payment}} AS o ON s.RefundInvoicePaymentId = o.old_id
        WHERE s.InvoiceId IN (SELECT Id FROM {{kept_invoice}}) AND s.PaymentId IN (SELECT Id FROM {{kept_payment}})""",
)
def invoice_payments(w: Work) -> DataFrame:
    return w.orders("contact", "user", "product").rows("invoice_payment")


@query(
    "q30_payplan_items",
    """SELECT r.new_id AS Id, p.new_id AS PayPlanId, s.DateDue
       FROM {src_payplan_item} AS s JOIN {rel_payplan_item} AS r ON s.Id = r.old_id
       JOIN {rel_payplan} AS p ON s.PayPlanId = p.old_id
       WHERE s.PayPlanId IN (SELECT Id FROM {kept_payplan})""",
)
def payplan_items(w: Work) -> DataFrame:
    return w.orders("contact", "user", "product", "card").rows("payplan_item")


@query(
    "q30_addresses",
    f"""SELECT r.new_id AS Id, {_ident('s.ContactId', 'c', 0)} AS ContactId, s.Street
        FROM {{src_address}} AS s JOIN {{rel_address}} AS r ON s.Id = r.old_id {_CONTACT}""",
)
def addresses(w: Work) -> DataFrame:
    return w.orders("contact").rows("address")


# Products, opportunities, subscriptions.


@query(
    "q31_subscription_plans",
    """SELECT r.new_id AS Id, ProductId, Cycle, Frequency, NumberOfCycles, PlanPrice
       FROM {exp_src_plan} AS s JOIN {rel_plan} AS r ON s.Id = r.old_id WHERE r.created""",
)
def plans(w: Work) -> DataFrame:
    return sales.products(w.source, w.target).rows["SubscriptionPlan"]


@query(
    "q31_product_categories",
    """SELECT r.new_id AS Id, s.CategoryDisplayName,
              CASE WHEN s.ParentId IS NULL THEN 0 ELSE p.new_id END AS ParentId
       FROM {src_product_category} AS s JOIN {rel_product_category} AS r ON s.Id = r.old_id
       LEFT JOIN {rel_product_category} AS p ON s.ParentId = p.old_id WHERE r.created""",
)
def categories(w: Work) -> DataFrame:
    return sales.product_categories(w.source, w.target).rows["ProductCategory"]


@query(
    "q32_opportunities",
    f"""SELECT r.new_id AS Id, {_ident('s.ContactID', 'c', 0)} AS ContactID,
               coalesce(g.new_id, (SELECT min(Id) FROM {{dst_stage}})) AS StageID,
               {_ident('s.UserID', 'u', 0, -1)} AS UserID, s.CreatedBy, s.LastUpdatedBy,
               CAST(0 AS BIGINT) AS AffiliateId, CAST(0 AS BIGINT) AS PayPlanId, s.Amount, s.DateCreated
        FROM {{src_opportunity}} AS s JOIN {{rel_opportunity}} AS r ON s.Id = r.old_id
        LEFT JOIN {{rel_contact}} AS c ON s.ContactID = c.old_id
        LEFT JOIN {{rel_stage}} AS g ON s.StageID = g.old_id
        LEFT JOIN {{rel_user}} AS u ON s.UserID = u.old_id""",
)
def opportunities(w: Work) -> DataFrame:
    return sales.opportunities(w.source, w.target, w.rels("contact", "user")).rows["Opportunity"]


@query(
    "q32_stage_settings",
    """SELECT d.Name, coalesce(CAST(g.new_id AS VARCHAR), d.Value) AS Value
       FROM {dst_setting} AS d
       LEFT JOIN {src_setting} AS s ON d.Name = s.Name AND s.Name IN ('stagewin', 'stageloss')
       LEFT JOIN {rel_stage} AS g ON g.old_id = TRY_CAST(s.Value AS BIGINT)""",
)
def stage_settings(w: Work) -> DataFrame:
    rel = sales.stages(w.source, w.target).rels["stage"]
    updates = sales.stage_setting_updates(w.source, w.target, rel)
    return set_values(w["dst_setting"], updates)


@query(
    "q32_product_interests",
    f"""SELECT r.new_id AS Id, s.ObjType, o.new_id AS ObjectId, p.new_id AS ProductId,
               pl.new_id AS SubscriptionPlanId, CAST(NULL AS BIGINT) AS LegacyProductId
        FROM {{src_interest}} AS s
        JOIN ({_numbered('src_interest', 'dst_interest', 50, "WHERE ObjType = 'Opportunity'")}) AS r
          ON s.Id = r.old_id
        LEFT JOIN {{rel_opportunity}} AS o ON s.ObjectId = o.old_id
        LEFT JOIN {{rel_product}} AS p ON s.ProductId = p.old_id
        LEFT JOIN {{rel_plan}} AS pl ON s.SubscriptionPlanId = pl.old_id""",
)
def interests(w: Work) -> DataFrame:
    rels = w.rels("contact", "user", "product", "plan")
    rels["opportunity"] = sales.opportunities(w.source, w.target, rels).rels["opportunity"]
    return sales.product_interests(w.source, w.target, rels).rows


@query(
    "q33_subscriptions",
    f"""SELECT r.new_id AS Id, {_ident('s.ContactId', 'c', 0)} AS ContactId,
               {_ident('s.CC1', 'k', 0)} AS CC1, CAST(0 AS BIGINT) AS CC2,
               CAST(0 AS BIGINT) AS MerchantAccountId, CAST(0 AS BIGINT) AS AffiliateId,
               CAST(0 AS BIGINT) AS LeadAffiliateId, pl.new_id AS SubscriptionPlanId, p.new_id AS ProductId,
               CAST(0 AS BIGINT) AS ShippingOptionId, CAST(0 AS BIGINT) AS PaymentGatewayId,
               'USE_DEFAULT' AS PaymentSubType, s.StartDate
        FROM {{src_subscription}} AS s JOIN {{rel_subscription}} AS r ON s.Id = r.old_id {_CONTACT}
        LEFT JOIN {{rel_card}} AS k ON s.CC1 = k.old_id
        LEFT JOIN {{rel_product}} AS p ON s.ProductId = p.old_id
        LEFT JOIN {{rel_plan}} AS pl ON s.SubscriptionPlanId = pl.old_id""",
)
def subscriptions(w: Work) -> DataFrame:
    rels = w.rels("contact", "card", "product", "plan")
    return sales.subscriptions(w.source, w.target, rels).rows


@query(
    "q34_order_subscription_bridge",
    """SELECT r.new_id AS Id, j.new_id AS JobId, u.new_id AS JobRecurringId, s.Qty
       FROM {src_order_subscription} AS s JOIN {rel_order_subscription} AS r ON s.Id = r.old_id
       JOIN {rel_job} AS j ON s.JobId = j.old_id
       JOIN {rel_subscription} AS u ON s.JobRecurringId = u.old_id""",
)
def bridge(w: Work) -> DataFrame:
    rels = w.rels("contact", "card", "product", "plan")
    rels["subscription"] = sales.subscriptions(w.source, w.target, rels).relationship
    rels["job"] = w.orders("contact").relationship("job")
    return sales.order_subscriptions(w.source, w.target, rels).rows


@query(
    "q35_cards",
    f"""SELECT r.new_id AS Id, {_ident('s.ContactId', 'c', 0)} AS ContactId, s.CardType
        FROM {{staged_card}} AS s JOIN {{rel_card}} AS r ON s.Id = r.old_id {_CONTACT}
        WHERE s.ContactId = 0 OR c.new_id IS NOT NULL""",
)
def cards(w: Work) -> DataFrame:
    return people.credit_cards(w["staged_card"], w.target.next_id("CreditCard"), w.contact).rows


@query(
    "q36_actions",
    f"""WITH moved AS (
            SELECT s.*, {_ident('s.ContactId', 'c', 0)} AS NewContact
            FROM {{src_action}} AS s {_CONTACT})
        SELECT (SELECT max(Id) + 1 FROM {{dst_action}}) + 100 + 2 * (row_number() OVER (ORDER BY m.Id) - 1) AS Id,
               m.NewContact AS ContactId, {_ident('m.UserID', 'u1', 0, -1)} AS UserID, m.CreatedBy,
               {_ident('m.LastUpdatedBy', 'u2', 0, -1)} AS LastUpdatedBy,
               CAST(0 AS BIGINT) AS OpportunityId, CAST(0 AS BIGINT) AS TemplateId,
               CAST(0 AS BIGINT) AS FunnelId, CAST(0 AS BIGINT) AS JGraphId,
               m.ActionType, m.Notes, m.ActionDate
        FROM moved AS m LEFT JOIN {{rel_user}} AS u1 ON m.UserID = u1.old_id
        LEFT JOIN {{rel_user}} AS u2 ON m.LastUpdatedBy = u2.old_id
        WHERE m.NewContact IS NOT NULL""",
)
def actions(w: Work) -> DataFrame:
    return people.contact_actions(w.source, w.target, w.contact, w.user).rows


# Custom fields and settings.


@query(
    "q37_custom_fields",
    """SELECT Id, MarketSegment, Balance, Nation, Code9,
              CAST(NULL AS DOUBLE) AS Balance0, CAST(NULL AS BIGINT) AS Code10 FROM {dst_custom}
       UNION ALL
       SELECT r.new_id, Segment, NULL, CAST(CAST(Nation AS BIGINT) AS VARCHAR), NULL, Balance, Code9
       FROM {src_custom} AS s JOIN {rel_contact} AS r ON s.Id = r.old_id""",
)
def custom_values(w: Work) -> DataFrame:
    values = custom_fields(w.source, w.target, w.contact).rows["Custom_Contact"]
    return append_rows(w["dst_custom"], values)


@query(
    "q37_new_fields",
    """SELECT r.new_id AS Id, s.FormId, h.new_id AS GroupId, s.DisplayName, s.DataType,
              CASE s.FieldName WHEN 'Balance' THEN 'Balance0' WHEN 'Code9' THEN 'Code10' ELSE s.FieldName END AS FieldName
       FROM {src_form_field} AS s JOIN {rel_field} AS r ON s.Id = r.old_id
       LEFT JOIN {rel_header} AS h ON s.GroupId = h.old_id WHERE r.created""",
)
def new_fields(w: Work) -> DataFrame:
    forms = tabs_and_headers(w.source, w.target)
    return field_rows(match_fields(w.source, w.target), forms.rels["header"])


@query(
    "q37_drilldown_options",
    """WITH settled AS (
           SELECT s.Id, s.CategoryId, CAST(f.new_id AS VARCHAR) AS FieldId, s.Label
           FROM {src_option} AS s JOIN {rel_field} AS f ON CAST(CAST(s.FieldId AS DOUBLE) AS BIGINT) = f.old_id),
       present AS (
           SELECT s.Id AS old_id, max(d.Id) AS new_id FROM settled AS s JOIN {dst_option} AS d
             ON s.FieldId = d.FieldId AND s.Label = d.Label GROUP BY s.Id),
       given AS (
           SELECT Id AS old_id, (SELECT max(Id) + 1 FROM {dst_option}) + 50
                  + 2 * (row_number() OVER (ORDER BY Id) - 1) AS new_id FROM {src_option})
       SELECT g.new_id AS Id,
              CASE WHEN s.CategoryId IN (0, -1) THEN s.CategoryId ELSE coalesce(p.new_id, q.new_id) END AS CategoryId,
              s.FieldId, s.Label
       FROM settled AS s JOIN given AS g ON s.Id = g.old_id
       LEFT JOIN present AS p ON s.CategoryId = p.old_id LEFT JOIN given AS q ON s.CategoryId = q.old_id
       WHERE s.Id NOT IN (SELECT old_id FROM present)""",
)
def options(w: Work) -> DataFrame:
    rel = match_fields(w.source, w.target).made.relationship
    return drilldown_options(w.source, w.target, rel).rows["DrilldownOption"]


@query(
    "q38_disable_settings",
    """SELECT Name, CASE WHEN Name IN ('runPurchaseActionsOnManualOrders', 'emailinvoiceflag', 'invoicepayments')
                          AND Value = '1' THEN '0' ELSE Value END AS Value FROM {dst_setting}""",
)
def disabled(w: Work) -> DataFrame:
    return switches.receipts_disabled(w.target)


@query(
    "q39_dropdown_merge",
    f"""SELECT d.Name, CASE WHEN d.Name IN ({', '.join(f"'{n}'" for n in DROPDOWN_SETTINGS)})
               THEN array_to_string(list_concat(string_split(d.Value, ','),
                    [x FOR x IN string_split(s.Value, ',') IF NOT list_contains(string_split(d.Value, ','), x)]), ',')
               ELSE d.Value END AS Value
        FROM {{dst_setting}} AS d LEFT JOIN {{src_setting}} AS s ON d.Name = s.Name""",
)
def dropdowns(w: Work) -> DataFrame:
    return switches.dropdowns_merged(w.source, w.target)


# Report, export, groups.


_MOVED_TO = "CASE WHEN s.CompanyID = 0 THEN 0 ELSE c.new_id END"
_CONTACTS_MOVED = f"""SELECT count(*) FROM {{rel_contact}} AS r JOIN {{src_contact}} AS s ON s.Id = r.old_id
                   LEFT JOIN {{rel_contact}} AS c ON c.old_id = s.CompanyID WHERE r.new_id %s {_MOVED_TO}"""
_APPLIED = f"""SELECT (SELECT count(*) FROM {{rel_contact}}) + count(*) FROM (
                   SELECT DISTINCT NewContact, NewTag FROM (
                       SELECT {_ident('s.ContactId', 'c', 0)} AS NewContact, t.new_id AS NewTag
                       FROM {{src_tag_application}} AS s {_CONTACT} LEFT JOIN {{rel_tag}} AS t ON s.GroupId = t.old_id) AS m
                   WHERE NewContact IS NOT NULL AND NOT EXISTS (
                       SELECT 1 FROM {{dst_tag_application}} AS d WHERE d.ContactId = m.NewContact AND d.GroupId = m.NewTag))"""
#: What the report tells of: the target's rows before, and how many come.
_REPORTED = {
    "Contacts": ("{dst_contact} WHERE IsUser = 0 AND Id <> CompanyID", _CONTACTS_MOVED % "<>"),
    "Companies": ("{dst_contact} WHERE Id = CompanyID", _CONTACTS_MOVED % "="),
    "Tags": ("{dst_tag}", "SELECT count(*) + 1 FROM {rel_tag} WHERE created"),
    "Lead Sources": ("{dst_lead_source}", "SELECT count(*) FROM {rel_lead_source} WHERE created"),
    "Tag Applications": ("{dst_tag_application}", _APPLIED),
    "Products": ("{dst_product}", "SELECT count(*) FROM {rel_product} WHERE created"),
    "Custom Fields": ("{dst_form_field}", "SELECT count(*) FROM {rel_field} WHERE created"),
    "Contact Actions": ("{dst_action}", f"SELECT count(*) FROM ({ORACLES['q36_actions']})"),
    "Opportunities": ("{dst_opportunity}", "SELECT count(*) FROM {rel_opportunity}"),
    "Credit Cards": ("{dst_card}", f"SELECT count(*) FROM ({ORACLES['q35_cards']})"),
    "Subscriptions": ("{dst_subscription}", "SELECT count(*) FROM {rel_subscription}"),
    "Orders": ("{dst_job}", "SELECT count(*) FROM {kept_job}"),
}


@query(
    "q40_transfer_report",
    "SELECT object, before, before + transferred AS after, transferred FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS object, (SELECT count(*) FROM {before}) AS before, ({moved}) AS transferred"
        for name, (before, moved) in _REPORTED.items()
    )
    + ")",
)
def report(w: Work) -> DataFrame:
    """The report of a whole run over all objects: what moves was counted while it was written."""
    return Transfer(w.spark, w.source, w.target, Selection(), Staging(w.spark), RUN_TIME).run().report()


@query(
    "q41_relationship_roundtrip",
    "SELECT old_id, new_id FROM {rel_contact} UNION ALL SELECT 0, 0",
)
def roundtrip(w: Work) -> DataFrame:
    return pairs_from_json(pairs_to_json(w.contact.complete()))


@query(
    "q42_group_to_list",
    """SELECT ContactId, string_agg(GroupId, ',' ORDER BY GroupId) AS GroupIds
       FROM (SELECT DISTINCT ContactId, GroupId FROM {src_tag_application} WHERE ContactId IS NOT NULL)
       GROUP BY ContactId""",
)
def group_lists(w: Work) -> DataFrame:
    lists = grouped_list(w["src_tag_application"], "ContactId", "GroupId", "GroupIds")
    return lists.withColumn("GroupIds", F.array_join(F.col("GroupIds").cast("array<string>"), ","))


@query(
    "q43_categories_in_use",
    """SELECT Id, CategoryName FROM {src_tag_category}
       WHERE Id IN (SELECT GroupCategoryId FROM {src_tag} WHERE GroupName IN ('click', 'view', 'signup'))""",
)
def used_categories(w: Work) -> DataFrame:
    chosen = w["src_tag"].where(F.col("GroupName").isin("click", "view", "signup"))
    used = in_use(chosen, "GroupCategoryId", "category")
    return keep_children(w["src_tag_category"], "Id", used, "category")


@query(
    "q44_fill_unmatched",
    """SELECT old_id, CASE WHEN new_id IS NULL
                  THEN 500 + 2 * (row_number() OVER (PARTITION BY new_id IS NULL ORDER BY old_id) - 1)
                  ELSE new_id END AS new_id, new_id IS NULL AS created
       FROM (SELECT Id AS old_id, CASE WHEN LineNumber > 3 THEN ProductId END AS new_id FROM {line_base})""",
)
def fill_unmatched(w: Work) -> DataFrame:
    matches = w["line_base"].select(
        F.col("Id").alias("old_id"),
        F.when(F.col("LineNumber") > 3, F.col("ProductId")).alias("new_id"),
    )
    return fill_new_ids(matches, 500)


# Publishing and what is read.


@query(
    "q45_publish_rows",
    f"""SELECT Id, MarketSegment, CAST(NULL AS DOUBLE) AS Balance, Code9, Nickname FROM ({_NEW_VALUES})
        WHERE Id NOT IN (SELECT Id FROM {{dst_custom}})""",
)
def rows_to_publish(w: Work) -> DataFrame:
    """What an append adds: rows the target holds already as a whole are left out, new columns stay."""
    rows = w.inputs.sql(
        "SELECT 9000000000 + Id AS Id, Segment AS MarketSegment, Code9, NoField AS Nickname FROM {src_custom} WHERE Code9 IS NULL OR Code9 >= 12"
    )
    have = w["dst_custom"].select("Id", "MarketSegment", "Code9").withColumn("Nickname", F.lit(None).cast("string"))
    published = fresh_rows(rows.unionByName(have), w["dst_custom"])
    return published.withColumn("Balance", F.lit(None).cast("double"))


@query(
    "q46_settings_applied",
    f"""SELECT d.Name, CASE WHEN d.Name IN ({', '.join(f"'{n}'" for n in DROPDOWN_SETTINGS)})
               THEN array_to_string(list_concat(string_split(d.Value, ','),
                    [x FOR x IN string_split(s.Value, ',') IF NOT list_contains(string_split(d.Value, ','), x)]), ',')
               WHEN d.Name IN ('runPurchaseActionsOnManualOrders', 'emailinvoiceflag', 'invoicepayments') AND d.Value = '1' THEN '0'
               WHEN d.Name = 'untouched' THEN 'changed meanwhile' ELSE d.Value END AS Value
        FROM {{dst_setting}} AS d LEFT JOIN {{src_setting}} AS s ON d.Name = s.Name""",
)
def settings_applied(w: Work) -> DataFrame:
    """Updates put into the table as it is when they are published."""
    updates = switches.dropdown_updates(w.source, w.target).unionByName(switches.receipt_updates(w.target))
    changed = F.when(F.col("Name") == "untouched", "changed meanwhile").otherwise(F.col("Value"))
    return with_updates(w["dst_setting"].withColumn("Value", changed), updates, "Name")


@query(
    "q47_bad_list_tokens",
    """SELECT token, count(*) AS lists FROM (
           SELECT unnest(string_split(ProductSold || CASE WHEN OrderId % 3 = 0 THEN ',x' || CAST(OrderId % 2 AS VARCHAR) ELSE ',7 ' END, ',')) AS token
           FROM {product_sold}) WHERE TRY_CAST(trim(token) AS BIGINT) IS NULL GROUP BY token""",
)
def bad_tokens(w: Work) -> DataFrame:
    marked = F.when(F.col("OrderId") % 3 == 0, F.concat(F.lit(",x"), (F.col("OrderId") % 2).cast("string"))).otherwise(F.lit(",7 "))
    rows = w["product_sold"].select(F.col("OrderId").alias("Id"), F.concat("ProductSold", marked).alias("ProductSold"))
    return bad_list_tokens(rows, "ProductSold").groupBy("token").agg(F.count("*").alias("lists"))


# Through files and tables of a catalog.


@query(
    "q48_ledger_update",
    f"""SELECT coalesce(n.Id, d.Id) AS Id, CASE WHEN n.Id IS NULL THEN d.MarketSegment ELSE n.MarketSegment END AS MarketSegment,
               d.Balance, d.Nation, CASE WHEN n.Id IS NULL THEN d.Code9 ELSE n.Code9 END AS Code9, n.Nickname
        FROM {{dst_custom}} AS d FULL JOIN (SELECT Id, MarketSegment, Code9, Nickname FROM ({_NEW_VALUES})) AS n ON d.Id = n.Id""",
)
def ledger_update(w: Work) -> DataFrame:
    """Published to files in two steps; the second rewrites only ranges of ids that it touches."""
    rows = w.inputs.sql(
        "SELECT CASE WHEN Code9 < 12 THEN 100000 + 3 * Id ELSE 9000000000 + Id END AS Id, "
        "Segment AS MarketSegment, Code9, NoField AS Nickname FROM {src_custom}"
    )
    book = Book(w.spark, Staging(w.spark).path("ledger"))
    first = book.begin()
    first.replace("Custom_Contact", w["dst_custom"])
    first.update("Custom_Contact", rows.where("Code9 < 12"), "Id")
    first.commit()
    second = book.begin()
    second.update("Custom_Contact", rows.where("NOT coalesce(Code9 < 12, FALSE)"), "Id")
    second.commit()
    return Book(w.spark, book.root).read("Custom_Contact")


@query(
    "q49_catalog_append",
    f"""SELECT Id, Name, LeadSourceCategoryId, CAST(NULL AS VARCHAR) AS Origin FROM {{dst_lead_source}}
        UNION ALL SELECT r.new_id, s.Name, {_ident('s.LeadSourceCategoryId', 'c', 0)}, 'src'
        FROM {{src_lead_source}} AS s JOIN {{rel_lead_source}} AS r ON s.Id = r.old_id
        LEFT JOIN {{rel_lead_source_category}} AS c ON s.LeadSourceCategoryId = c.old_id WHERE r.created""",
)
def catalog_append(w: Work) -> DataFrame:
    """Into a table of the session's catalog, twice, with a column that it lacks."""
    staging = Staging(w.spark)
    database = f"regraft_{staging.root.rsplit('/', 1)[-1]}"
    w.spark.sql(f"CREATE DATABASE {database} LOCATION '{staging.path('database')}'")
    w["dst_lead_source"].write.saveAsTable(f"{database}.LeadSource")
    made = people.lead_sources(w.source, w.target).rows["LeadSource"].withColumn("Origin", F.lit("src"))
    for _ in range(2):
        append_table(made, f"{database}.LeadSource")
    return App.catalog(w.spark, "dst", database).table("LeadSource")


@query("q50_relationship_import", "SELECT old_id, new_id FROM {rel_product}")
def relationship_import(w: Work) -> DataFrame:
    """Written by one run, read and checked by the next."""
    folder = Staging(w.spark).path("relationships")
    products = match_or_create(w["src_product"], w["dst_product"], ["ProductName"], w.target.next_id("Product"))
    write_json(Relationship(products.relationship.pairs, (0,)), f"{folder}/product.json")
    target = append_rows(w["dst_product"], products.rows)
    return checked_pairs("product", read_relationships(w.spark, folder)["product"], target, (0,))


@query("q51_relationship_csv", "SELECT old_id AS OldId, new_id AS NewId FROM {rel_contact} UNION ALL SELECT 0, 0")
def relationship_csv(w: Work) -> DataFrame:
    folder = Staging(w.spark).path("csv")
    write_csv(w.contact, folder)
    return csv_rows(read_csv(w.spark, folder))


@query("q52_override_from_snapshot", ORACLES["q36_actions"])
def override_from_snapshot(w: Work) -> DataFrame:
    """Prepared actions as a CSV for review, which then takes their place."""
    prepared = people.contact_actions(w.source, w.target, w.contact, w.user).rows
    path = Staging(w.spark).path("actions")
    snapshot(prepared, path, "csv")
    return overridden(prepared, path)


@query(
    "q53_marker_tag",
    """SELECT (SELECT max(new_id) + 1 FROM {rel_tag}) + 10 AS Id, 'Data Transferred - src > dst' AS GroupName,
              0 AS GroupCategoryId, '' AS GroupDescription, 0 AS ImportId""",
)
def marker_tag(w: Work) -> DataFrame:
    made = people.contacts(w.source, w.target, with_companies=False, run_time=RUN_TIME)
    return made.rows["ContactGroup"].where("GroupName LIKE 'Data Transferred%'")


@query("q54_clustered_relationships", ORACLES["q30_order_items"])
def clustered_relationships(w: Work) -> DataFrame:
    """Order items by relationships in buckets, which lie still in every join."""
    w.staged(int(w.spark.conf.get("spark.sql.shuffle.partitions")))
    family = w.orders("contact", "user", "product", "plan")
    family.number("job", "order_item")
    return family.rows("order_item")
