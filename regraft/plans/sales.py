"""Products, opportunities, subscriptions and the orders family."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regraft.functions.columns import as_id, filled
from regraft.operators.ids import allocate_ids
from regraft.operators.match import Keep, buckets_of, lazily, match_or_create
from regraft.operators.relationship import Relationship
from regraft.operators.remap import remap, remap_or_default
from regraft.plans.crm import (
    CATEGORY_OFFSET,
    DEFAULT_STAGE_SETTING,
    JOB_RECURRING,
    JOB_TO_JOB_RECURRING,
    OPPORTUNITY,
    ORDER_TABLES,
    PAY_PLAN,
    PLAN_KEYS,
    PRODUCT_INTEREST,
    STAGE_OFFSET,
    STAGE_SETTINGS,
)
from regraft.plans.spec import (
    Moved,
    Outcome,
    Relationships,
    TableSpec,
    assemble,
    give_ids,
    members,
    move,
    settle,
)
from regraft.sources.app import App
from regraft.sources.staging import at_once


def _plan_keys_filled(plans: DataFrame) -> DataFrame:
    """Plan keys without nulls and in one type each, so that both sides compare."""
    kinds = {"PlanPrice": "double"}
    return plans.withColumns(
        {k: filled(F.col(k).cast(kinds.get(k, "bigint")), 0) for k in PLAN_KEYS}
    )


def products(source: App, target: App, keep: Keep = lazily) -> Outcome:
    """Products by name, their plans by terms, and product categories."""

    def with_plans() -> Outcome:
        made = match_or_create(
            source.table("Product"),
            target.table("Product"),
            ["ProductName"],
            target.next_id("Product"),
            name="Product_ids",
            keep=keep,
        )
        outcome = Outcome(rows={"Product": made.rows}, rels={"product": made.relationship})
        return outcome.and_then(subscription_plans(source, target, made.relationship, keep))

    plans, categories = at_once([with_plans, partial(product_categories, source, target, keep)])
    return plans.and_then(categories)


def subscription_plans(
    source: App, target: App, product_rel: Relationship, keep: Keep = lazily
) -> Outcome:
    rows = remap(source.table("SubscriptionPlan"), {"ProductId": product_rel}, required=True)
    rows = _plan_keys_filled(rows)
    made = match_or_create(
        rows,
        _plan_keys_filled(target.table("SubscriptionPlan")),
        PLAN_KEYS,
        target.next_id("SubscriptionPlan"),
        name="SubscriptionPlan_ids",
        keep=keep,
    )
    return Outcome(rows={"SubscriptionPlan": made.rows}, rels={"plan": made.relationship})


def product_categories(source: App, target: App, keep: Keep = lazily) -> Outcome:
    """Categories by display name; parents follow their new ids."""
    made = match_or_create(
        source.table("ProductCategory"),
        target.table("ProductCategory"),
        ["CategoryDisplayName"],
        target.next_id("ProductCategory") + CATEGORY_OFFSET,
        name="ProductCategory_ids",
        keep=keep,
    )
    rel = made.relationship.with_identities(0)
    rows = made.rows.withColumn("ParentId", filled(F.col("ParentId").cast("bigint"), 0))
    return Outcome(
        rows={"ProductCategory": remap(rows, {"ParentId": rel})}, rels={"product_category": rel}
    )


def stages(source: App, target: App, keep: Keep = lazily) -> Outcome:
    rows = source.table("Stage")
    made = match_or_create(
        rows,
        target.table("Stage"),
        ["StageName"],
        target.next_id("Stage") + STAGE_OFFSET,
        rows=rows.withColumn("StageOrder", F.lit(0)),
        name="Stage_ids",
        keep=keep,
    )
    return Outcome(rows={"Stage": made.rows}, rels={"stage": made.relationship})


def stage_setting_updates(source: App, target: App, stage_rel: Relationship) -> DataFrame:
    """``(Name, Value)``: the source's won and lost stages under their new ids."""
    default = as_id(target.setting(DEFAULT_STAGE_SETTING))
    chosen = (
        source.table("AppSetting", ["Name", "Value"])
        .where(F.col("Name").isin(*STAGE_SETTINGS) & (F.col("Value") != ""))
        .withColumn("Value", as_id("Value"))
    )
    moved = remap_or_default(chosen, "Value", stage_rel, default, row_id="Value")
    return moved.withColumn("Value", F.col("Value").cast("string"))


def opportunities(
    source: App, target: App, rels: Relationships, keep: Keep = lazily
) -> Outcome:
    """Opportunities of transferred contacts; stages that are gone get the default."""
    rows, next_id = source.table("Opportunity"), target.next_id("Opportunity")
    made_stages, numbered = at_once(
        [
            partial(stages, source, target, keep),
            partial(give_ids, OPPORTUNITY, rows, next_id, rels, keep),
        ]
    )
    default = as_id(target.setting(DEFAULT_STAGE_SETTING))
    moved = settle(OPPORTUNITY, rows, numbered, {**rels, **made_stages.rels}, keep, {"StageID": default})
    return made_stages.and_then(
        Outcome(rows={"Opportunity": moved.rows}, rels={"opportunity": moved.relationship})
    )


def product_interests(
    source: App, target: App, rels: Relationships, keep: Keep = lazily
) -> Moved:
    """Interests that point at opportunities."""
    rows = source.table("ProductInterest").where(F.col("ObjType") == "Opportunity")
    return move(PRODUCT_INTEREST, rows, target.next_id("ProductInterest"), rels, keep)


def subscriptions(source: App, target: App, rels: Relationships, keep: Keep = lazily) -> Moved:
    return move(
        JOB_RECURRING, source.table("JobRecurring"), target.next_id("JobRecurring"), rels, keep
    )


def order_subscriptions(
    source: App, target: App, rels: Relationships, keep: Keep = lazily
) -> Moved:
    """The bridge between orders and subscriptions, where both ends came along."""
    return move(
        JOB_TO_JOB_RECURRING,
        source.table("JobToJobRecurring"),
        target.next_id("JobToJobRecurring"),
        rels,
        keep,
    )


@dataclass
class Orders:
    """The nine order tables. Each is settled when it is first asked for.

    Every table is numbered in full before any row is dropped, so tables that
    refer to each other can be settled in any order. Which rows stay is decided
    on old ids: a child follows the parents that were kept. What several tables
    ask for goes through ``keep``; the rest is used once and stays a plan. Without
    ``whole`` only members are asked for. A table that is only looked up in is numbered
    by its ids alone.
    """

    source: App
    target: App
    rels: dict[str, Relationship]
    keep: Keep = lazily
    whole: bool = True

    # Whose kept rows a child asks for, by the name it uses.
    KEPT = {
        "kept_job": "job",
        "kept_invoice": "invoice",
        "kept_payplan": "payplan",
        "kept_payment": "payment",
    }
    # Tables whose full numbering only they use.
    OWN_NUMBERS = ("job", "payplan_item")

    def __post_init__(self) -> None:
        self._numbered: dict[str, DataFrame] = {}
        self._members: dict[str, DataFrame] = {}
        self._pairs: dict[str, DataFrame] = {}

    def spec(self, name: str) -> TableSpec:
        spec = ORDER_TABLES[name]
        if spec is PAY_PLAN and "card" not in self.rels:
            spec = replace(spec, lookups={}, constants={**spec.constants, "CC1": 0})
        return spec

    def numbered(self, name: str) -> DataFrame:
        if name not in self._numbered:
            spec = self.spec(name)
            rows, next_id = self.source.table(spec.table), self.target.next_id(spec.table)
            keep = lazily if name in self.OWN_NUMBERS else self.keep
            self._numbered[name] = give_ids(spec, rows, next_id, {}, keep, self.whole)
        return self._numbered[name]

    def pairs(self, name: str) -> DataFrame:
        """Old and new ids of a table, from its keys if they were numbered."""
        if name in self._numbered or name in self.OWN_NUMBERS:
            return self.numbered(name).select("old_id", "new_id")
        if name not in self._pairs:
            spec = self.spec(name)
            rows, next_id = self.source.table(spec.table), self.target.next_id(spec.table)
            self._pairs[name] = self.keep(f"{spec.table}_pairs", allocate_ids(rows, next_id + spec.offset))
        return self._pairs[name]

    def members(self, name: str) -> DataFrame:
        if name not in self._members:
            spec = self.spec(name)
            rels = {n: self.relationship(n) for n in spec.parents.values()}
            keep = self.keep if name in self.KEPT.values() else lazily
            self._members[name] = members(spec, self.numbered(name), rels, keep)
        return self._members[name]

    def relationship(self, name: str) -> Relationship:
        if name in self.rels:
            return self.rels[name]
        if name in self.KEPT:
            return Relationship(self.members(self.KEPT[name]).select("old_id", "new_id"), buckets=buckets_of(self.keep))
        return Relationship(self.pairs(name), ORDER_TABLES[name].identities, buckets_of(self.keep))

    def rows(self, name: str) -> DataFrame:
        spec = self.spec(name)
        rels = {
            n: self.relationship(n) for n in (*spec.lookups.values(), *spec.lists.values())
        }
        return assemble(spec, self.source.table(spec.table), self.members(name), rels)

    def number(self, *names: str) -> Orders:
        """Number some tables, together."""
        at_once([partial(self.numbered, name) for name in names])
        return self

    def stage_all(self) -> None:
        """Run what ``keep`` writes, independent parts together."""
        self.number(*ORDER_TABLES)
        self.members("invoice")
        at_once([partial(self.members, name) for name in self.KEPT.values()])

    def outcome(self) -> Outcome:
        if self.keep is not lazily:
            self.stage_all()
        return Outcome(
            rows={spec.table: self.rows(name) for name, spec in ORDER_TABLES.items()},
            rels={name: self.relationship(name) for name in ORDER_TABLES},
        )


def orders(source: App, target: App, rels: Relationships, keep: Keep = lazily) -> Outcome:
    """Orders with everything under them.

    ``rels`` holds contact, user, product and plan, and card if cards moved.
    """
    return Orders(source, target, dict(rels), keep).outcome()
