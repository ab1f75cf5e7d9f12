"""Contacts and what hangs on them: users, lead sources, tags, actions, cards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regraft.functions.columns import blank_to_null, timestamp_text, transfer_label
from regraft.operators.integrity import first_per_key, in_use, keep_children, without_existing
from regraft.operators.match import (
    Created,
    Keep,
    buckets_of,
    inner_match,
    lazily,
    match_or_create,
    natural_match,
)
from regraft.operators.relationship import Relationship, prefer_later
from regraft.operators.remap import remap
from regraft.plans.crm import (
    CONTACT,
    CONTACT_ACTION,
    CREDIT_CARD,
    MARKER_OFFSET,
    USER_IDENTITIES,
)
from regraft.plans.spec import Moved, Outcome, give_ids, move, set_constants, settle
from regraft.sources.app import App
from regraft.sources.sinks import overridden, snapshot
from regraft.sources.staging import at_once


def user_relationship(source: App, target: App, keep: Keep = lazily) -> Relationship:
    """Users by global id, overridden by email; unmatched users become 0."""
    by_global_id = natural_match(source.table("User"), target.table("User"), ["GlobalUserId"])

    def addresses(app: App) -> DataFrame:
        people = app.table("Contact", ["Id", "Email"]).withColumn("Email", blank_to_null("Email"))
        return keep_children(people.dropna(subset=["Email"]), "Id", app.table("User", ["Id"]))

    by_email = inner_match(addresses(source), addresses(target), ["Email"])
    pairs = prefer_later(by_global_id.fillna(0, subset=["new_id"]), by_email)
    return Relationship(keep("User_ids", pairs), USER_IDENTITIES, buckets_of(keep))


def lead_sources(source: App, target: App, keep: Keep = lazily) -> Outcome:
    def matched(table: str) -> Created:
        return match_or_create(
            source.table(table),
            target.table(table),
            ["Name"],
            target.next_id(table),
            name=f"{table}_ids",
            keep=keep,
        )

    categories, made = at_once(
        [partial(matched, "LeadSourceCategory"), partial(matched, "LeadSource")]
    )
    category_rel = categories.relationship.with_identities(0)
    created = remap(made.rows, {"LeadSourceCategoryId": category_rel})
    return Outcome(
        rows={"LeadSourceCategory": categories.rows, "LeadSource": created},
        rels={"lead_source_category": category_rel, "lead_source": made.relationship},
    )


def tags(source: App, target: App, tag_ids: Sequence[int] = (), keep: Keep = lazily) -> Outcome:
    """All tags, or the given ones with only the categories they use."""
    rows = source.table("ContactGroup")
    categories = source.table("ContactGroupCategory")
    if tag_ids:
        rows = rows.where(F.col("Id").isin(*tag_ids))
        used = in_use(rows, "GroupCategoryId", "category")
        categories = keep_children(categories, "Id", used, "category")

    def matched(table: str, chosen: DataFrame, key: str) -> Created:
        return match_or_create(
            chosen,
            target.table(table),
            [key],
            target.next_id(table),
            name=f"{table}_ids",
            keep=keep,
        )

    made_categories, made = at_once(
        [
            partial(matched, "ContactGroupCategory", categories, "CategoryName"),
            partial(matched, "ContactGroup", rows, "GroupName"),
        ]
    )
    category_rel = made_categories.relationship.with_identities(0)
    created = remap(made.rows, {"GroupCategoryId": category_rel})
    return Outcome(
        rows={"ContactGroupCategory": made_categories.rows, "ContactGroup": created},
        rels={"tag_category": category_rel, "tag": made.relationship},
    )


def transfer_marker(
    source_name: str, target: App, contact_pairs: DataFrame, run_time: datetime
) -> tuple[DataFrame, DataFrame]:
    """The tag that marks this transfer, and its application to every new contact."""
    marker_id = target.next_id("ContactGroup") + MARKER_OFFSET
    tag = contact_pairs.sparkSession.range(1).select(
        marker_id.alias("Id"),
        F.lit(transfer_label(source_name, target.name)).alias("GroupName"),
        F.lit(0).cast("bigint").alias("GroupCategoryId"),
        F.lit("").alias("GroupDescription"),
        F.lit(0).cast("bigint").alias("ImportId"),
    )
    moment = timestamp_text(F.lit(run_time.isoformat(sep=" ")).cast("timestamp"))
    applied = contact_pairs.select(
        F.col("new_id").alias("ContactId"),
        marker_id.alias("GroupId"),
        moment.cast("timestamp").alias("DateCreated"),
    )
    return tag, applied


def people(source: App, only_tag: int | None = None) -> DataFrame:
    """Contacts that are no users, all or only those with a tag."""
    rows = source.table("Contact").where("IsUser = 0")
    if only_tag is None:
        return rows
    tagged = source.table("ContactGroupAssign").where(F.col("GroupId") == only_tag)
    return keep_children(rows, "Id", in_use(tagged, "ContactId", "contact"), "contact")


def contacts(
    source: App,
    target: App,
    *,
    with_tags: bool = True,
    with_lead_sources: bool = True,
    with_companies: bool = True,
    only_tag: int | None = None,
    tag_ids: Sequence[int] = (),
    user_rel: Relationship | None = None,
    run_time: datetime,
    keep: Keep = lazily,
) -> Outcome:
    """Contacts, their tags, lead sources and companies, and the transfer marker."""
    lookups, lists, constants = dict(CONTACT.lookups), {}, {}
    if not with_lead_sources:
        del lookups["LeadSourceId"]
        constants["LeadSourceId"] = 0
    if with_tags:
        lists = CONTACT.lists
    spec = replace(CONTACT, lookups=lookups, lists=lists, constants=constants)
    rows = people(source, only_tag)

    def users() -> Outcome:
        return Outcome(rels={"user": user_rel or user_relationship(source, target, keep)})

    parts = [users]
    if with_lead_sources:
        parts.append(partial(lead_sources, source, target, keep))
    if with_tags:
        parts.append(partial(tags, source, target, tag_ids, keep))
    numbering = partial(give_ids, spec, rows, target.next_id("Contact"), {}, keep)
    numbered, *outcomes = at_once([numbering, *parts])
    outcome = reduce(Outcome.and_then, outcomes)
    contact_rel = Relationship(numbered.select("old_id", "new_id"), spec.identities)
    rels = {**outcome.rels, "contact": contact_rel}
    moved = settle(spec, rows, numbered, rels, keep)
    made = {"Contact": moved.rows}

    if with_companies:
        made["CompanyOwner"] = company_owners(source, contact_rel)
    fresh_tags = outcome.rows.get("ContactGroup")
    seen = target if fresh_tags is None else target.appended(ContactGroup=fresh_tags)
    marker, applied = transfer_marker(source.name, seen, contact_rel.pairs, run_time)
    made["ContactGroupAssign"] = applied
    made["ContactGroup"] = (
        marker
        if fresh_tags is None
        else fresh_tags.unionByName(marker, allowMissingColumns=True)
    )
    return outcome.and_then(Outcome(rows=made, rels={"contact": contact_rel}))


def company_owners(source: App, contact_rel: Relationship) -> DataFrame:
    """Main contacts of companies, where the main contact came along."""
    owners = remap(source.table("CompanyOwner"), {"MainContactId": contact_rel}, required=True)
    return remap(owners, {"Id": contact_rel}, row_id="MainContactId")


def tag_applications(
    source: App,
    target: App,
    contact_rel: Relationship,
    tag_rel: Relationship,
    tag_ids: Sequence[int] = (),
) -> DataFrame:
    """Tag applications of transferred contacts the target does not have yet.

    Repeats are combined before the existence test: a pair that makes up much
    of the table is one row by then.
    """
    rows = source.table("ContactGroupAssign")
    if tag_ids:
        rows = rows.where(F.col("GroupId").isin(*tag_ids))
    spread = "Id" if "Id" in rows.columns else "ContactId"
    rows = remap(rows, {"ContactId": contact_rel}, required=True, row_id=spread)
    rows = remap(rows, {"GroupId": tag_rel}, row_id=spread)
    keys = ["ContactId", "GroupId"]
    rows = first_per_key(rows.drop("Id"), keys, order_by=["DateCreated"])
    return without_existing(rows, target.table("ContactGroupAssign"), keys, repeats=False)


def contact_actions(
    source: App,
    target: App,
    contact_rel: Relationship,
    user_rel: Relationship,
    *,
    override_path: str | None = None,
    snapshot_path: str | None = None,
    keep: Keep = lazily,
) -> Moved:
    """Actions of transferred contacts. A CSV, if named, takes their place.

    A row of the CSV is final but for its id, so it also skips the contact test.
    """
    rels = {"contact": contact_rel, "user": user_rel}
    rows = source.table("ContactAction")
    next_id = target.next_id("ContactAction")
    if override_path is not None:
        plain = replace(CONTACT_ACTION, parents={}, lookups={}, constants={})
        return move(plain, overridden(rows, override_path), next_id, rels, keep)
    if snapshot_path is not None:
        keys = remap(rows, {"ContactId": contact_rel}, required=True)
        people = {c: user_rel for c in CONTACT_ACTION.lookups}
        snapshot(set_constants(remap(keys, people), CONTACT_ACTION.constants), snapshot_path)
    return move(CONTACT_ACTION, rows, next_id, rels, keep)


def credit_cards(
    staged: DataFrame, next_id: Column, contact_rel: Relationship, keep: Keep = lazily
) -> Moved:
    """Cards of transferred contacts, told by the contact's old id."""
    return move(CREDIT_CARD, staged, next_id, {"contact": contact_rel}, keep)
