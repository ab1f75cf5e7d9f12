"""``python -m regraft``: transfer between two folders of Parquet tables or two databases.

A side that begins with ``jdbc:`` is a database; user, password and driver come
from a properties file, ``--source-properties`` and ``--target-properties``. One that
begins with ``catalog:`` is a database of the session's catalog.

Stages go below the run folder; the same command again takes up an unfinished
run. Without ``--publish`` the target is left as it is and only the report is
shown.
"""

from __future__ import annotations

import argparse
from datetime import datetime
from pathlib import Path

from pyspark.sql import SparkSession

from regraft.plans.transfer import Selection, Transfer, stage_report
from regraft.sources.app import App
from regraft.sources.relationships import read_relationships, write_csv, write_json
from regraft.sources.staging import Staging

SKIPPABLE = (
    "tags",
    "lead_sources",
    "companies",
    "products",
    "custom_fields",
    "contact_actions",
    "opportunities",
    "credit_cards",
    "orders",
    "subscriptions",
)


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="regraft", description=__doc__)
    for side in ("source", "target"):
        parser.add_argument(f"--{side}", required=True, help=f"folder, JDBC address or catalog:database of the {side}'s tables")
        parser.add_argument(f"--{side}-properties", help="file of name=value lines for JDBC")
        parser.add_argument(f"--{side}-name", default=side)
    parser.add_argument("--run", required=True, help="shared folder for the stages of this run")
    parser.add_argument("--skip", nargs="*", choices=SKIPPABLE, default=[])
    parser.add_argument("--contacts-with-tag", type=int)
    parser.add_argument("--tag-ids", nargs="*", type=int, default=[])
    parser.add_argument("--product-interests", action="store_true")
    parser.add_argument("--actions-override", help="CSV that replaces the prepared actions")
    parser.add_argument("--actions-snapshot", help="where to put the prepared actions for review")
    parser.add_argument("--next-ids", nargs="*", default=[], metavar="TABLE=ID", help="next free ids of the target, where they lie above the greatest")
    parser.add_argument("--export-relationships", help="folder for each relationship as JSON and CSV")
    parser.add_argument("--import-relationships", help="folder of relationships of an earlier run, as JSON; their stages count as done")
    parser.add_argument("--publish", action="store_true")
    return parser.parse_args(given)


def jdbc_options(address: str, properties: str | None) -> dict[str, str]:
    options = {"url": address}
    if properties:
        lines = Path(properties).read_text().splitlines()
        pairs = [x.split("=", 1) for x in lines if "=" in x and not x.lstrip().startswith("#")]
        options |= {name.strip(): value.strip() for name, value in pairs}
    return options


def app(spark: SparkSession, args: argparse.Namespace, side: str) -> App:
    address, name = getattr(args, side), getattr(args, f"{side}_name")
    next_ids = {t: int(i) for t, i in (x.split("=", 1) for x in args.next_ids)} if side == "target" else {}
    if address.startswith("jdbc:"):
        return App.jdbc(spark, name, jdbc_options(address, getattr(args, f"{side}_properties")), next_ids=next_ids)
    if address.startswith("catalog:"):
        return App.catalog(spark, name, address.removeprefix("catalog:"), next_ids=next_ids)
    return App.parquet(spark, name, address, next_ids=next_ids)


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName("regraft").getOrCreate()
    selection = Selection(
        **{name: name not in args.skip for name in SKIPPABLE},
        contacts_with_tag=args.contacts_with_tag,
        tag_ids=tuple(args.tag_ids),
        product_interests=args.product_interests,
        actions_override=args.actions_override,
        actions_snapshot=args.actions_snapshot,
    )
    transfer = Transfer(
        spark,
        app(spark, args, "source"),
        app(spark, args, "target"),
        selection,
        Staging(spark, args.run, int(spark.conf.get("spark.sql.shuffle.partitions"))),
        datetime.now(),
        read_relationships(spark, args.import_relationships) if args.import_relationships else None,
    ).run()
    if transfer.dropdowns_modified():
        print("Dropdown lists have changed: users of the target must reload.")
    if selection.orders:
        transfer.bad_tokens().show(truncate=False)
    if args.export_relationships:
        for name, rel in transfer.rels.items():
            write_json(rel, f"{args.export_relationships}/{name}.json")
            write_csv(rel, f"{args.export_relationships}/{name}.csv")
    if args.publish and args.target.startswith("jdbc:"):
        transfer.publish_jdbc(jdbc_options(args.target, args.target_properties))
    elif args.publish and args.target.startswith("catalog:"):
        transfer.publish_catalog(args.target.removeprefix("catalog:"))
    elif args.publish:
        transfer.publish_parquet(args.target)
    # what was moved by this run; after publishing, as the target holds it
    stage_report(transfer.report(app(spark, args, "target") if args.publish else None)).show(truncate=False)


if __name__ == "__main__":
    main()
