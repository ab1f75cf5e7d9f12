"""URL filter: dated list entries as validity intervals, every capture judged by the entries of its fetch time.

A list entry ``(list, pattern, action, dated)`` adds or removes a pattern from
its date on; the next entry of the same list and pattern ends the interval. A
pattern is a host (its subdomains included, in any letter case) or a host with a
path prefix that ends at a slash (in its own letter case). A capture looks up its host suffixes and path prefixes in the
intervals that reach into its month, so the join is on equal keys and a hot
host is split by adaptive execution.

Defined results: a capture without URL, host or fetch time is not blocked; rows
of captures that repeat are judged alike and give one row each; entries with a
null or an action other than ``add`` and ``remove`` are ignored; of entries of
one list, pattern and date ``add`` wins; without entries nothing is blocked.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PARTS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, _PARTS, 1)), r"\.$", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def lookup_keys(url: Column, depth: int) -> Column:
    """Host suffixes, and the host with up to ``depth`` leading path segments."""
    labels = F.split(host(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    if not depth:
        return suffixes
    segments = F.split(F.regexp_replace(path(url), "^/", ""), "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(segments), F.lit(depth))),
        lambda i: F.concat_ws("/", host(url), F.array_join(F.slice(segments, 1, i), "/")),
    )
    return F.array_distinct(F.concat(suffixes, prefixes))


def validity(entries: DataFrame) -> DataFrame:
    """``list, pattern, since, until`` (null: still listed) from dated entries."""
    given = F.regexp_replace(F.trim("pattern"), "/+$", "")
    pattern = F.concat(F.lower(F.regexp_extract(given, "^[^/]*", 0)), F.regexp_extract(given, "(?s)^[^/]*(.*)$", 1))
    usable = entries.select("list", pattern.alias("pattern"), "action", "dated").where(
        "list IS NOT NULL AND pattern != '' AND dated IS NOT NULL AND action IN ('add', 'remove')"
    )
    per_date = usable.groupBy("list", "pattern", "dated").agg(F.min("action").alias("action"))
    order = Window.partitionBy("list", "pattern").orderBy("dated")
    changes = per_date.withColumn("before", F.lag("action").over(order)).where("before IS NULL OR before != action")
    return (
        changes.withColumn("until", F.lead("dated").over(order))
        .where("action = 'add'")
        .select("list", "pattern", F.col("dated").alias("since"), "until")
    )


def judge(captures: DataFrame, entries: DataFrame, ident: str = "page_id") -> DataFrame:
    """``ident, url, fetched, blocked, n_entries, list, pattern, since`` for every capture.

    ``captures`` has ``ident``, ``url`` and ``fetched``; the entry shown is the
    first by list, longest pattern and date.
    """
    intervals = validity(entries)
    depth = intervals.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    latest = captures.agg(F.max("fetched")).first()[0]
    month = lambda c: F.year(c) * 12 + F.month(c)
    by_month = intervals.where(F.col("since") <= F.lit(latest)).withColumn(
        "month", F.explode(F.sequence(month("since"), month(F.coalesce(F.least("until", F.lit(latest)), F.lit(latest)))))
    )
    named = captures.select(ident, "url", "fetched")
    keyed = named.where("url IS NOT NULL AND fetched IS NOT NULL").distinct().select(
        ident, "url", "fetched", month("fetched").alias("month"), F.explode(lookup_keys(F.col("url"), depth)).alias("key")
    )
    found = (
        keyed.join(by_month, (keyed.key == by_month.pattern) & (keyed.month == by_month.month))
        .where((F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
        .groupBy(ident, "url", "fetched")
        .agg(
            F.count("*").alias("n_entries"),
            F.min(F.struct("list", (-F.length("pattern")).alias("shorter"), "pattern", "since")).alias("entry"),
        )
    )
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (ident, "url", "fetched")]
    return named.alias("n").join(found.alias("f"), same, "left").select(
        f"n.{ident}", "n.url", "n.fetched", F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).alias("n_entries"), "entry.list", "entry.pattern", "entry.since",
    )


def allowed(captures: DataFrame, entries: DataFrame, ident: str = "page_id") -> DataFrame:
    """The captures that no entry blocked when they were fetched."""
    return judge(captures, entries, ident).where("NOT blocked").select(ident, "url", "fetched")
