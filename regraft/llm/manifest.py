"""Merkle manifest of a dataset, with proofs found by pointer jumping.

Each row is a leaf; leaves of a group, in order, are hashed run by run into nodes
until one is left, and so are these over all groups, in order, up to the root.
Levels are built one by one, each from the runs of the level below, and each is an
eighth of it.

Proofs: every node knows its ancestor one level up and the segment of siblings on
the way. Each round joins the levels with themselves: a node takes over its
ancestor's ancestor, appends that one's segment to its own, and so doubles its
distance, until the nodes above the leaves reach the root in as many rounds as the
logarithm of the height. A leaf's own siblings lie in its run, which holds its
leaves' rows, so only runs are joined, never single rows.

Positions: rows are dealt out by ranges of ``(group, key, leaf)`` and numbered
where they lie; the numbers of the ranges before are added. A large group is thus
spread like any other. Rows that are alike in all fields take neighbouring places.

Defined results: a null key comes first in its group and a null group before the
others; rows that share a key are in order of their leaf; null fields count as
``-``; a single leaf is its group's node, a single group's node the root; an empty
table has no rows; further columns are ignored.

Only the numbers within a range are given in Python, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Nodes of a run.
FAN = 8
NO_STEPS = "array<struct<at: int, run: array<binary>>>"


def digest(text: Column) -> Column:
    """SHA-256 in 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexed(digests: Column) -> Column:
    """Digests as one lower-case hex text."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def field(value: Column) -> Column:
    """``-`` if null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*map(field, fields)))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with ``part, local``, their place within a range and group, and ``of, at, base, size``.

    The place of a row within its group is ``base + local``, with ``base`` taken
    where ``of`` and ``at`` are its group and part; ``size`` counts the group's rows.
    """
    # breaks ties between rows that are alike; fixed once it is written
    tied = stage(rows.withColumn("tie", F.monotonically_increasing_id()), "rows")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tied.repartitionByRange(parts, group, *order, "tie").sortWithinPartitions(group, *order, "tie").drop("tie")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, reached = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = np.asarray(batch.column(group).dictionary_encode().indices.fill_null(-1)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            # groups lie one after the other, and one may have begun in an earlier batch
            first = np.repeat(starts, np.diff([*starts, n]))
            local = np.arange(n) - first
            if before == (batch.column(group)[0].as_py(),):
                local[first == 0] += reached
            before, reached = (batch.column(group)[n - 1].as_py(),), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(local)], [*batch.schema.names, "part", "local"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = stage(dealt.mapInArrow(count, f"{kinds}, part int, local long"), "places")
    # groups lie in order, so there are no more rows of these than ranges and groups together
    counts = placed.groupBy(F.col(group).alias("of"), F.col("part").alias("at")).agg(F.count("*").alias("n"))
    by = Window.partitionBy("of")
    base = F.coalesce(F.sum("n").over(by.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed, stage(counts.select("of", "at", base.alias("base"), F.sum("n").over(by).alias("size")), "bases")


def with_place(placed: DataFrame, bases: DataFrame, group: str) -> DataFrame:
    return placed.join(bases, placed[group].eqNullSafe(bases["of"]) & (placed["part"] == bases["at"])).withColumn("node", F.col("base") + F.col("local"))


def height(size: int) -> int:
    """Levels above ``size`` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def runs_of(nodes: DataFrame, level: int, *payload: str) -> DataFrame:
    """``tree, node, size, children, digest`` one level up, with ``payload`` of the children in order.

    A tree that has one node on this level keeps it as it is; its ``children`` are null.
    """
    child = F.struct((F.col("node") % FAN).cast("int").alias("at"), "digest", *payload)
    runs = nodes.groupBy("tree", F.expr(f"node DIV {FAN}").alias("node"), "size").agg(F.array_sort(F.collect_list(child)).alias("own"))
    alone = F.col("size") <= F.lit(FAN**level)
    return runs.select(
        "tree", "node", "size", F.when(~alone, F.col("own.digest")).alias("children"),
        F.when(alone, F.get("own.digest", F.lit(0))).otherwise(digest(hexed(F.col("own.digest")))).alias("digest"),
        *[F.col(f"own.{p}").alias(p) for p in payload],
    )


def steps(runs: DataFrame) -> DataFrame:
    """``tree, node, path`` of the nodes below runs: one step each, ``(at, run)``; none where a tree's only node goes up alone."""
    own = F.explode(F.coalesce(F.transform("children", lambda c, i: i), F.array(F.lit(0))))
    lying = runs.select("tree", "node", "children", own.alias("at"))
    step = F.struct(F.col("at").cast("int").alias("at"), F.col("children").alias("run"))
    return lying.select(
        "tree", (F.col("node") * FAN + F.col("at")).alias("node"),
        F.when(F.col("children").isNull(), F.array().cast(NO_STEPS)).otherwise(F.array(step)).alias("path"),
    )


def doubled(paths: list[DataFrame], reach: int, name: str) -> list[DataFrame]:
    """Paths of each level over twice ``reach`` levels, by a join with those of the level ``reach`` further up."""
    out = []
    for level, below in enumerate(paths):
        if level + reach >= len(paths):
            out.append(below)
            continue
        above = paths[level + reach].select(F.col("tree").alias("top_tree"), F.col("node").alias("top"), F.col("path").alias("on"))
        at = F.expr(f"node DIV {FAN**reach}L")
        joined = below.join(above, (F.col("tree") == F.col("top_tree")) & (at == F.col("top")))
        out.append(stage(joined.select("tree", "node", F.concat("path", "on").alias("path")), name))
    return out


def paths_to_top(first: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``tree, node, path`` of the nodes of the lowest level to the top; ``levels`` are the runs above each."""
    paths = [stage(steps(runs), "steps") for runs in levels]
    if not paths:
        return first.select("tree", "node", F.array().cast(NO_STEPS).alias("path"))
    reach = 1
    while reach < len(levels):
        paths = doubled(paths, reach, "segments")
        reach *= 2
    return paths[0]


def folded(begin: Column, path: Column) -> Column:
    """The digest at the end of a path that begins with ``begin``."""

    def up(node: Column, step: Column) -> Column:
        return digest(hexed(F.transform(step["run"], lambda d, i: F.when(i == step["at"], node).otherwise(d))))

    return F.reduce(path, begin, up)


def siblings(path: Column) -> Column:
    """The digests beside a path, level by level, left to right."""
    return F.flatten(F.transform(path, lambda step: F.filter(step["run"], lambda d, i: i != step["at"])))


def merkle_manifest(rows: DataFrame, key: str, group: str, fields: Sequence[str], changed: Column | None = None, column: str = "text") -> DataFrame:
    """``key, group, leaf, subroot, root, path, changed_leaf``: each row's leaf and its path of ``(at, run)`` steps to the root.

    Digests are 32 bytes. ``changed_leaf`` is the leaf with ``changed`` in place of
    ``column``, null where ``changed`` is: :func:`folded` of it isn't the root if it
    differs. To the driver come the number of groups, the greatest group's size and the root.
    """
    none = F.lit(None).cast("string")
    given = rows.select(*dict.fromkeys([key, group, *fields]), (none if changed is None else changed).alias("_changed"))
    instead = leaf([F.col("_changed" if f == column else f) for f in fields])
    leaves = given.select(
        F.col(key).alias("key"), F.col(group).cast("string").alias("group"), leaf([F.col(f) for f in fields]).alias("digest"),
        F.when(F.col("_changed").isNotNull(), instead).alias("changed_leaf"),
    )
    placed, bases = numbered(leaves, "group", ["key", "digest"])
    groups, of_groups = numbered(bases.select(F.col("of").alias("group"), "size", F.lit(0).alias("all")).distinct(), "all", ["group"])
    trees = stage(with_place(groups, of_groups.drop("size"), "all").select(F.col("group").alias("tree_of"), F.col("node").alias("tree")), "trees")
    count, greatest = groups.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    within = with_place(placed, stage(bases.join(trees, F.col("of").eqNullSafe(F.col("tree_of"))), "bases"), "group")

    lowest = nodes = stage(runs_of(within.withColumn("leaves", F.col("digest")), 0, "key", "group", "leaves", "changed_leaf"), "runs")
    levels = []
    for level in range(1, height(greatest)):
        nodes = stage(runs_of(nodes.select("tree", "node", "size", "digest"), level), "runs")
        levels.append(nodes)
    subroots = nodes.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("node"), F.lit(count).cast("long").alias("size"), "digest")
    nodes, tops = subroots, []
    for level in range(height(count)):
        nodes = stage(runs_of(nodes.select("tree", "node", "size", "digest"), level), "tops")
        tops.append(nodes)
    root = nodes.select("digest").first()

    over = paths_to_top(subroots, tops).select(F.col("node").alias("of_tree"), F.col("path").alias("over"))
    above = stage(subroots.join(over, F.col("node") == F.col("of_tree")).select("of_tree", F.col("digest").alias("subroot"), "over"), "over")
    paths = paths_to_top(lowest, levels).select(F.col("tree").alias("up_tree"), F.col("node").alias("up"), "path")
    joined = lowest.join(paths, (F.col("tree") == F.col("up_tree")) & (F.col("node") == F.col("up"))).join(above, F.col("tree") == F.col("of_tree"))
    each = joined.select(
        "children", "subroot", F.concat("path", "over").alias("rest"),
        F.posexplode(F.arrays_zip("key", "group", "leaves", "changed_leaf")).alias("at", "row"),
    )
    own = F.array(F.struct(F.col("at").cast("int").alias("at"), F.col("children").alias("run")))
    path = F.concat(F.when(F.col("children").isNull(), F.array().cast(NO_STEPS)).otherwise(own), F.col("rest"))
    return each.select(
        F.col("row.key").alias(key), F.col("row.group").alias(group), F.col("row.leaves").alias("leaf"), "subroot",
        F.lit(bytes(root.digest) if root else None).cast("binary").alias("root"), path.alias("path"), F.col("row.changed_leaf").alias("changed_leaf"),
    )


def manifest_digests(documents: DataFrame) -> DataFrame:
    """The manifest of ``documents`` in hex, and what folding finds where every third text by its id's CRC has lost its capitals."""
    tampered = F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 0")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = F.when(tampered, F.translate("text", capitals, capitals.lower()))
    made = merkle_manifest(documents, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"], changed)
    end = folded(F.coalesce("changed_leaf", "leaf"), F.col("path"))
    shown = lambda c: F.lower(F.hex(c))
    done = made.select(
        "doc_id", *[shown(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(hexed(siblings(F.col("path"))), 256).alias("proof_sha256"), shown(end).alias("folded_root"),
    )
    return done.withColumn("verified", F.expr("folded_root = root"))
