"""Rewriting foreign keys through relationships.

A lookup joins a side that is unique on its key. Where that side is small by
its statistics Spark broadcasts it, else both are shuffled on the key. Null and
reserved keys (0, -1) would then all meet in one task: they join under the
row's own id instead, which spreads them, and an extra condition keeps them
from finding a partner. Other hot keys are split by the skew-join rule of
adaptive execution, which applies as the looked-up side is shuffled for the
join and not aggregated in it.

Pairs that lie in buckets aren't shuffled, so nothing splits a hot key there.
``with_hot_answers`` looks for such keys first and has them answered by expression.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regraft.functions.columns import is_digits, is_integer_text, split_list
from regraft.operators.relationship import Relationship


#: A key with fewer rows is no trouble to one task.
HOT_ROWS = 1 << 20
#: Frequent keys that are looked for in a column, and items that the sketch keeps for it.
HOT_KEYS, SKETCHED = 1000, 10_000


def _reserved(key: str, rel: Relationship) -> str | None:
    """Whether a key is answered without the join."""
    listed = ", ".join(map(str, (*rel.identities, *rel.answers)))
    return f"{key} IN ({listed})" if listed else None


def _answered(key: str, rel: Relationship) -> str:
    """The new id: by expression for reserved and hot keys, else that of the join."""
    own = [f"WHEN {key} IN ({', '.join(map(str, rel.identities))}) THEN {key}"] if rel.identities else []
    known = [f"WHEN {key} = {old} THEN {'NULL' if new is None else new}" for old, new in rel.answers.items()]
    return f"CASE {' '.join(own + known)} ELSE rel_new END" if own or known else "rel_new"


def estimated_bytes(df: DataFrame) -> int:
    """What Spark takes the frame for; far too much where it doesn't know."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def with_hot_answers(
    df: DataFrame, lookups: Mapping[str, Relationship], hot_rows: int | None = None
) -> dict[str, Relationship]:
    """The relationships, those in buckets with answers for the keys that are frequent in ``df``.

    A key is frequent that has more rows than a bucket should have, and ``hot_rows``
    at least. One pass over the key columns with a sketch of fixed size for each;
    a frame too small to hold that many rows isn't looked at. To the driver come
    the frequent keys and their new ids.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    asked = {c: rel for c, rel in lookups.items() if rel.buckets and c in df.columns}
    if not asked or estimated_bytes(df.select(*asked)) < hot_rows:
        return dict(lookups)
    tops = [f"approx_top_k({_key(df, c)}, {HOT_KEYS}, {SKETCHED}) AS top_{i}" for i, c in enumerate(asked)]
    counted = df.selectExpr("count(*) AS rows", *tops).first()
    out = dict(lookups)
    for i, (column, rel) in enumerate(asked.items()):
        least = max(hot_rows, counted["rows"] / rel.buckets)
        hot = [t["item"] for t in counted[f"top_{i}"] or [] if t["count"] > least and t["item"] is not None]
        hot = [k for k in hot if k not in rel.identities]
        if hot:
            known = rel.pairs.where(F.col("old_id").isin(hot)).select("old_id", "new_id").collect()
            out[column] = replace(rel, answers={**dict.fromkeys(hot), **{r.old_id: r.new_id for r in known}})
    return out


def _key(df: DataFrame, column: str) -> str:
    """The column as an id. Text that is no number counts as null."""
    kind = df.schema[column].dataType.typeName()
    return f"`{column}`" if kind == "long" else f"try_cast(`{column}` AS BIGINT)"


def _looked_up(
    df: DataFrame, column: str, rel: Relationship, row_id: str
) -> tuple[DataFrame, str]:
    """Join one relationship; returns the frame and the new value's expression."""
    key, own = _key(df, column), f"try_cast(`{row_id}` AS BIGINT)"
    reserved = _reserved(key, rel)
    plain = f"({key} IS NOT NULL AND NOT {reserved})" if reserved else f"({key} IS NOT NULL)"
    on = f"CASE WHEN {plain} THEN {key} ELSE {own} END = rel_old AND {plain}"
    return df.join(rel.lookup, F.expr(on), "left"), _answered(key, rel)


def _settled(df: DataFrame, joined: DataFrame, column: str, value: str | Column) -> DataFrame:
    if isinstance(value, str):
        return joined.selectExpr(
            *[f"CAST({value} AS BIGINT) AS `{c}`" if c == column else f"`{c}`" for c in df.columns]
        )
    return joined.select(
        *[value.cast("bigint").alias(c) if c == column else c for c in df.columns]
    )


def remap(
    df: DataFrame,
    lookups: Mapping[str, Relationship],
    *,
    required: bool = False,
    row_id: str = "Id",
) -> DataFrame:
    """Replace old ids by new ones; an id the relationship lacks becomes null.

    With ``required`` such rows are dropped, which is the membership filter and
    the rewrite in one join. Columns the frame does not have are passed over.
    """
    for column, rel in lookups.items():
        if column not in df.columns:
            continue
        if required and not rel.identities and not rel.answers:
            joined = df.join(rel.lookup, F.expr(f"{_key(df, column)} = rel_old"), "inner")
            df = _settled(df, joined, column, "rel_new")
            continue
        joined, value = _looked_up(df, column, rel, row_id)
        if required:
            joined = joined.where(f"({value}) IS NOT NULL")
        df = _settled(df, joined, column, value)
    return df


def remap_or_keep(df: DataFrame, column: str, rel: Relationship, row_id: str = "Id") -> DataFrame:
    """Like an update join: an id the relationship lacks stays as it was."""
    joined, value = _looked_up(df, column, rel, row_id)
    return _settled(df, joined, column, f"coalesce({value}, {_key(df, column)})")


def remap_or_default(
    df: DataFrame, column: str, rel: Relationship, default: int | Column, row_id: str = "Id"
) -> DataFrame:
    """An id the relationship lacks, or a null, becomes ``default``."""
    joined, value = _looked_up(df, column, rel, row_id)
    if isinstance(default, int):
        return _settled(df, joined, column, f"coalesce({value}, {default})")
    return _settled(df, joined, column, F.coalesce(F.expr(value), default))


def remap_list(
    df: DataFrame, column: str, rel: Relationship, *, strict: bool = False, row_id: str = "Id"
) -> DataFrame:
    """Rewrite the ids inside a comma-separated list, keeping their order.

    Unknown ids go. Tolerant form: tokens that are not plain digits go too.
    Strict form: blanks and a sign around the digits are fine, and what still
    is no number is listed by ``bad_list_tokens``. Null and empty lists stay;
    a list that loses everything becomes empty.

    Only ``(row id, position, token)`` is exploded, and lists are put together
    per row, so the work per group is one cell of the table.
    """
    valid = is_integer_text("token") if strict else is_digits("token")
    tokens = (
        df.selectExpr(f"`{row_id}` AS list_row", f"posexplode(split(`{column}`, ',')) AS (pos, token)")
        .where(valid)
        .selectExpr("list_row", "pos", "try_cast(trim(token) AS BIGINT) AS token_id")
    )
    rel = with_hot_answers(tokens, {"token_id": rel})["token_id"]
    if _reserved("token_id", rel):
        found, value = _looked_up(tokens, "token_id", rel, "list_row")
    else:
        found, value = tokens.join(rel.lookup, F.expr("token_id = rel_old"), "inner"), "rel_new"
    entries = f"""
        array_join(transform(sort_array(collect_list(
            CASE WHEN {value} IS NOT NULL THEN struct(pos, {value} AS id) END)),
            e -> CAST(e.id AS STRING)), ',') AS new_list"""
    lists = found.groupBy("list_row").agg(F.expr(entries))
    kept = f"""
        CASE WHEN `{column}` IS NULL OR `{column}` = '' THEN `{column}`
             ELSE coalesce(new_list, '') END AS `{column}`"""
    return df.join(lists, F.expr(f"`{row_id}` = list_row"), "left").selectExpr(
        *[kept if c == column else f"`{c}`" for c in df.columns]
    )


def bad_list_tokens(df: DataFrame, column: str, row_id: str = "Id") -> DataFrame:
    """``(row id, token)`` for tokens the strict list form cannot read."""
    return (
        df.where(F.col(column) != "")
        .select(row_id, F.explode(split_list(column)).alias("token"))
        .where(~is_integer_text("token"))
    )
