"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(text: ColumnLike) -> Column:
    """An empty string counts as missing."""
    return F.nullif(as_column(text), F.lit(""))


def as_id(value: ColumnLike) -> Column:
    """Text or number to a 64-bit id; anything that is not a number gives null."""
    return as_column(value).try_cast("bigint")


def filled(value: ColumnLike, default: object) -> Column:
    return F.coalesce(as_column(value), F.lit(default))


def is_digits(text: ColumnLike) -> Column:
    return as_column(text).rlike("^[0-9]+$")


def is_integer_text(text: ColumnLike) -> Column:
    """A signed whole number, blanks around it allowed."""
    return as_column(text).rlike(r"^\s*[+-]?[0-9]+\s*$")


def split_list(text: ColumnLike) -> Column:
    return F.split(as_column(text), ",")


def join_list(items: ColumnLike) -> Column:
    return F.array_join(as_column(items), ",")


def alphanumeric_only(text: ColumnLike) -> Column:
    return F.regexp_replace(as_column(text), "[^A-Za-z0-9]", "")


def without_point_zero(text: ColumnLike) -> Column:
    """``7.0`` to ``7``. Only a trailing ``.0`` goes, so ``10.05`` stays."""
    return F.regexp_replace(as_column(text).cast("string"), r"\.0$", "")


def timestamp_text(moment: datetime | Column) -> Column:
    moment = F.lit(moment) if isinstance(moment, datetime) else moment
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def transfer_label(source: str, target: str) -> str:
    return f"Data Transferred - {source} > {target}"


def list_union(kept: ColumnLike, added: ColumnLike) -> Column:
    """Comma lists: everything in ``kept``, then what ``added`` has on top of it.

    Order and repeats inside ``added`` stay, which ``array_union`` would lose.
    """
    have = split_list(kept)
    extra = F.filter(split_list(added), lambda item: ~F.array_contains(have, item))
    return join_list(F.concat(have, extra))
