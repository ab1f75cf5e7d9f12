from pyspark.sql import functions as F

from regraft.functions.columns import (
    alphanumeric_only,
    as_id,
    blank_to_null,
    list_union,
    timestamp_text,
    transfer_label,
    without_point_zero,
)
from regraft.operators.settings import merged_lists, set_values, setting, switched_off

KIND = "Name STRING, Value STRING"


def test_lookup_and_update(frame, rows, spark):
    settings = frame(KIND, ("a", "1"), ("b", "2"))
    got = spark.range(1).select(setting(settings, "a"), setting(settings, "zzz")).first()
    assert tuple(got) == ("1", None)
    changed = set_values(settings, frame(KIND, ("b", "9"), ("c", "7")))
    assert rows(changed) == [("a", "1"), ("b", "9")]


def test_list_union_keeps_order_and_repeats(frame, rows):
    lists = frame("d STRING, s STRING", ("a,b", "b,c,c,d"), ("", "x"), ("a", "a"))
    got = [r[0] for r in lists.select(list_union("d", "s")).collect()]
    assert got == ["a,b,c,c,d", ",x", "a"]


def test_only_changed_lists_are_updates(frame, rows):
    source = frame(KIND, ("l", "a,b"), ("m", "x"), ("other", "q"))
    target = frame(KIND, ("l", "a"), ("m", "x,y"), ("n", "z"))
    assert rows(merged_lists(source, target, ["l", "m", "n"])) == [("l", "a,b")]


def test_switch_off(frame, rows):
    settings = frame(KIND, ("a", "1"), ("b", "1"), ("c", "x"), ("d", None))
    got = switched_off(settings, ["a", "c", "d"])
    assert rows(got) == [("a", "0"), ("b", "1"), ("c", "x"), ("d", None)]


def test_column_functions(frame):
    one = frame("t STRING", ("f-o o!1",)).select(
        alphanumeric_only("t"),
        blank_to_null(F.lit("")),
        blank_to_null(F.lit("x")),
        without_point_zero(F.lit("7.0")),
        without_point_zero(F.lit("10.05")),
        as_id(F.lit("12")),
        as_id(F.lit("x")),
        timestamp_text(F.lit("2024-06-01 12:30:15.9").cast("timestamp")),
    )
    assert tuple(one.first()) == ("foo1", None, "x", "7", "10.05", 12, None, "2024-06-01 12:30:15")
    assert transfer_label("a", "b") == "Data Transferred - a > b"
