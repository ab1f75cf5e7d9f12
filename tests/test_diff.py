from regraft.operators.diff import (
    add_columns,
    append_rows,
    frame_difference,
    missing_columns,
    pick,
    rename_columns,
    schema_rows,
    upsert,
)

PAIR = "K BIGINT, V STRING"


def test_difference_keeps_repeats_and_equals_nulls(frame, rows):
    first = frame(PAIR, (1, "x"), (1, "x"), (2, "y"), (None, None))
    second = frame(PAIR, (2, "y"), (None, None), (3, "q"))
    assert rows(frame_difference(first, second)) == [
        (1, "x", "right_only"), (1, "x", "right_only"), (3, "q", "left_only"),
    ]
    assert rows(frame_difference(first, second, "left_only")) == [(3, "q", "left_only")]
    assert rows(frame_difference(first, second, "both")) == [
        (2, "y", 1, "both"), (None, None, 1, "both"),
    ]


def test_common_rows_pair_up_their_repeats(frame, rows):
    first, second = frame(PAIR, (1, "x"), (1, "x")), frame(PAIR, (1, "x"), (1, "x"), (1, "x"))
    assert rows(frame_difference(first, second, "both")) == [(1, "x", 6, "both")]


def test_schema_rows_and_gap(frame, rows, spark):
    mine = frame("Id BIGINT, A STRING, B DOUBLE")
    theirs = frame("Id BIGINT, A BIGINT")
    assert rows(schema_rows(spark, mine.schema), "Field", "Type", "Key") == [
        ("A", "string", ""), ("B", "double", ""), ("Id", "bigint", "PRI"),
    ]
    assert missing_columns(mine.schema, theirs.schema) == {"B": "double"}


def test_upsert_replaces_whole_rows(frame, rows):
    target = frame("Id BIGINT, A STRING, B STRING", (1, "a", "b"), (2, "c", "d"))
    new = frame("Id BIGINT, A STRING, C STRING", (2, "n", "m"), (3, "o", "p"))
    wide = add_columns(target, {"C": "string", "A": "string"})
    assert rows(upsert(wide, new)) == [
        (1, "a", "b", None), (2, "n", None, "m"), (3, "o", None, "p"),
    ]


def test_append_pick_rename(frame, rows):
    target = frame("Id BIGINT, A STRING", (1, "a"))
    assert rows(append_rows(target, frame("Id BIGINT", (2,)))) == [(1, "a"), (2, None)]
    assert pick(target, ["A", "Nope", "Id"]).columns == ["A", "Id"]
    assert rename_columns(target, {"A": "B"}).columns == ["Id", "B"]
