from datetime import datetime

from regraft.operators.integrity import (
    cascade,
    count_report,
    first_per_key,
    grouped_list,
    in_use,
    keep_children,
    without_existing,
)


def test_cascade_follows_kept_parents(frame, rows):
    tables = {
        "a": frame("Id BIGINT", (1,), (2,)),
        "b": frame("Id BIGINT, A BIGINT", (10, 1), (11, 3), (12, None)),
        "c": frame("Id BIGINT, B BIGINT", (20, 10), (21, 11), (22, 12)),
    }
    kept = cascade(tables, [("b", "A", "a"), ("c", "B", "b")])
    assert rows(kept["b"]) == [(10, 1)]
    assert rows(kept["c"]) == [(20, 10)]


def test_children_are_not_repeated_by_repeated_parents(frame, rows):
    children = frame("Id BIGINT, P BIGINT", (1, 5), (2, 6))
    parents = frame("Id BIGINT", (5,), (5,))
    assert rows(keep_children(children, "P", parents)) == [(1, 5)]


def test_existing_rows_go_and_nulls_stay(frame, rows):
    pairs = "C BIGINT, G BIGINT"
    new = frame(pairs, (1, 1), (1, 2), (None, 1), (2, None))
    have = frame(pairs, (1, 1), (None, 1), (2, None))
    lacking = [(1, 2), (2, None), (None, 1)]
    assert rows(without_existing(new, have, ["C", "G"])) == lacking
    assert rows(without_existing(new, have, ["C", "G"], repeats=False)) == lacking
    assert rows(without_existing(new, have, ["C", "G"], nulls_equal=True)) == [(1, 2)]


def test_first_per_key(frame, rows):
    def day(n):
        return datetime(2024, 1, n)

    table = frame(
        "C BIGINT, G BIGINT, D TIMESTAMP, N STRING",
        (1, 1, day(2), "b"), (1, 1, day(1), "z"), (1, 1, day(1), "y"), (1, 1, None, "a"),
        (None, 1, day(5), None), (None, 1, day(4), "n"),
    )
    assert rows(first_per_key(table, ["C", "G"], ["D"])) == [
        (1, 1, day(1), "y"), (None, 1, day(4), "n"),
    ]
    assert rows(first_per_key(table.drop("N"), ["C", "G"])) == [
        (1, 1, day(1)), (None, 1, day(4)),
    ]
    assert rows(first_per_key(table.select("C", "G"), ["C", "G"])) == [(1, 1), (None, 1)]


def test_group_to_list(frame, rows):
    table = frame("C BIGINT, G BIGINT", (1, 3), (1, 2), (1, 3), (None, 9), (2, 1))
    assert rows(grouped_list(table, "C", "G", "L")) == [(1, [2, 3]), (2, [1])]


def test_in_use(frame, rows):
    assert rows(in_use(frame("C BIGINT", (1,), (1,), (4,)), "C", "v")) == [(1,), (4,)]


def test_count_report(frame, rows):
    before = {"A": frame("Id BIGINT", (1,)), "B": frame("Id BIGINT")}
    after = {"A": frame("Id BIGINT", (1,), (2,), (3,)), "B": frame("Id BIGINT")}
    assert rows(count_report(before, after)) == [("A", 1, 3, 2), ("B", 0, 0, 0)]
