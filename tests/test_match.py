from regraft.operators.match import inner_match, match_or_create, natural_match
from regraft.operators.relationship import Relationship, prefer_later

SOURCE = [(1, "a"), (2, None), (3, "b"), (4, "b"), (5, "z")]
TARGET = [(10, "a"), (11, None), (12, "a"), (13, "A")]
NAMED = "Id BIGINT, Name STRING"


def test_null_and_repeated_keys(frame, rows):
    got = natural_match(frame(NAMED, *SOURCE), frame(NAMED, *TARGET), ["Name"])
    assert rows(got) == [(1, 12), (2, 11), (3, None), (4, None), (5, None)]


def test_inner_match_leaves_nulls_out(frame, rows):
    got = inner_match(frame(NAMED, *SOURCE), frame(NAMED, *TARGET), ["Name"])
    assert rows(got) == [(1, 12)]


def test_every_unmatched_row_is_created(frame, rows):
    made = match_or_create(frame(NAMED, *SOURCE), frame(NAMED, *TARGET), ["Name"], 14)
    assert rows(made.relationship.pairs) == [(1, 12), (2, 11), (3, 14), (4, 16), (5, 18)]
    assert rows(made.rows) == [(14, "b"), (16, "b"), (18, "z")]


def test_second_run_creates_nothing_and_takes_the_last(frame, rows):
    source, target = frame(NAMED, *SOURCE), frame(NAMED, *TARGET)
    first = match_or_create(source, target, ["Name"], 14)
    again = match_or_create(source, target.unionByName(first.rows), ["Name"], 30)
    assert rows(again.rows) == []
    assert rows(again.relationship.pairs) == [(1, 12), (2, 11), (3, 16), (4, 16), (5, 18)]


def test_one_row_per_key_on_request(frame, rows):
    source = frame(NAMED, *SOURCE, (6, "z"))
    made = match_or_create(source, frame(NAMED, *TARGET), ["Name"], 14, dedupe_source_keys=True)
    assert rows(made.relationship.pairs) == [(1, 12), (2, 11), (3, 14), (4, 14), (5, 16), (6, 16)]
    assert rows(made.rows) == [(14, "b"), (16, "z")]


def test_composite_keys(frame, rows):
    kind = "Id BIGINT, A STRING, B BIGINT"
    source = frame(kind, (1, "x", 1), (2, "x", None), (3, None, None))
    target = frame(kind, (7, "x", None), (8, None, None), (9, "y", 1))
    assert rows(natural_match(source, target, ["A", "B"])) == [(1, None), (2, 7), (3, 8)]


def test_later_frames_win(frame, rows):
    pairs = "old_id BIGINT, new_id BIGINT"
    merged = prefer_later(frame(pairs, (1, 90), (2, 5)), frame(pairs, (1, 3), (1, 4)))
    assert rows(merged) == [(1, 4), (2, 5)]


def test_complete_relationship_has_reserved_pairs_once(frame, rows):
    rel = Relationship(frame("old_id BIGINT, new_id BIGINT", (0, 55), (1, 9)), (0, -1))
    assert rows(rel.complete()) == [(-1, -1), (0, 0), (1, 9)]
    assert rows(rel.only([1]).pairs) == [(1, 9)]
