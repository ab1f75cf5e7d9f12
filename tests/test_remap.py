import pytest

from regraft.operators.relationship import Relationship
from regraft.operators.remap import (
    bad_list_tokens,
    remap,
    remap_list,
    remap_or_default,
    remap_or_keep,
)

PAIRS = "old_id BIGINT, new_id BIGINT"


@pytest.fixture
def rel(frame):
    return Relationship(frame(PAIRS, (1, 11), (2, 12), (3, 13)), (0,))


def test_absent_key_becomes_null(frame, rows, rel):
    table = frame("Id BIGINT, Fk BIGINT", (1, 0), (2, 7), (3, 3), (4, None))
    assert rows(remap(table, {"Fk": rel})) == [(1, 0), (2, None), (3, 13), (4, None)]


def test_reserved_ids_are_not_looked_up_by_the_row_id(frame, rows, rel):
    table = frame("Id BIGINT, Fk BIGINT", (1, 0), (2, None), (3, -1))
    assert rows(remap(table, {"Fk": rel})) == [(1, 0), (2, None), (3, None)]


def test_required_drops_rows(frame, rows, rel):
    table = frame("Id BIGINT, Fk BIGINT", (1, 0), (2, 7), (3, 3), (4, None))
    assert rows(remap(table, {"Fk": rel}, required=True)) == [(1, 0), (3, 13)]
    plain = rel.with_identities()
    assert rows(remap(table, {"Fk": plain}, required=True)) == [(3, 13)]


def test_several_columns_and_absent_ones(frame, rows, rel):
    table = frame("Id BIGINT, A BIGINT, B STRING", (1, 1, "2"), (2, 2, "x"))
    got = remap(table, {"A": rel, "B": rel, "Nope": rel})
    assert rows(got) == [(1, 11, 12), (2, 12, None)]


def test_self_reference(frame, rows):
    table = frame("Id BIGINT, Parent BIGINT", (1, 2), (2, 0), (3, 9))
    rel = Relationship(frame(PAIRS, (1, 101), (2, 103), (3, 105)), (0,))
    got = remap(remap(table, {"Parent": rel}), {"Id": rel})
    assert rows(got) == [(101, 103), (103, 0), (105, None)]


def test_update_join_keeps_old_value(frame, rows, rel):
    table = frame("Id BIGINT, Fk BIGINT", (1, 0), (2, 7), (3, 3), (4, None))
    assert rows(remap_or_keep(table, "Fk", rel)) == [(1, 0), (2, 7), (3, 13), (4, None)]


def test_fallback(frame, rows, rel):
    table = frame("Id BIGINT, Fk BIGINT", (1, 1), (2, 7), (4, None))
    got = remap_or_default(table, "Fk", rel.with_identities(), 99)
    assert rows(got) == [(1, 11), (2, 99), (4, 99)]


def test_tolerant_list(frame, rows, rel):
    table = frame("Id BIGINT, L STRING", (1, "1,2, 3,x,9"), (2, ""), (3, None), (4, "9"), (5, "3,1,3"))
    got = remap_list(table, "L", rel.with_identities())
    assert rows(got) == [(1, "11,12"), (2, ""), (3, None), (4, ""), (5, "13,11,13")]


def test_strict_list_reads_blanks_and_signs(frame, rows, rel):
    table = frame("Id BIGINT, L STRING", (1, " 3,+1,x,9"), (2, "2 , 2"))
    got = remap_list(table, "L", rel.with_identities(), strict=True)
    assert rows(got) == [(1, "13,11"), (2, "12,12")]
    assert rows(bad_list_tokens(table, "L")) == [(1, "x")]


def test_list_with_reserved_ids(frame, rows, rel):
    table = frame("Id BIGINT, L STRING", (1, "0,3,8,0"))
    assert rows(remap_list(table, "L", rel)) == [(1, "0,13,0")]
