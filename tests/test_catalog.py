"""A catalog's database as a target."""

import uuid

import pytest

from regraft.sources import catalog
from regraft.sources.app import App
from regraft.sources.catalog import append_table, quoted, update_table
from regraft.sources.sinks import IdsTaken


@pytest.fixture
def database(spark, frame, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    frame("Id BIGINT, A STRING, N INT", (1, "a", 1), (2, "b", None)).write.saveAsTable(f"{name}.T")
    frame("Name STRING, Value STRING, Note STRING", ("x", "1", "n"), ("y", "2", "m")).write.saveAsTable(f"{name}.S")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_appended_and_widened(spark, frame, rows, database):
    new = frame("Id INT, n BIGINT, `more of it` DOUBLE", (3, 5, 0.5), (4, None, None))
    append_table(new, f"{database}.T")
    append_table(new, f"{database}.T")
    app = App.catalog(spark, "dst", database)
    assert rows(app.table("T")) == [(1, "a", 1, None), (2, "b", None, None), (3, None, 5, 0.5), (4, None, None, None)]
    assert app.columns("T") == ["Id", "A", "N", "more of it"] and app.place == f"catalog:{database}"
    assert spark.range(1).select(app.next_id("T")).first()[0] == 5


def test_append_stops_at_what_does_not_fit(frame, database):
    with pytest.raises(IdsTaken):
        append_table(frame("Id BIGINT, A STRING", (2, "other")), f"{database}.T")
    with pytest.raises(Exception, match="not int"):
        append_table(frame("Id BIGINT, N BIGINT", (9, 1 << 40)), f"{database}.T")


def test_updated_by_exchange(spark, frame, rows, database):
    update_table(frame("Name STRING, Value STRING", ("y", "9"), ("z", "3")), f"{database}.S", "Name")
    assert rows(spark.table(f"{database}.S")) == [("x", "1", "n"), ("y", "9", "m"), ("z", "3", None)]
    assert {t.name for t in spark.catalog.listTables(database)} == {"t", "s"}
    with pytest.raises(ValueError, match="repeat"):
        update_table(frame("Name STRING, Value STRING", ("y", "9"), ("y", "3")), f"{database}.S", "Name")


def test_an_exchange_that_was_cut_off(spark, frame, rows, database):
    spark.sql(f"ALTER TABLE {database}.S RENAME TO {database}.S_aside")
    app = App.catalog(spark, "dst", database)
    assert rows(app.table("S")) == [("x", "1", "n"), ("y", "2", "m")]


def test_merge_is_asked_for_first(spark, frame, database, monkeypatch):
    said = []
    monkeypatch.setattr(catalog, "_merge", lambda spark, table, view, columns, key: said.append((table, tuple(columns), key)))
    update_table(frame("Name STRING, Value STRING", ("y", "9")), f"{database}.S", "Name")
    assert said == [(f"{database}.S", ("Name", "Value"), "Name")]


def test_names_are_quoted():
    assert quoted("a.b`c") == "`a`.`b``c`"
