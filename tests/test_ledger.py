"""Publishing through a ledger: all tables or none, and little rewritten."""

import pytest

from regraft.sources import ledger as ledgers
from regraft.sources.app import App
from regraft.sources.files import Files
from regraft.sources.ledger import Book, Overtaken, unread
from regraft.sources.sinks import in_types_of, read_wide, recovered, replace_parquet, update_parquet


@pytest.fixture
def root(frame, tmp_path):
    where = tmp_path / "target"
    replace_parquet(frame("Id BIGINT, A STRING", (1, "a"), (2, "b")), str(where / "T"))
    replace_parquet(frame("Name STRING, Value STRING", ("x", "1"), ("y", None)), str(where / "S"))
    return str(where)


def test_a_folder_without_a_ledger_is_read_as_it_lies(spark, rows, root):
    assert rows(App.parquet(spark, "t", root).table("T")) == [(1, "a"), (2, "b")]
    with pytest.raises(KeyError, match="no table Z"):
        App.parquet(spark, "t", root).table("Z")


def test_nothing_is_seen_before_the_commit(spark, frame, rows, root):
    before = App.parquet(spark, "t", root)
    fresh = Book(spark, root).begin()
    fresh.append("T", frame("Id BIGINT, B INT", (3, 30)))
    fresh.update("S", frame("Name STRING, Value STRING", ("y", "2"), ("z", "3")), "Name")
    fresh.append("New", frame("Id BIGINT", (9,)))
    assert rows(fresh.read("T"), "Id", "A", "B") == [(1, "a", None), (2, "b", None), (3, None, 30)]
    now = App.parquet(spark, "t", root)
    assert rows(now.table("T")) == [(1, "a"), (2, "b")] and rows(now.table("S")) == [("x", "1"), ("y", None)]
    fresh.commit()
    # who began to read before goes on with the state of then
    assert rows(before.table("T")) == [(1, "a"), (2, "b")] and rows(now.table("T")) == [(1, "a"), (2, "b")]
    after = App.parquet(spark, "t", root)
    assert rows(after.table("T")) == [(1, "a", None), (2, "b", None), (3, None, 30)]
    assert rows(after.table("S")) == [("x", "1"), ("y", "2"), ("z", "3")] and rows(after.table("New")) == [(9,)]


def test_a_publish_that_fails_between_two_tables(spark, frame, rows, root):
    broken = Book(spark, root).begin()
    broken.append("T", frame("Id BIGINT, A STRING", (3, "c")))
    with pytest.raises(Exception, match="not int"):
        broken.append("S", frame("Name STRING, Value STRING", ("n", "v")).selectExpr("Name", "raise_error('not int') AS Value"))
    app = App.parquet(spark, "t", root)
    assert rows(app.table("T")) == [(1, "a"), (2, "b")] and rows(app.table("S")) == [("x", "1"), ("y", None)]
    again = Book(spark, root).begin()
    again.append("T", frame("Id BIGINT, A STRING", (3, "c")))
    again.commit()
    assert rows(App.parquet(spark, "t", root).table("T")) == [(1, "a"), (2, "b"), (3, "c")]
    assert unread(Book(spark, root)) == [broken.name.split("/")[1]]


def test_the_later_of_two_publishes_stops(spark, frame, rows, root):
    one, two = Book(spark, root).begin(), Book(spark, root).begin()
    one.append("T", frame("Id BIGINT, A STRING", (3, "one")))
    two.append("T", frame("Id BIGINT, A STRING", (3, "two")))
    one.commit()
    with pytest.raises(Overtaken):
        two.commit()
    assert rows(App.parquet(spark, "t", root).table("T")) == [(1, "a"), (2, "b"), (3, "one")]


def test_an_update_rewrites_only_ranges_that_hold_a_key(spark, frame, rows, root, monkeypatch):
    monkeypatch.setattr(ledgers, "RANGES", 8)
    book = Book(spark, root)
    first = book.begin()
    first.replace("Big", spark.range(8000).selectExpr("id AS Id", "'v' AS V", "CAST(NULL AS INT) AS N"))
    first.update("Big", frame("Id BIGINT, V STRING", (5, "w")), "Id")
    first.commit()
    cut = book.parts("Big")
    assert len(cut) == 8 and [int(p.low) for p in cut][0] == 0 and int(cut[-1].high) == 7999
    second = book.begin()
    second.append("Big", frame("Id BIGINT, V STRING", (9000, "late")))
    second.update("Big", frame("Id INT, V STRING, More INT", (10, "x", 1), (9000, "later", 2), (20000, "new", 3)), "Id")
    second.commit()
    now = Book(spark, root)
    # the first range and the appended rows; all other files are as they were
    assert len({p.path for p in cut} & {p.path for p in now.parts("Big")}) == 7
    table = now.read("Big")
    assert table.columns == ["Id", "V", "N", "More"] and table.count() == 8002
    assert rows(table.where("V <> 'v'"), "Id", "V") == [(10, "x"), (20000, "new"), (5, "w"), (9000, "later")]
    assert table.schema["Id"].dataType.simpleString() == "bigint"


def test_a_null_key_stays_and_updates_must_not_repeat(spark, frame, rows, root):
    book = Book(spark, root)
    p = book.begin()
    p.replace("S", frame("Name STRING, Value STRING", ("x", "1"), (None, "kept")))
    p.update("S", frame("Name STRING, Value STRING", ("x", "2")), "Name")
    p.update("S", frame("Name STRING, Value STRING", ("a", "3")), "Name")
    p.update("S", frame("Name STRING, Value STRING"), "Name")
    p.update("S", frame("Name STRING, Value STRING", ("x", "2")), "Name")
    assert sorted(rows(p.read("S")), key=str) == [("a", "3"), ("x", "2"), (None, "kept")]
    for wrong in ((("x", "1"), ("x", "2")), ((None, "1"),)):
        with pytest.raises(ValueError, match="repeat or lack"):
            p.update("S", frame("Name STRING, Value STRING", *wrong), "Name")


def test_values_that_do_not_fit_stop_whatever_the_mode(spark, frame, root):
    target = frame("Id BIGINT, N INT, D DATE", (1, 1, None))
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", mode)
        try:
            for wrong in (frame("N BIGINT", (1 << 40,)), frame("D STRING", ("no day",))):
                with pytest.raises(Exception, match="not int|not date"):
                    in_types_of(wrong, target).collect()
            assert in_types_of(frame("N BIGINT, D STRING", (7, "2024-01-02")), target).first().N == 7
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_a_swap_that_fails_puts_the_table_back(spark, frame, rows, root, monkeypatch):
    path, whole = f"{root}/T", Files.rename

    def failing(self, before, after):
        if after == "T" and not before.endswith(".aside"):
            raise OSError("no")
        whole(self, before, after)

    monkeypatch.setattr(Files, "rename", failing)
    with pytest.raises(OSError):
        replace_parquet(frame("Id BIGINT", (5,)), path)
    monkeypatch.undo()
    assert rows(read_wide(spark, path)) == [(1, "a"), (2, "b")]


def test_a_swap_that_was_cut_off_is_recovered(spark, frame, rows, root):
    Files(spark, root).rename("T", "T.aside")
    assert rows(read_wide(spark, f"{root}/T")) == [(1, "a"), (2, "b")]
    Files(spark, root).rename("T", "T.aside")
    replace_parquet(frame("Id BIGINT", (5,)), f"{root}/T")
    assert rows(read_wide(spark, f"{root}/T")) == [(5,)] and Files(spark, root).names() == ["S", "T"]
    recovered(spark, f"{root}/None")


def test_updates_that_repeat_a_key_stop(frame, root):
    with pytest.raises(ValueError, match="repeat"):
        update_parquet(frame("Name STRING, Value STRING", ("x", "1"), ("x", "2")), f"{root}/S", "Name")


def test_a_rename_that_does_nothing_raises(spark, root):
    with pytest.raises(OSError, match="could not"):
        Files(spark, root).rename("None", "Other")
