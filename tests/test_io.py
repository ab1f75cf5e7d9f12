import pytest

from regraft.__main__ import app, arguments, jdbc_options

from regraft.operators.relationship import Relationship
from regraft.sources import relationships as io
from regraft.sources import staging
from regraft.sources.app import App
from regraft.sources.app import even_split
from regraft.sources.sinks import (
    IdsTaken,
    append_parquet,
    in_types_of,
    insert_members,
    overridden,
    read_wide,
    replace_parquet,
    snapshot,
    update_parquet,
)
from regraft.sources.staging import Staging, at_once

PAIRS = "old_id BIGINT, new_id BIGINT"


@pytest.fixture
def rel(frame):
    return Relationship(frame(PAIRS, (1, 11), (70000, 12), (200000, 13)), (0,))


def test_json_round_trip(spark, rel, rows, tmp_path):
    io.write_json(rel, str(tmp_path / "rel"))
    assert rows(io.read_json(spark, str(tmp_path / "rel"), 0).pairs) == [
        (0, 0), (1, 11), (200000, 13), (70000, 12),
    ]


def test_json_of_one_object(spark, rows, tmp_path):
    path = tmp_path / "rel.json"
    path.write_text('{"5": 55, "7": 77}')
    assert rows(io.read_json(spark, str(path)).pairs) == [(5, 55), (7, 77)]


def test_csv_has_the_header(spark, rel, rows, tmp_path):
    path = tmp_path / "csv"
    io.write_csv(rel, str(path))
    lines = [p.read_text().splitlines()[0] for p in path.glob("*.csv")]
    assert set(lines) == {"OldId,NewId"}
    assert rows(io.read_csv(spark, str(path)).pairs) == rows(rel.complete())


def test_json_to_csv(spark, rel, rows, tmp_path):
    io.write_json(rel, str(tmp_path / "j"))
    io.json_to_csv(spark, str(tmp_path / "j"), str(tmp_path / "c"))
    assert rows(io.read_csv(spark, str(tmp_path / "c")).pairs) == rows(rel.complete())


@pytest.mark.parametrize(
    "text",
    ['{"1": 11, "2": 2', '[1, 2]', '{"1": "x"}', '{"1": 1.5}', '{"1": null}', '{"a": 1}', "words"],
)
def test_json_that_cannot_be_read_stops(spark, tmp_path, text):
    path = tmp_path / "rel.json"
    path.write_text(text)
    with pytest.raises(Exception, match="JSON|not an id|MALFORMED"):
        io.read_json(spark, str(path)).pairs.collect()


def test_json_over_lines_and_with_text_values(spark, rows, tmp_path):
    path = tmp_path / "rel.json"
    path.write_text('{\n  "1": 11,\n  "2": "22",\n  "3": 33.0\n}\n{"4": 44}\n')
    assert rows(io.read_json(spark, str(path)).pairs) == [(1, 11), (2, 22), (3, 33), (4, 44)]


def test_csv_by_name_and_with_bad_cells(spark, rows, tmp_path):
    path = tmp_path / "rel.csv"
    path.write_text("NewId,OldId\n11,1\n")
    assert rows(io.read_csv(spark, str(path)).pairs) == [(1, 11)]
    path.write_text("OldId,NewId\n1,x\n")
    with pytest.raises(Exception, match="not bigint"):
        io.read_csv(spark, str(path)).pairs.collect()


def test_append_widens_and_is_repeatable(frame, rows, spark, tmp_path):
    path = str(tmp_path / "t")
    replace_parquet(frame("Id BIGINT, A STRING, N INT", (1, "a", 1)), path)
    new = frame("Id BIGINT, N BIGINT, Extra STRING", (2, 5, "e"), (3, 6, None))
    append_parquet(new, path)
    append_parquet(new, path)
    got = read_wide(spark, path)
    assert rows(got, "Id", "A", "N", "Extra") == [(1, "a", 1, None), (2, None, 5, "e"), (3, None, 6, None)]


def test_append_stops_at_a_foreign_row_under_our_id(frame, rows, spark, tmp_path):
    path = str(tmp_path / "t")
    replace_parquet(frame("Id BIGINT, A STRING", (1, "a"), (10, "theirs")), path)
    with pytest.raises(IdsTaken, match="10"):
        append_parquet(frame("Id BIGINT, A STRING", (9, "b"), (10, "ours")), path)
    assert rows(read_wide(spark, path)) == [(1, "a"), (10, "theirs")]


def test_append_stops_at_values_that_do_not_fit(frame, tmp_path):
    path = str(tmp_path / "t")
    replace_parquet(frame("Id BIGINT, N INT", (1, 1)), path)
    with pytest.raises(Exception, match="OVERFLOW|CAST"):
        append_parquet(frame("Id BIGINT, N BIGINT", (2, 1 << 40)), path)


def test_update_leaves_other_rows_and_columns(frame, rows, spark, tmp_path):
    path = str(tmp_path / "s")
    replace_parquet(frame("Name STRING, Value STRING, Note STRING", ("a", "1", "n"), ("b", "2", "m")), path)
    update_parquet(frame("Name STRING, Value STRING", ("a", "9")), path, "Name")
    assert rows(spark.read.parquet(path)) == [("a", "9", "n"), ("b", "2", "m")]


def test_types(frame, spark):
    target = frame("Id BIGINT, A STRING")
    assert in_types_of(frame("B BIGINT, Id INT", (1, 2)), target).dtypes == [("B", "bigint"), ("Id", "bigint")]


def test_command_line_takes_both_kinds_of_sides(spark, tmp_path):
    (tmp_path / "p").write_text("# login\nuser = me\npassword=a=b\n")
    given = f"--source jdbc:x:y --source-properties {tmp_path}/p --target {tmp_path} --run r --next-ids Contact=70".split()
    args = arguments(given)
    assert jdbc_options(args.source, args.source_properties) == {"url": "jdbc:x:y", "user": "me", "password": "a=b"}
    assert app(spark, args, "source").place == "jdbc:x:y"
    replace_parquet(spark.range(1).selectExpr("id AS Id"), str(tmp_path / "Contact"))
    assert spark.range(1).select(app(spark, args, "target").next_id("Contact")).first()[0] == 70


def test_even_split_covers_the_ids():
    assert even_split(None, None, 8) == {}
    assert even_split(5, 6, 8)["numPartitions"] == "2"
    assert even_split(1, 10**9, 8) == {
        "partitionColumn": "Id", "lowerBound": "1", "upperBound": "1000000001", "numPartitions": "16",
    }


def test_override_by_name_and_strict(frame, rows, tmp_path):
    prepared = frame("Id BIGINT, ContactId BIGINT, Note STRING", (1, 2, "x"))
    path = tmp_path / "o.csv"
    path.write_text("ContactId,Id,Note\n7,8,eight\n")
    assert rows(overridden(prepared, str(path))) == [(8, 7, "eight")]
    for text, said in (("Id,Note\n1,x\n", "lacks"), ("Id,ContactId,Note,Z\n1,2,x,y\n", "unknown")):
        path.write_text(text)
        with pytest.raises(ValueError, match=said):
            overridden(prepared, str(path))
    path.write_text("Id,ContactId,Note\n1,zwei,x\n")
    with pytest.raises(Exception, match="not bigint"):
        overridden(prepared, str(path)).collect()


def test_override_replaces_prepared_rows(frame, rows, tmp_path):
    prepared = frame("Id BIGINT, Note STRING", (1, "x"))
    path = tmp_path / "o.csv"
    path.write_text("Id,Note\n8,eight\n9,\n")
    assert rows(overridden(prepared, None)) == [(1, "x")]
    assert rows(overridden(prepared, str(path))) == [(8, "eight"), (9, None)]


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_snapshot(frame, spark, tmp_path, form):
    path = str(tmp_path / "snap")
    snapshot(frame("Id BIGINT, Note STRING", (1, "x")), path, form)
    back = spark.read.option("header", True).format(form).load(path)
    assert back.columns == ["Id", "Note"] and back.count() == 1


def test_insert_members(frame, rows):
    target = frame("Id BIGINT, C BIGINT", (1, 1))
    staged = frame("Id BIGINT, C BIGINT", (5, 11), (6, 99))
    got = insert_members(target, staged, "C", frame(PAIRS, (1, 11), (2, 11)))
    assert rows(got) == [(1, 1), (5, 11)]


def test_app_reads_parquet_and_prunes(frame, rows, spark, tmp_path):
    replace_parquet(frame("Id BIGINT, A STRING, B STRING", (1, "a", "b"), (2, None, "c")), str(tmp_path / "T"))
    app = App.parquet(spark, "x", str(tmp_path))
    assert app.columns("T") == ["Id", "A", "B"]
    assert app.column_types("T")["A"] == "string"
    pruned = app.table("T", ["Id"])
    assert "ReadSchema: struct<Id:bigint>" in pruned._jdf.queryExecution().executedPlan().toString()
    assert rows(app.count("T", "A <> 'z'")) == [(1,)]
    assert rows(app.count("T")) == [(2,)]
    assert rows(app.appended(T=frame("Id BIGINT", (9,))).count("T")) == [(3,)]
    with pytest.raises(KeyError):
        App.of("y", {}).table("T")


def test_staging_finds_its_tables_again(frame, rows, spark, tmp_path):
    stage = Staging(spark, str(tmp_path / "run"))
    assert not stage.has("a/b")
    kept = stage.keep("a/b", frame("Id BIGINT", (1,)))
    assert rows(kept) == [(1,)] and Staging(spark, str(tmp_path / "run")).has("a/b")


def test_a_half_written_stage_is_not_there(frame, spark, tmp_path):
    stage = Staging(spark, str(tmp_path / "run"))
    stage.write("a/done", frame("kind STRING", ("rel",), ("rows",)))
    (tmp_path / "run" / "a" / "done" / "_SUCCESS").unlink()
    assert not stage.has("a/done")


def test_staging_uses_the_folder_the_session_names(spark):
    named = spark.conf.get(staging.CHECKPOINT_DIR)
    assert Staging(spark).root.startswith(named + "/regraft/")


def test_at_once_keeps_order_and_raises(spark):
    assert at_once([lambda i=i: i for i in range(9)]) == list(range(9))
    with pytest.raises(ZeroDivisionError):
        at_once([lambda: 1 / 0])
