from functools import partial

import pytest
from helpers import d, rows

from candlewick.operators import writes
from candlewick.operators.writes import (
    append_new_only,
    append_to_log,
    delete_insert,
    merge_table,
    newest_stored,
    overwrite_table,
    read_or_empty,
    read_since,
    replace_from,
    replace_slice,
    replace_table,
    upsert,
)

SCHEMA = "k string, day date, v int, seq int"


def test_upsert_last_row_of_a_key_wins(table):
    target = table(SCHEMA, ("a", d("2024-01-01"), 1, 0), ("b", d("2024-01-01"), 2, 0))
    batch = table(SCHEMA, ("a", d("2024-01-01"), 8, 2), ("a", d("2024-01-01"), 9, 1), ("c", d("2024-01-02"), 3, 1))
    once = upsert(target, batch, keys=["k", "day"], order_by="seq")
    assert rows(once, "k", "v") == [("a", 8), ("b", 2), ("c", 3)]
    assert rows(upsert(once, batch, keys=["k", "day"], order_by="seq")) == rows(once)


def test_delete_insert_keeps_repeated_batch_keys(table):
    target = table(SCHEMA, ("a", d("2024-01-01"), 1, 0), ("b", d("2024-01-01"), 2, 0))
    batch = table(SCHEMA, ("a", d("2024-01-01"), 8, 1), ("a", d("2024-01-01"), 9, 2))
    out = delete_insert(target, batch, keys=["k", "day"])
    assert rows(out, "k", "v") == [("a", 8), ("a", 9), ("b", 2)]


def test_append_new_only_returns_the_new_rows_and_then_none(table):
    log = table(SCHEMA, ("a", d("2024-01-01"), 1, 0))
    batch = table(SCHEMA, ("a", d("2024-01-01"), 7, 0), ("b", d("2024-01-01"), 2, 1), ("b", d("2024-01-01"), 3, 0))
    grown, new = append_new_only(log, batch, keys=["k", "day"], order_by="seq")
    assert rows(new, "k", "v") == [("b", 3)]
    assert rows(grown, "k", "v") == [("a", 1), ("b", 3)]
    assert append_new_only(grown, batch, keys=["k", "day"])[1].count() == 0


def test_missing_table_reads_as_empty(spark, tmp_path):
    empty = read_or_empty(spark, str(tmp_path / "none"), SCHEMA)
    assert empty.columns == ["k", "day", "v", "seq"] and empty.count() == 0


def test_merge_table_rewrites_only_months_of_the_batch(spark, table, tmp_path):
    path = str(tmp_path / "t")
    merge = partial(upsert, keys=["k", "day"], order_by="seq")
    first = table(SCHEMA, ("a", d("2024-01-31"), 1, 0), ("a", d("2024-02-01"), 2, 0))
    merge_table(spark, path, first, schema=SCHEMA, month_of="day", merge=merge)
    january = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "month=202401").glob("*.parquet")}
    second = table(SCHEMA, ("a", d("2024-02-01"), 5, 1), ("b", d("2024-03-01"), 3, 0))
    for _ in range(2):  # a repeated batch changes nothing
        merge_table(spark, path, second, schema=SCHEMA, month_of="day", merge=merge)
        stored = read_or_empty(spark, path, SCHEMA)
        assert rows(stored, "k", "day", "v") == [
            ("a", d("2024-01-31"), 1), ("a", d("2024-02-01"), 5), ("b", d("2024-03-01"), 3)
        ]
    assert january == {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "month=202401").glob("*.parquet")}


def test_merge_table_by_date_key(spark, table, tmp_path):
    path, schema = str(tmp_path / "t"), "asset_key bigint, date_key int"
    merge = partial(delete_insert, keys=["asset_key", "date_key"])
    merge_table(spark, path, table(schema, (1, 20240131)), schema=schema, month_of="date_key", merge=merge)
    merge_table(spark, path, table(schema, (1, 20240201)), schema=schema, month_of="date_key", merge=merge)
    assert rows(read_or_empty(spark, path, schema)) == [(1, 20240131), (1, 20240201)]
    assert sorted(p.name for p in (tmp_path / "t").glob("month=*")) == ["month=202401", "month=202402"]


def test_log_append_is_exactly_once(spark, table, tmp_path):
    path, schema = str(tmp_path / "log"), "k string, day date, msg string"
    batch = table(schema, ("a", d("2024-01-01"), "x"), ("a", d("2024-01-01"), "x"), ("b", d("2024-02-01"), "y"))
    args = dict(schema=schema, month_of="day", keys=["k", "day"])
    new = append_to_log(spark, path, batch, **args)
    assert rows(new, "k") == [("a",), ("b",)]
    assert append_to_log(spark, path, batch, **args).count() == 0
    assert rows(new, "k") == [("a",), ("b",)]  # still what it was
    assert rows(read_or_empty(spark, path, schema), "k", "msg") == [("a", "x"), ("b", "y")]


def test_replacing_may_read_what_it_replaces(spark, table, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(table("v int", (1,), (2,)), path)
    replace_table(read_or_empty(spark, path, "v int").filter("v > 1"), path)
    assert rows(read_or_empty(spark, path, "v int")) == [(2,)]


def test_newest_and_recent_rows_of_a_table_by_month(spark, table, tmp_path):
    path = str(tmp_path / "t")
    assert newest_stored(spark, path, SCHEMA, column="day") is None
    assert read_since(spark, path, SCHEMA, date_col="day", since=d("2024-01-01")).count() == 0
    days = ["2023-12-31", "2024-01-31", "2024-02-01", "2024-02-20"]
    overwrite_table(table(SCHEMA, *[("a", d(x), i, 0) for i, x in enumerate(days)]), path, month_of="day")
    assert newest_stored(spark, path, SCHEMA, column="day") == d("2024-02-20")
    recent = read_since(spark, path, SCHEMA, date_col="day", since=d("2024-01-31"))
    assert rows(recent, "v") == [(1,), (2,), (3,)]
    scan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan and "202401" in scan


def test_a_replacement_that_broke_off_is_settled(spark, table, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(table("k int", (1,)), path)
    # died after the new table was written and the old one moved aside
    (tmp_path / "t").rename(tmp_path / "t.old")
    table("k int", (2,)).write.parquet(f"{path}.new")
    assert rows(read_or_empty(spark, path, "k int")) == [(2,)]
    assert not (tmp_path / "t").exists()  # readers change nothing
    replace_table(read_or_empty(spark, path, "k int"), path)
    # died while the new table was being written
    (tmp_path / "t.new").mkdir()
    assert rows(read_or_empty(spark, path, "k int")) == [(2,)]
    overwrite_table(table("k int", (3,)), path)
    assert rows(read_or_empty(spark, path, "k int")) == [(3,)]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]


def test_a_slice_is_replaced_alone(spark, table, tmp_path):
    path, schema = str(tmp_path / "s"), "run string, k int"
    replace_slice(table(schema, ("a/b", 1), ("a/b", 2)), path, run="a/b")
    replace_slice(table(schema, ("c", 3)), path, run="c")
    for _ in range(2):
        replace_slice(table(schema, ("a/b", 4)), path, run="a/b")
    assert rows(read_or_empty(spark, path, schema)) == [("a/b", 4), ("c", 3)]
    replace_slice(table(schema), path, run="c")
    assert rows(read_or_empty(spark, path, schema)) == [("a/b", 4)]


@pytest.mark.parametrize("step", ["before", "change", "half", "all"])
@pytest.mark.parametrize("kind", ["merge", "from", "log"])
def test_a_change_that_broke_off_is_all_or_nothing(spark, table, tmp_path, monkeypatch, kind, step):
    """Killed between any two steps, all months are old or all are new, for readers and for the next writer."""
    path = str(tmp_path / "t")
    days = ["2024-01-31", "2024-02-01", "2024-03-01"]
    overwrite_table(table(SCHEMA, *[("a", d(x), 1, 0) for x in days]), path, month_of="day")
    old = rows(read_or_empty(spark, path, SCHEMA), "k", "day", "v")
    batch = table(SCHEMA, ("a", d("2024-01-31"), 2, 0), ("b", d("2024-02-02"), 3, 0))

    def write():
        if kind == "merge":
            merge_table(spark, path, batch, schema=SCHEMA, month_of="day", merge=partial(upsert, keys=["k", "day"], order_by=None))
        elif kind == "from":
            replace_from(spark, path, batch, month_of="day", since=d("2024-01-31"))
        else:
            append_to_log(spark, path, batch, schema=SCHEMA, month_of="day", keys=["k", "day"])

    new = {
        "merge": [("a", d("2024-01-31"), 2), ("a", d("2024-02-01"), 1), ("a", d("2024-03-01"), 1), ("b", d("2024-02-02"), 3)],
        "from": [("a", d("2024-01-31"), 2), ("b", d("2024-02-02"), 3)],
        "log": sorted([*old, ("b", d("2024-02-02"), 3)]),
    }[kind]
    run, written = writes._write_months, []

    def dying(df, to, *args):
        written.append(to)
        if step == "before" and len(written) == 1:
            raise RuntimeError("killed")  # while the change is stored
        if step in ("change", "half") and len(written) == 2:
            if step == "half":
                run(df.filter("month = '202402'"), to, *args)
            raise RuntimeError("killed")  # while months are put in their place
        run(df, to, *args)

    monkeypatch.setattr(writes, "_write_months", dying)
    if step == "all":
        write()
    else:
        with pytest.raises(RuntimeError):
            write()
    monkeypatch.setattr(writes, "_write_months", run)
    for _ in range(2):
        assert rows(read_or_empty(spark, path, SCHEMA), "k", "day", "v") == (old if step == "before" else new)
    assert newest_stored(spark, path, SCHEMA, column="day") == d("2024-02-02" if kind == "from" and step != "before" else "2024-03-01")
    write()
    assert rows(read_or_empty(spark, path, SCHEMA), "k", "day", "v") == new
    overwrite_table(table(SCHEMA, ("z", d("2024-05-01"), 9, 0)), path, month_of="day")
    assert rows(read_or_empty(spark, path, SCHEMA), "k") == [("z",)]


def test_a_failed_move_is_an_error_and_loses_nothing(spark, table, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(table("k int", (1,)), path)
    fs, at = writes._files(spark, path)
    with pytest.raises(Exception):  # the local file system raises, others return false
        writes._move(fs, at(f"{path}.none"), at(f"{path}.other"))
    with pytest.raises(OSError):
        writes._move(fs, at(path), at(str(tmp_path)))
    assert rows(read_or_empty(spark, path, "k int")) == [(1,)]
