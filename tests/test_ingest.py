"""Manifest commits, slices, one pass over landed files and type inference."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.sources import csv_files
from statmart.streaming import incremental
from tests.conftest import rows

SCHEMA = {"id": T.LongType()}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_landed_bytes_are_read_once(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "id,v\n1,x\n")
    _write(f"{tmp_dir}/b.csv", "v,w,id\ny,z,2\n")
    df = csv_files.read_csv_files(spark, f"{tmp_dir}/*.csv", SCHEMA, infer=True)
    for name in ("a.csv", "b.csv"):  # nothing reads the landed files again
        os.truncate(f"{tmp_dir}/{name}", 0)
    assert sorted(rows(df, "id", "v", "w")) == [(1, "x", None), (2, "y", "z")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan.lower().replace("from_csv", "").replace(".csv", "")


def test_many_files_keep_their_headers_on_the_cluster(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(csv_files, "HEADERS", 2)
    for i in range(5):
        _write(f"{tmp_dir}/{i}.csv", f"id,{'v' if i % 2 else 'w'}\n{i},t{i}\n")
    got = sorted(rows(csv_files.read_csv_files(spark, f"{tmp_dir}/*.csv", SCHEMA), "id", "v", "w"))
    assert got == [(i, *((f"t{i}", None) if i % 2 else (None, f"t{i}"))) for i in range(5)]


def test_a_line_equal_to_the_header_is_a_row(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "\n \nid,v\nid,v\n1,\n\n")
    df = csv_files.read_csv_files(spark, f"{tmp_dir}/a.csv")
    assert sorted(rows(df, "id", "v"), key=str) == [("1", None), ("id", "v")]


def test_types_are_inferred_from_all_files(spark, tmp_dir):
    head = "whole,broken,day,flag,late,empty,huge,short\n"
    _write(f"{tmp_dir}/1.csv", head + "1,1,2024-01-02,true,1,,1,7\n2,2.5e1,2024-01-02 03:04:05.25,False,2,NA,2,8\n")
    _write(f"{tmp_dir}/2.csv", head + "NaN,inf,2024-01-02T03:04,TRUE,x3,,99999999999999999999,9\nnull,-.5,,true,4,None,,2024-01-01\n")
    df = csv_files.read_csv_files(spark, f"{tmp_dir}/*.csv", infer=True)
    types = dict(df.dtypes)
    assert [types[c] for c in head.strip().split(",")] == [
        "bigint", "double", "timestamp_ntz", "boolean", "string", "string", "double", "string"]
    got = {r.late: r for r in df.collect()}
    assert (got["1"].whole, got["x3"].whole, got["x3"].broken, got["4"].broken) == (1, None, float("inf"), -0.5)
    assert got["4"].day is None and got["2"].day.microsecond == 250000 and got["2"].flag is False
    assert got["1"].empty is None and got["x3"].huge == 1e20 and got["4"].short == "2024-01-01"


def test_rows_of_the_wrong_width_do_not_change_types(spark, tmp_dir):
    _write(f"{tmp_dir}/1.csv", "a,b\n1,2\nx\n3,4\n")
    df = csv_files.read_csv_files(spark, f"{tmp_dir}/1.csv", infer=True)
    assert dict(df.dtypes)["a"] == "bigint" and dict(df.dtypes)["b"] == "bigint"
    assert [r._corrupt for r in df.where("_corrupt is not null").collect()] == ["x"]


@pytest.mark.parametrize("values", [["1", "2"], ["1", "2.5"], ["1", "x"], ["2024-01-01", "1"], ["true", ""], [""], ["1.5", "2024-01-01"]])
def test_kinds_combine_in_any_order(spark, values):
    def kinds(vs):
        return csv_files.infer_types(spark.createDataFrame([(v,) for v in vs], "c string"), ["c"])["c"]

    assert kinds(values) == kinds(values[::-1]) == kinds(values * 3)


def test_empty_and_changed_files(spark, tmp_dir):
    land, target = f"{tmp_dir}/land", f"{tmp_dir}/target"
    _write(f"{land}/a.csv", "id,v\n1,x\n2,y\n")
    _write(f"{land}/empty.csv", "id,v\n")
    _write(f"{land}/blank.csv", "")  # Spark lists no file without a byte
    run = lambda: incremental.batch_ingest(spark, land, target, SCHEMA)
    assert (run(), run()) == (2, 0)
    manifest = {r.source_file.rsplit("/", 1)[1]: r["rows"] for r in incremental.read_manifest(spark, target).collect()}
    assert manifest == {"a.csv": 2, "empty.csv": 0}
    _write(f"{land}/a.csv", "id,v\n1,changed\nbad,q\n")
    assert (run(), run()) == (1, 0)
    assert rows(incremental.read_target(spark, target), "id", "v") == [(1, "changed")]
    assert rows(incremental.read_quarantine(spark, target), "_corrupt") == [("bad,q",)]
    _write(f"{land}/empty.csv", "id,v,w\n3,z,more\n")  # filled later, with a column more
    assert run() == 1
    assert sorted(rows(incremental.read_target(spark, target), "id", "v", "w")) == [(1, "changed", None), (3, "z", "more")]


def test_a_file_of_the_same_size_but_another_time_is_new(spark, tmp_dir):
    _write(f"{tmp_dir}/land/a.csv", "id,v\n1,x\n")
    run = lambda: incremental.batch_ingest(spark, f"{tmp_dir}/land", f"{tmp_dir}/t", SCHEMA)
    assert run() == 1
    time.sleep(0.05)
    _write(f"{tmp_dir}/land/a.csv", "id,v\n1,y\n")
    assert run() == 1 and rows(incremental.read_target(spark, f"{tmp_dir}/t"), "v") == [("y",)]


def test_a_run_that_fails_before_its_commit_leaves_nothing(spark, tmp_dir, monkeypatch):
    land, target = f"{tmp_dir}/land", f"{tmp_dir}/target"
    _write(f"{land}/a.csv", "id,v\n1,x\n")
    assert incremental.batch_ingest(spark, land, target, SCHEMA) == 1
    _write(f"{land}/b.csv", "id,v\n2,y\n")
    with monkeypatch.context() as m:  # rows are written, the manifest is not
        m.setattr(incremental, "_folder", lambda t: 1 / 0 if os.path.isdir(f"{target}/batch=lost-000000") else f"{t}/_manifest")
        with pytest.raises(ZeroDivisionError):
            incremental.batch_ingest(spark, land, target, SCHEMA, run_id="lost")
    assert os.path.isdir(f"{target}/batch=lost-000000")
    assert rows(incremental.read_target(spark, target), "id") == [(1,)]
    assert incremental.batch_ingest(spark, land, target, SCHEMA) == 1
    assert sorted(rows(incremental.read_target(spark, target), "id")) == [(1,), (2,)]


def test_slices_are_commits_of_their_own(spark, tmp_dir):
    land, target = f"{tmp_dir}/land", f"{tmp_dir}/target"
    for i in range(12):
        _write(f"{land}/{i}.csv", f"id,v\n{i},x\n")
    assert incremental.batch_ingest(spark, land, target, SCHEMA, slice_files=5) == 12
    manifest = incremental.read_manifest(spark, target)
    assert 1 < manifest.select("batch").distinct().count() <= 3 and manifest.count() == 12
    assert sorted(r.id for r in incremental.read_target(spark, target).collect()) == list(range(12))


def test_a_long_listing_comes_in_bounded_slices(spark):
    listed = spark.range(100_000).select(
        F.concat(F.lit("file:/landing/some/long/folder/part-"), F.col("id").cast("string")).alias("source_file"),
        F.lit(1).cast("long").alias("size"), F.current_timestamp().alias("modified"))
    seen, most = 0, 0
    for part in incremental.slices(listed, 4_000):
        seen, most = seen + len(part), max(most, len(part))
    assert seen == 100_000 and most < 4_600


def test_a_run_reads_the_manifest_and_not_the_target(spark, tmp_dir):
    land, target = f"{tmp_dir}/land", f"{tmp_dir}/target"
    _write(f"{land}/a.csv", "id,v\n1,x\n")
    incremental.batch_ingest(spark, land, target, SCHEMA)
    plan = incremental.new_files(incremental.list_files(spark, land), incremental.read_manifest(spark, target))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "_manifest" in text and "batch=" not in text and "binaryFile" in text.replace("BinaryFile", "binaryFile")


def test_types_widen_and_narrow_from_commit_to_commit(spark, tmp_dir):
    land, target = f"{tmp_dir}/land", f"{tmp_dir}/target"

    def run(*rows_of_file, name, head="id,a,b"):
        _write(f"{land}/{name}.csv", "\n".join([head, *rows_of_file]) + "\n")
        stamp = time.time() + len(os.listdir(land)) + len(rows_of_file[0]) if rows_of_file else time.time()
        os.utime(f"{land}/{name}.csv", (stamp, stamp))
        incremental.batch_ingest(spark, f"{land}/*", target, SCHEMA, infer=True)
        found = incremental.read_target(spark, target, infer=True)
        types = dict(found.dtypes)
        return found, [types.get(c) for c in ("id", "a", "b", "c")]

    assert run("1,1,true", name="one")[1] == ["bigint", "bigint", "boolean", None]
    assert run("2,NA,", name="two")[1] == ["bigint", "bigint", "boolean", None]
    assert run("3,2.5,false", name="three")[1] == ["bigint", "double", "boolean", None]
    assert run(name="header", head="id,a,b,c")[1] == ["bigint", "double", "boolean", None]
    assert run("4,5", name="narrow")[1] == ["bigint", "double", "boolean", None]  # put aside: no field b
    found, types = run("x5,late,maybe", "5,late,maybe", "6,7,true,2024-01-01", name="wide", head="id,a,b")
    assert types == ["bigint", "string", "string", None]
    found, types = run("5,-1,true,2024-01-01", name="wide", head="id,a,b,c")
    assert types == ["bigint", "double", "boolean", "timestamp_ntz"]
    got = sorted(rows(found.select("id", "a", "b"), "id", "a", "b"))
    assert got == [(1, 1.0, True), (2, None, None), (3, 2.5, False), (5, -1.0, True)]
    # a commit whose kinds weren't noted: nothing is known, so columns stay text
    _write(f"{land}/plain.csv", "id,a,b\n8,1,true\n")
    incremental.batch_ingest(spark, f"{land}/*", target, SCHEMA)
    assert incremental.target_types(spark, target) == {}
    assert dict(incremental.read_target(spark, target, infer=True).dtypes)["a"] == "string"


def test_types_of_commits_equal_those_of_one_read(spark, tmp_dir):
    values = ["1", "2.5", "x", "2024-01-01", "true", "", "99999999999999999999", "inf"]
    for i, v in enumerate(values):
        _write(f"{tmp_dir}/land/{i}.csv", "k,v,w\n" + f"{i},{v},{values[i - 1] if i < 2 else 3}\n")
    incremental.batch_ingest(spark, f"{tmp_dir}/land/*", f"{tmp_dir}/t", slice_files=3, infer=True)
    got = incremental.read_target(spark, f"{tmp_dir}/t", infer=True)
    want = csv_files.read_csv_files(spark, f"{tmp_dir}/land/*.csv", infer=True)
    assert {c: t for c, t in got.dtypes} == {c: t for c, t in want.dtypes if c != "_corrupt"}
    assert sorted(rows(got, "k", "v", "w"), key=str) == sorted(rows(want, "k", "v", "w"), key=str)


def test_streamed_commits_note_kinds(spark, tmp_dir):
    for n, v in enumerate(["1", "2.5"]):
        _write(f"{tmp_dir}/land/{n}.csv", f"v\n{v}\n")
        incremental.stream_ingest(spark, f"{tmp_dir}/land", f"{tmp_dir}/t", f"{tmp_dir}/ckpt", infer=True)
        assert dict(incremental.read_target(spark, f"{tmp_dir}/t", infer=True).dtypes)["v"] == ["bigint", "double"][n]
