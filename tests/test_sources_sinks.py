import json
import os
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.session import materialize
from statmart.sinks import export, tables
from statmart.sources import csv_files, json_docs
from statmart.streaming import incremental
from tests.conftest import rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_mixed_headers_match_by_name(spark, tmp_dir):
    _write(f"{tmp_dir}/a/1.csv", "name,mins\nx,90\ny,45\n")
    _write(f"{tmp_dir}/b/2.csv", "\nname,starts,mins\nz,1,180\n")
    df = csv_files.read_csv_files(spark, f"{tmp_dir}/*/*.csv", {"mins": T.IntegerType()})
    got = sorted(rows(df, "name", "starts", "mins"))
    assert got == [("x", None, 90), ("y", None, 45), ("z", "1", 180)]
    assert df.columns[0] == "mins"
    good, bad = csv_files.write_bronze(df, f"{tmp_dir}/bronze")
    assert good.count() == 3 and bad.count() == 0


def test_bad_field_is_quarantined(spark, tmp_dir):
    _write(f"{tmp_dir}/f.csv", "id,v\n1,2.5\nx,3\n")
    raw = csv_files.read_csv_files(spark, f"{tmp_dir}/f.csv",
                                   {"id": T.IntegerType(), "v": T.DoubleType()})
    good, bad = csv_files.split_quarantine(raw)
    assert rows(good, "id", "v") == [(1, 2.5)]
    assert [r._corrupt for r in bad.collect()] == ["x,3"]
    good, bad = csv_files.write_bronze(raw, f"{tmp_dir}/bronze")
    assert rows(good, "id", "v") == [(1, 2.5)]
    assert bad.count() == 1 and rows(bad, "_corrupt") == [("x,3",)]


def test_header_parse_quotes_and_repeats():
    assert csv_files.parse_header('a,"b,c",a') == ["a", "b,c", "a.1"]


def test_families_and_path_keys(spark, tmp_dir):
    _write(f"{tmp_dir}/data/2023-24/gws/gw1.csv", "id,pts\n1,3\n")
    _write(f"{tmp_dir}/data/2022-23/gws/gw1.csv", "id,pts\n2,4\n")
    _write(f"{tmp_dir}/data/2022-23/gws/readme.txt", "not a table\n")
    _write(f"{tmp_dir}/data/2023-24/players/Añe-x 1/gw.csv", "round,pts\n1,7\n")
    _write(f"{tmp_dir}/data/2023-24/players/Añe_x 1/gw.csv", "round,pts\n1,8\n")
    _write(f"{tmp_dir}/data/2023-24/understat/Bo_B.1.csv", "date,xg\n2023-08-01,0.4\n")
    gw = csv_files.read_family(spark, tmp_dir, "gw", schema={"id": T.LongType()})
    assert sorted(rows(gw, "id", "season", "table_name")) == [
        (1, "2023-24", "gw_2023_24_gw1"), (2, "2022-23", "gw_2022_23_gw1")]
    only = csv_files.read_family(spark, tmp_dir, "gw", seasons=["2022-23"])
    assert rows(only, "season") == [("2022-23",)]
    pl = csv_files.read_family(spark, tmp_dir, "players")
    assert {r.table_name for r in pl.collect()} == {"player_2023_24_A_e_x_1"}
    first = csv_files.first_file_per_table(pl, "players")
    assert rows(first, "pts") == [("7",)]
    us = csv_files.read_family(spark, tmp_dir, "understat")
    assert rows(us, "table_name", "entity") == [("understat_2023_24_Bo_B", "Bo_B")]
    with pytest.raises(ValueError):
        csv_files.family_glob(tmp_dir, "fixtures")


def test_first_files_open_no_loser(spark, tmp_dir, monkeypatch):
    from statmart.sources import first_files
    for k, name in enumerate(["b-1", "b_1", "c", "d.x", "d.y"]):
        _write(f"{tmp_dir}/data/2023-24/gws/{name}.csv", f"id,v{k}\n{k},{k}\n")
    _write(f"{tmp_dir}/data/2022-23/gws/b_1.csv", "id\n9\n")
    _write(f"{tmp_dir}/data/2023-24/gws/a-1.csv", "")
    _write(f"{tmp_dir}/data/2023-24/gws/a_1.csv", "id\n8\n")
    opened = []
    read = first_files.read_csv_files
    monkeypatch.setattr(first_files, "read_csv_files", lambda s, paths, *a: opened.extend(paths) or read(s, paths, *a))
    every = csv_files.read_family(spark, tmp_dir, "gw", schema={"id": T.LongType()})
    for size in (10_000, 2):  # one slice, several
        opened.clear()
        found = first_files.read_first_files(spark, tmp_dir, "gw", schema={"id": T.LongType()}, slice_files=size)
        assert sorted(rows(found, "id", "table_name")) == sorted(
            rows(csv_files.first_file_per_table(every, "gw"), "id", "table_name"))
        assert sorted(p.split("/data/")[1] for p in opened) == [
            "2022-23/gws/b_1.csv", "2023-24/gws/a_1.csv", "2023-24/gws/b-1.csv", "2023-24/gws/c.csv", "2023-24/gws/d.x.csv"]
    assert first_files.read_first_files(spark, f"{tmp_dir}/none", "gw", schema=T.StructType(
        [T.StructField("id", T.LongType())])).count() == 0


def test_snapshot_document_multiline(spark, tmp_dir):
    doc = {"elements": [{"id": 1, "web_name": "A", "form": "1.5"}, {"id": 2, "web_name": "B"}],
           "teams": [{"id": 1, "name": "Arsenal"}]}
    _write(f"{tmp_dir}/snap.json", json.dumps(doc, indent=2))
    docs = json_docs.read_documents(spark, f"{tmp_dir}/snap.json", multi_line=True)
    els = json_docs.explode_records(docs, "elements")
    assert sorted(rows(els, "id", "web_name", "form")) == [(1, "A", "1.5"), (2, "B", None)]
    assert rows(json_docs.explode_records(docs, "teams"), "name") == [("Arsenal",)]


def test_write_once_replace_and_log(spark, tmp_dir):
    db = "t_sinks"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    v1 = spark.createDataFrame([(1, "a")], "id long, v string")
    v2 = spark.createDataFrame([(2, "b"), (3, "c")], "id long, v string")
    assert tables.create_table_once(v1, f"{db}.gw-2023") is True
    assert tables.create_table_once(v2, f"{db}.gw-2023") is False
    assert tables.table_exists(spark, f"{db}.gw_2023")
    assert rows(spark.table(f"{db}.gw_2023")) == [(1, "a")]
    assert tables.replace_table(v2, f"{db}.players")
    assert not tables.replace_table(v2.where("id < 0"), f"{db}.players")
    assert sorted(rows(spark.table(f"{db}.players"))) == [(2, "b"), (3, "c")]
    written = tables.load_snapshot(spark, {f"{db}.players": v1, f"{db}.teams": v2.limit(0)},
                                   f"{db}.snapshot_metadata")
    assert written == [f"{db}.players"]
    log = spark.table(f"{db}.snapshot_metadata").collect()
    assert [r.tables_updated for r in log] == ['["players"]'] and log[0].snapshot_time is not None


def test_csv_export_quoting(spark, tmp_dir):
    df = spark.createDataFrame([('q"r,s', None, True)], "a string, b double, c boolean")
    path = export.export_csv(df, f"{tmp_dir}/out", single_file=True)
    part = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(part) == 1
    with open(f"{path}/{part[0]}", encoding="utf-8") as f:
        assert f.read().splitlines() == ["a,b,c", '"q""r,s",,True']


def test_incremental_ingest_twice_is_once(spark, tmp_dir):
    _write(f"{tmp_dir}/land/w1/a.csv", "id,v\n1,x\n2,y\n")
    target, ckpt = f"{tmp_dir}/target", f"{tmp_dir}/ckpt"
    schema = {"id": T.LongType()}
    incremental.stream_ingest(spark, f"{tmp_dir}/land/*", target, ckpt, schema)
    incremental.stream_ingest(spark, f"{tmp_dir}/land/*", target, ckpt, schema)
    _write(f"{tmp_dir}/land/w2/b.csv", "v,id\nz,3\n")
    incremental.stream_ingest(spark, f"{tmp_dir}/land/*", target, ckpt, schema)
    got = incremental.read_target(spark, target)
    assert sorted(rows(got, "id", "v")) == [(1, "x"), (2, "y"), (3, "z")]
    # batch twin over the same files: loads each once however often it runs
    t2 = f"{tmp_dir}/target2"
    assert incremental.batch_ingest(spark, f"{tmp_dir}/land/*", t2, schema) == 2
    assert incremental.batch_ingest(spark, f"{tmp_dir}/land/*", t2, schema) == 0
    assert sorted(rows(incremental.read_target(spark, t2), "id", "v")) == [
        (1, "x"), (2, "y"), (3, "z")]
    assert incremental.read_target(spark, t2).select(F.countDistinct("source_file")).first()[0] == 2


def test_ingest_puts_unparsed_rows_aside(spark, tmp_dir):
    _write(f"{tmp_dir}/land/w1/a.csv", "id,v\n1,x\nbad,y\n")
    _write(f"{tmp_dir}/land/w1/b.csv", "id,v\nworse,z\n")
    t, schema = f"{tmp_dir}/target", {"id": T.LongType()}
    assert incremental.batch_ingest(spark, f"{tmp_dir}/land/*", t, schema) == 2
    assert incremental.batch_ingest(spark, f"{tmp_dir}/land/*", t, schema) == 0  # a file of bad rows only is loaded too
    good = incremental.read_target(spark, t)
    assert "_corrupt" not in good.columns and rows(good, "id", "v") == [(1, "x")]
    assert sorted(r._corrupt for r in incremental.read_quarantine(spark, t).collect()) == ["bad,y", "worse,z"]


def test_file_names_with_glob_characters(spark, tmp_dir):
    _write(f"{tmp_dir}/land/w/a[1] {{x}}.csv", "id,v\n7,q\n")
    _write(f"{tmp_dir}/land/w/a1 x.csv", "id,v\n8,r\n")
    t = f"{tmp_dir}/target"
    assert incremental.batch_ingest(spark, f"{tmp_dir}/land/*", t, {"id": T.LongType()}) == 2
    got = incremental.read_target(spark, t)
    assert sorted(rows(got, "id", "v")) == [(7, "q"), (8, "r")]
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in got.collect()) == [
        "a1 x.csv", "a[1] {x}.csv"]


def test_replace_partitioned_and_empty(spark, tmp_dir):
    db = "t_sinks_part"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    v = spark.createDataFrame([(1, "2023-24"), (2, "2022-23")], "id long, season string")
    assert tables.replace_table(v, f"{db}.gw", partition_by=["season"])
    assert not tables.replace_table(v.where("id < 0"), f"{db}.gw", partition_by=["season"])
    got = spark.table(f"{db}.gw")
    assert sorted(rows(got, "id", "season")) == [(1, "2023-24"), (2, "2022-23")]
    assert rows(got.where("season = '2022-23'"), "id") == [(2,)]


def test_missing_season_reads_as_empty(spark, tmp_dir):
    _write(f"{tmp_dir}/data/2023-24/gws/gw1.csv", "id,pts\n1,3\n")
    with pytest.warns(UserWarning):
        df = csv_files.read_family(spark, tmp_dir, "gw", seasons=["2019-20"],
                                   schema={"id": T.LongType()})
    assert df.count() == 0 and "id" in df.columns and "season" in df.columns


def test_rerun_of_a_batch_writes_once(spark, tmp_dir):
    _write(f"{tmp_dir}/land/a.csv", "id,v\n1,x\n2,y\n")
    target = f"{tmp_dir}/target"
    paths = [f"file:{tmp_dir}/land/a.csv"]
    incremental.write_batch(spark, paths, 0, target, {"id": T.LongType()})
    incremental.write_batch(spark, paths, 0, target, {"id": T.LongType()})  # replayed batch
    assert sorted(rows(incremental.read_target(spark, target), "id", "v")) == [(1, "x"), (2, "y")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.permutations(["a", "b", "c", "d"]).flatmap(
    lambda cols: st.integers(1, 4).map(lambda k: cols[:k])), min_size=1, max_size=4))
def test_headers_in_any_order_match_by_name(spark, headers):
    import tempfile
    root = tempfile.mkdtemp(prefix="statmart-hdr-", dir="/tmp")
    expected = []
    for i, cols in enumerate(headers):
        vals = {c: f"{c}{i}" for c in cols}
        _write(f"{root}/f{i}.csv", ",".join(cols) + "\n" + ",".join(vals[c] for c in cols) + "\n")
        expected.append(tuple(vals.get(c) for c in "abcd"))
    df = csv_files.read_csv_files(spark, f"{root}/*.csv")
    for c in "abcd":
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    assert sorted(rows(df, "a", "b", "c", "d"), key=repr) == sorted(expected, key=repr)


def test_replace_a_table_from_itself(spark, tmp_dir):
    db = "t_sinks_self"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    name = f"{db}.players"
    assert tables.replace_table(spark.createDataFrame([(1, 10)], "id long, pts int"), name)
    assert tables.replace_table(spark.table(name).withColumn("pts", F.col("pts") * 2), name)
    assert rows(spark.table(name)) == [(1, 20)]


def test_replacing_a_managed_table_keeps_its_rows(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sm_replace_managed")
    try:
        from statmart.sinks.tables import create_table_once, replace_table

        name = "sm_replace_managed.t"
        create_table_once(spark.range(5), name)
        assert replace_table(spark.range(7), name) and spark.table(name).count() == 7
        assert replace_table(spark.table(name).where("id > 2"), name) and spark.table(name).count() == 4
        assert not replace_table(spark.range(0), name) and spark.table(name).count() == 4
    finally:
        spark.sql("DROP DATABASE sm_replace_managed CASCADE")


def test_quoted_csv_fields(spark, tmp_dir):
    from statmart.sources.csv_files import read_csv_files

    with open(f"{tmp_dir}/q.csv", "w") as f:
        f.write('id,name,n\n1,"say ""hi"", ok",5\n2,"""q""",6\n')
    got = sorted((r.id, r.name, r.n) for r in read_csv_files(spark, f"{tmp_dir}/q.csv").collect())
    assert got == [("1", 'say "hi", ok', "5"), ("2", '"q"', "6")]


def test_readers_never_miss_a_table_that_is_replaced(spark, tmp_dir):
    import threading

    db = "t_sinks_readers"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    name, seen, failed, stop = f"{db}.players", set(), [], threading.Event()
    tables.replace_table(spark.range(1), name)

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(2, 12):
            columns = ["id"] if n % 2 else ["id", F.lit(n).alias("more")]  # the schema changes as well
            assert tables.replace_table(spark.range(n).select(*columns), name, keep_versions=6)
    finally:
        stop.set()
        reader.join()
    assert not failed and seen <= set(range(1, 12)) and len(seen) > 1
    assert len(tables.versions(spark, name)) == 6 and spark.table(name).columns == ["id"]


@pytest.mark.parametrize("step", ["_write_version", "_point_to"])
def test_a_replace_that_dies_leaves_the_table(spark, tmp_dir, monkeypatch, step):
    db = "t_sinks_dies" + step
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    name = f"{db}.players"
    tables.replace_table(spark.range(3), name)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tables, step, die)
        with pytest.raises(KeyboardInterrupt):
            tables.replace_table(spark.range(5), name)
    assert spark.table(name).count() == 3
    assert tables.replace_table(spark.range(7), name, keep_versions=1)
    assert spark.table(name).count() == 7 and len(tables.versions(spark, name)) == 1


def test_versions_under_a_path_are_removed_with_their_files(spark, tmp_dir):
    db = "t_sinks_path"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    for n in (2, 3, 4):
        assert tables.replace_table(spark.range(n).withColumn("k", F.col("id") % 2), f"{db}.t", f"{tmp_dir}/files",
                                    partition_by=["k"], bucket_by=(2, "id"), keep_versions=2)
    assert spark.table(f"{db}.t").count() == 4 and len(os.listdir(f"{tmp_dir}/files")) == 2
    assert not tables.replace_table(spark.range(0).withColumn("k", F.col("id")), f"{db}.t", f"{tmp_dir}/files", partition_by=["k"])
    assert len(os.listdir(f"{tmp_dir}/files")) == 2
    with pytest.raises(ValueError):
        tables.replace_table(spark.range(1), f"{db}.t", keep_versions=0)


def test_a_plain_table_becomes_a_version(spark, tmp_dir):
    db = "t_sinks_plain"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    spark.range(3).write.saveAsTable(f"{db}.t")
    assert tables.replace_table(spark.table(f"{db}.t").where("id > 0"), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 2 and len(tables.versions(spark, f"{db}.t")) == 2


def test_materialize_leaves_no_shuffle_files(spark):
    def shuffles():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        files = env.blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffles(), spark.conf.get(key)
    made = materialize(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").agg(F.count("*").alias("n")), "shuffled")
    deadline = time.time() + 20
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(key) == setting
    assert sorted(map(tuple, made.collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]
