"""One JSON document split over many tasks, against Python's own JSON reader."""

import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from statmart.plans.landing import document_lines, land_document
from statmart.sources import json_split
from statmart.sources.json_split import read_records, record_texts

NASTY = ["", "}", "{", '"', "\\", '\\"', '": [', "]}", "[{", "a}b{c", "é}", "\n", "{}}", "\\\\}"]


@pytest.fixture()
def small_blocks(spark):
    """Files are split about every thousand bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "997", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _value(rng, depth=0):
    kind = rng.random()
    if kind < 0.5 or depth > 2:
        return rng.choice([rng.choice(NASTY) + rng.choice(NASTY), rng.randint(-9, 99), None, True, 0.5])
    if kind < 0.75:
        return [_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["a", "b", "c}", 'd": [']): _value(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def _document(seed):
    rng = random.Random(seed)
    records = [{"id": i} | {k: _value(rng) for k in rng.sample(["x", "y}", "z"], rng.randint(0, 3))} for i in range(60)]
    return {"total": 3, "events": [], "tags": [rng.choice(NASTY) for _ in range(9)],
            "settings": {"x": {"y": 1}, "z": {"q": [{"id": -1}, {"id": -2}], "elements": [{"id": -3}]}},
            "elements": records, "mixed": [1, {"id": 1}, [[{"id": -4}], 2], {}, None, "}", {"id": 2}],
            "big": [{"id": 1, "text": "x}" * 900, "list": [{"n": n} for n in range(150)]}, {"id": 2}],
            "teams": [{"id": 100 + i, "name": rng.choice(NASTY)} for i in range(20)], "last": {"id": -5}}


def _expected(doc):
    return sorted((name, json.dumps(r, sort_keys=True)) for name, value in doc.items() if isinstance(value, list)
                  for r in value if isinstance(r, dict))


def _found(spark, path):
    return sorted((r["name"], json.dumps(json.loads(r["text"]), sort_keys=True)) for r in record_texts(spark, path).collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_split_document_equals_json_reader(spark, tmp_dir, small_blocks, indent):
    docs = [_document(seed) for seed in range(3)]
    for k, doc in enumerate(docs):
        pathlib.Path(f"{tmp_dir}/d{k}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=k % 2 == 0) + "\n" * (k % 3))
    assert spark.read.text(tmp_dir, lineSep="}").rdd.getNumPartitions() > 20
    assert _found(spark, tmp_dir) == sorted(r for doc in docs for r in _expected(doc))


def test_documents_one_after_another_and_empty(spark, tmp_dir, small_blocks):
    docs = [_document(seed) for seed in (7, 8)] + [{}, {"elements": []}]
    pathlib.Path(f"{tmp_dir}/lines.json").write_text("\n".join(json.dumps(d) for d in docs))
    pathlib.Path(f"{tmp_dir}/empty.json").write_text("")
    assert _found(spark, tmp_dir) == sorted(r for doc in docs for r in _expected(doc))


def test_rows_and_absent_keys(spark, tmp_dir, small_blocks):
    doc = {"elements": [{"id": i, "name": f"n}}{i}"} if i % 3 else {"id": i} for i in range(200)], "teams": []}
    pathlib.Path(f"{tmp_dir}/d.json").write_text(json.dumps(doc))
    schema = spark.createDataFrame([], "id long, name string").schema
    found = read_records(spark, f"{tmp_dir}/d.json", {"elements": schema, "teams": schema})
    assert found["teams"].count() == 0
    assert sorted(map(tuple, found["elements"].collect())) == [(r["id"], r.get("name")) for r in doc["elements"]]


def test_truncated_document_raises(spark, tmp_dir, small_blocks):
    text = json.dumps(_document(1))
    pathlib.Path(f"{tmp_dir}/d.json").write_text(text[: len(text) // 2])
    with pytest.raises(ValueError, match="end before they close"):
        record_texts(spark, tmp_dir)


def test_long_strings_and_lists_need_no_recursion(spark, tmp_dir):
    doc = {"names": ["a b" for _ in range(200_000)], "elements": [{"id": 1, "t": '\\"' * 200_000}, {"id": 2}]}
    pathlib.Path(f"{tmp_dir}/d.json").write_text(json.dumps(doc))
    assert _found(spark, tmp_dir) == _expected(doc)
    assert record_texts(spark, tmp_dir).agg(F.max(F.length("text"))).first()[0] > 800_000


def test_blocks_have_a_bounded_number_of_pieces_and_a_task_each(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(json_split, "_BLOCK_PIECES", 5)
    docs = [_document(seed) for seed in range(2)]
    for k, doc in enumerate(docs):
        pathlib.Path(f"{tmp_dir}/d{k}.json").write_text(json.dumps(doc))
    pieces = json_split._pieces(spark, tmp_dir)
    sizes = [r["count"] for r in pieces.groupBy("source_file", "_start").count().collect()]
    assert max(sizes) <= 32 and len(sizes) > 20
    assert pieces.rdd.getNumPartitions() >= len(sizes)
    assert _found(spark, tmp_dir) == sorted(r for doc in docs for r in _expected(doc))


def test_landed_document_is_not_sorted_in_its_one_task(spark, tmp_dir):
    many = spark.range(40_000).selectExpr("id", "if(id % 7 = 0, null, concat('n}\"', id)) as name")
    arrays = {"elements": many, "none": many.where("id < 0"), "teams": many.where("id < 3").union(many.where("id < 3"))}
    plan = document_lines(arrays)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan
    land_document(spark, arrays, f"{tmp_dir}/doc")
    (file,) = pathlib.Path(f"{tmp_dir}/doc").glob("part-*")
    doc = json.loads(file.read_text())
    assert list(doc) == ["elements", "none", "teams"] and doc["none"] == []
    for name in ("elements", "teams"):
        want = [{k: v for k, v in r.asDict().items() if v is not None} for r in arrays[name].collect()]
        assert sorted(map(json.dumps, doc[name])) == sorted(map(json.dumps, want))
