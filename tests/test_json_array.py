"""The split reader of JSON arrays against the one-task reader."""

import json
import os
import random

import pytest

from medalake import schemas
from medalake.plans.landing import land_reviews_batch
from medalake.sources import json_array as A


def records(n, seed=1):
    rnd = random.Random(seed)
    texts = ["plain", "brace } in a string", "},{", '"quoted" \\ backslash\\', "[{", "]}", "é日本\n", "", None,
             "\\", 'ends in a quote "', "{" * 9, "}" * 9]
    return [{"id": str(i), "customer_id": i, "product_id": rnd.choice((None, 7)), "rating": rnd.randrange(6),
             "review_text": rnd.choice(texts), "review_date": "2024-06-01"} for i in range(n)]


def put(root, name, text):
    path = f"{root}/{name}".replace("file:", "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def same(a, b):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


@pytest.mark.parametrize("form", [{}, {"indent": 3}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_many_tasks_read_what_one_task_reads(spark, root, small_splits, form):
    path = put(root, "big file/a.json", json.dumps(records(120), **form))
    whole = spark.read.schema(schemas.REVIEWS).option("multiLine", True).json(path)
    got = A.read_payload_files(spark, path, schemas.REVIEWS)
    assert A.split_starts(spark, path).count() > 15          # one row per split, a task each
    assert got.count() == 120 and same(got, whole)
    assert got.schema == schemas.REVIEWS


def test_records_longer_than_splits_and_nested_values(spark, root, small_splits):
    rows = [{"id": "a", "review_text": "x}" * 2000, "extra": {"n": [{"m": "}"}, {}]}}, {"id": "b"}, {},
            {"id": "c", "extra": [[{"z": 1}]], "review_text": "y" * 1500}]
    path = put(root, "nested.json", "  \n" + json.dumps(rows) + " \n")
    got = A.read_payload_files(spark, path, schemas.REVIEWS)
    whole = spark.read.schema(schemas.REVIEWS).option("multiLine", True).json(path)
    assert got.count() == 4 and same(got, whole)


def test_mixed_payload_of_arrays_lines_and_empty_files(spark, root, small_splits):
    rows = records(60, 3)
    put(root, "mix/a.json", json.dumps(rows[:30]))
    put(root, "mix/b.json", "\n".join(map(json.dumps, rows[30:50])) + "\n")
    put(root, "mix/c.json", json.dumps(rows[50:], indent=1))
    put(root, "mix/d.json", "[]")
    put(root, "mix/e.json", "")
    assert land_reviews_batch(spark, f"{root}/mix", f"{root}/landing", __import__("datetime").datetime(2024, 6, 1)) == 60
    got = spark.read.schema(schemas.REVIEWS).parquet(f"{root}/landing/customer_reviews/load_date=20240601")
    want = spark.createDataFrame([tuple(r.values()) for r in rows], schemas.REVIEWS)
    assert same(got, want)


@pytest.mark.parametrize("text", ['[{"id": "a"}', '[{"id": "a"} {"id": "b"}]', '[1, 2]', '[{"id": "a"}] x',
                                  '[{"id": {"no": "string"}, "rating": "no number"}]'])
def test_malformed_arrays_fail(spark, root, text):
    path = put(root, "bad.json", text)
    with pytest.raises(Exception):
        A.read_payload_files(spark, path, schemas.REVIEWS).collect()


def test_state_of_a_piece():
    assert A.after('[{"a": "x', False, 0) == (True, 2)
    assert A.after('y", "b": 1', True, 2) == (False, 1)
    assert A.after('{"a": "\\\\"', False, 1) == (False, 1)
    assert A.after('{"a": "\\"', False, 1) == (True, 2)
