"""One JSON document read by many tasks equals the whole-document read."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import schemas
from weir.operators.logs import flatten_user_elements, flatten_users
from weir.sources.files import read_json_documents
from weir.sources.json_array import read_array_elements

ODD = ['a"b', "back\\slash\\", '\\"', "}{][", '"users": [{', "é漢字}", "x" * 3000, "", "\\\\", "}" * 50, "line\nbreak"]


def _users(n, seed=1):
    rng = random.Random(seed)
    return [{
        "id": f"u{i}", "profile": {"name": rng.choice(ODD), "username": rng.choice(ODD) + str(i), "ip": f"10.0.0.{i}", "tz": "UTC",
                                   "locale": "en"},
        "contact": {"email": rng.choice(ODD), "phone": "1"},
        "preferences": {"lang": "fi", "marketing_opt_in": bool(i % 2), "theme": "dark"},
        "devices": [{"ua": rng.choice(ODD), "os": "x"}] * rng.randint(0, 3), "tags": [rng.choice(ODD)] * rng.randint(0, 2),
    } for i in range(n)]


def _document(users, indent, after=True):
    doc = {"generated_at": "now", "meta": {"source": "x}", "users": [{"id": "not one"}], "version": 1}, "others": [{"id": "other"}],
           "users": users}
    if after:
        doc["tail"] = {"users": [{"id": "nor this"}]}
        doc["more"] = [{"id": "x"}, [{"id": "y"}]]
    return json.dumps(doc, ensure_ascii=False, indent=indent)


@pytest.fixture(params=[300, 1 << 13, 1 << 27])
def split_bytes(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(n, None) for n in names]
    for n, v in zip(names, (str(request.param), "0", "1")):
        spark.conf.set(n, v)
    yield request.param
    for n, v in zip(names, before):
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("indent", [None, 2])
def test_equals_multiline(spark, tmp, split_bytes, indent):
    for i, n in enumerate((40, 0, 1)):
        with open(f"{tmp}/users{i}.json", "w", encoding="utf-8") as f:
            f.write(_document(_users(n, i), indent, after=i != 2))
    got = read_array_elements(spark, tmp, "users", schemas.USER_DOC)
    want = flatten_users(read_json_documents(spark, tmp, schemas.USERS_DOCUMENT))
    assert sorted(map(str, flatten_user_elements(got).collect())) == sorted(map(str, want.collect()))
    assert got.count() == 41


def test_one_document_is_read_by_many_tasks(spark, tmp):
    with open(f"{tmp}/users.json", "w", encoding="utf-8") as f:
        f.write(_document(_users(400), 2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pieces = spark.read.option("lineSep", "}").text(f"{tmp}/users.json")
        assert pieces.select(F.col("_metadata.file_block_start")).distinct().count() > 5
        got = read_array_elements(spark, f"{tmp}/users.json", "users", schemas.USER_DOC)
        assert sorted(r[0] for r in got.select("element.id").collect()) == sorted(f"u{i}" for i in range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))


def test_other_element_types(spark, tmp):
    with open(f"{tmp}/a.json", "w") as f:
        f.write('{"rows":[{"a":1},{"a":{"b":2}},{}],"x":"]}"}')
    got = read_array_elements(spark, tmp, "rows", T.StructType([T.StructField("a", T.StringType())]))
    assert sorted(str(r[0]) for r in got.select("element.a").collect()) == ["1", "None", '{"b":2}']
