"""One large array cut by byte ranges gives what the parser of whole arrays gives."""

from __future__ import annotations

import json
import random

import pytest

from musterline.errors import PayloadError
from musterline.sources import json_arrays, payloads

TEXTS = ["plain", 'quo"te', "brace } { [ ] ,", "back\\slash", 'end\\"', "}{", "é中🎉", "", "new\nline", '\\\\"}],[{"', "\\"]


def user(rng, i):
    made = {"id": str(i), "name": rng.choice(TEXTS), "company": {"name": rng.choice(TEXTS), "bs": rng.choice(TEXTS)}}
    if rng.random() < 0.3:
        made["address"] = {"geo": {"lat": "1", "lng": rng.choice(TEXTS)}, "street": "x" * rng.randrange(300)}
    if rng.random() < 0.2:
        made["more"] = [[{"a": []}, "]"], {"b": {}}]
    return made


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def shown(df):
    return sorted((json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect()))


def test_arrays_equal_those_read_whole(spark, tmp_path, small_blocks):
    rng = random.Random(6)
    for name, n, indent in (("a", 120, None), ("b", 60, 2), ("empty", 0, None), ("one", 1, 1)):
        text = json.dumps([user(rng, i) for i in range(n)], indent=indent, ensure_ascii=n == 60)
        (tmp_path / f"{name}.json").write_text(f" {text}\n")
    expected = payloads.read_payloads(spark, str(tmp_path))
    found = json_arrays.read_large_arrays(spark, str(tmp_path))
    assert shown(found) == shown(expected)
    # Many tasks read the one array, and places ascend as in the file.
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json"))
    assert pieces.rdd.getNumPartitions() > 10
    placed = json_arrays.read_large_arrays(spark, str(tmp_path / "a.json"), place="p")
    assert [r["id"] for r in placed.orderBy("p").collect()] == [str(i) for i in range(120)]


BAD = [
    '{"id": "1"}', '[{"id": "1"}', '[{"id": "1"}]]', '[{"id": "1"} {"id": "2"}]', '[{"id": "1}]', '[{"id": 1},]', "nothing",
    '[{"id": "1"}] more', "[1, 2]", '[{"id": "1"}, 5]', '[5, {"id": "1"}]', "\n", '[{"id": "1"}, {"id" "2"}]',
]


def test_what_is_no_array_of_objects_is_told(spark, tmp_path):
    for i, text in enumerate(BAD):
        (tmp_path / f"bad{i}.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"id": "7"}, {"id": "8"}]')
    _, corrupt = json_arrays.array_elements(spark, str(tmp_path))
    names = sorted(r["file"].rsplit("/", 1)[1] for r in corrupt.collect())
    assert names == sorted(f"bad{i}.json" for i in range(len(BAD)))
    with pytest.raises(PayloadError, match="bad"):
        json_arrays.read_large_arrays(spark, str(tmp_path))
    kept = json_arrays.read_large_arrays(spark, str(tmp_path), on_corrupt="quarantine")
    assert sorted(r["id"] for r in kept.collect()) == ["7", "8"]
