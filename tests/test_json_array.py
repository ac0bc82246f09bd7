"""A JSON array read in blocks against the parser of one task."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gaugeflow.sources.json_array import read_json_array_blocks
from gaugeflow.sources.records import read_json_array

SCHEMA = "i long, s string, a array<long>, o struct<k: string>"


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _records(n, rng):
    odd = ['"', "\\", '\\"', "}", "]", "[{", ",", "],\n[", "é𐐷", "\\\\", " ", "{\"k\": 1}", "\n", "}" * 90]
    return [{"i": i, "s": "".join(rng.choice(odd) for _ in range(rng.randint(0, 12))), "a": list(range(rng.randint(0, 4))), "o": {"k": rng.choice(odd)}} for i in range(n)]


def _rows(df):
    return sorted(((r["i"], r["s"], tuple(r["a"]) if r["a"] is not None else None, r["o"] and r["o"]["k"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("indent", [None, 0, 2])
def test_equals_the_whole_parser(spark, small_blocks, tmp_path, indent):
    rng = random.Random(indent)
    for f in range(3):
        (tmp_path / f"{f}.json").write_text(("\n " if f else "") + json.dumps(_records(60, rng), indent=indent, ensure_ascii=f == 1) + "\n\n" * f)
    found = read_json_array_blocks(spark, str(tmp_path), SCHEMA)
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    assert _rows(found) == _rows(read_json_array(spark, str(tmp_path), SCHEMA)) and found.count() == 180


def test_a_record_over_many_blocks(spark, small_blocks, tmp_path):
    """Longer than several blocks, with signs that look like borders in its string and nested arrays."""
    big = {"i": 1, "s": '}, {"x": [' * 700, "a": list(range(900)), "o": {"k": "]" * 2000}}
    (tmp_path / "a.json").write_text(json.dumps([{"i": 0}, big, {"i": 2}, big], indent=1))
    rows = _rows(read_json_array_blocks(spark, str(tmp_path), SCHEMA))
    assert rows == _rows(read_json_array(spark, str(tmp_path), SCHEMA)) and [r[0] for r in rows] == [0, 1, 1, 2]


@pytest.mark.parametrize("text,n", [("[]", 0), ("[ \n ]", 0), ('[{"i": 1}]', 1), ('[{},{"i":2}]', 2), ("", 0), ('[{"i": 1},\n{"i": "}"}]', 2)])
def test_small_files(spark, tmp_path, text, n):
    (tmp_path / "a.json").write_text(text)
    assert read_json_array_blocks(spark, str(tmp_path), SCHEMA).count() == n


def test_extra_fields_and_malformed_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"i": 1, "extra": {"x": [1, "}"]}}, {"i": nope}, {"s": "x"}]')
    rows = read_json_array_blocks(spark, str(tmp_path), "i long, s string").orderBy(F.col("i").desc_nulls_last(), "s").collect()
    assert [tuple(r) for r in rows] == [(1, None), (None, None), (None, "x")]
