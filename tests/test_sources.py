"""Scans and sinks on the literal fixtures."""

import os
import struct

import pytest
from pyspark.sql import functions as F

from gaugeflow import presets
from gaugeflow.plans import clean
from gaugeflow.queries import sources
from gaugeflow.session import scratch_dir
from gaugeflow.sources import delimited, fixed_width, markup, readings, records, text

# --- fixed values: recorded sensor rows ---
SENSOR = """Date;Time;CO(GT);PT08.S1(CO);NMHC(GT);C6H6(GT);PT08.S2(NMHC);NOx(GT);PT08.S3(NOx);NO2(GT);PT08.S4(NO2);PT08.S5(O3);T;RH;AH;;
10/03/2004;18.00.00;2,6;1360;150;11,9;1046;166;1056;113;1692;1268;13,6;48,9;0,7578;;
10/03/2004;19.00.00;2;1292;112;9,4;955;103;1174;92;1559;972;13,3;47,7;0,7255;;
11/03/2004;00.00.00;1,2;1185;-200;3,6;690;62;1462;77;1333;733;11,3;56,8;0,7603;;
11/03/2004;10.00.00;-200;1010;-200;1,7;561;-200;1705;-200;1235;501;10,3;60,2;0,7517;;
;;;;;;;;;;;;;;;;
"""


@pytest.fixture
def sensor(tmp_path):
    path = tmp_path / "sensor.csv"
    path.write_text(SENSOR)
    return str(path)


def test_wrong_separator_fails(spark, sensor):
    with pytest.raises(ValueError, match="not found"):
        delimited.read_delimited(spark, sensor, ",", expected=["Time"])


def test_unnamed_columns_are_dropped(spark, sensor):
    raw = delimited.read_delimited(spark, sensor)
    assert len(raw.columns) == 17
    assert len(delimited.read_named_columns(spark, sensor).columns) == 15


@pytest.mark.parametrize("filter_first", [True, False])
def test_clean(spark, sensor, filter_first):
    raw = delimited.read_delimited(spark, sensor, expected=["Time", "CO(GT)"])
    out, profile = clean.clean_readings(raw, filter_first=filter_first)
    got = {r["Time"]: r for r in out.collect()}
    assert ("NMHC_GT" in out.columns) == filter_first and "_c15" not in out.columns
    assert profile.means["CO_GT"] == pytest.approx(5.8 / 3)
    assert [got[f"{h}.00.00"]["Hour"] for h in ("18", "19", "00")] == [18, 19, 0]
    assert [got[f"{h}.00.00"]["IsRushHour"] for h in ("18", "19", "00")] == [1, 1, 0]
    if filter_first:
        assert profile.rows == len(got) == 3
        assert profile.means["NOx_GT"] == pytest.approx(331 / 3)
        assert profile.fractions["NMHC_GT"] == pytest.approx(1 / 3)
    else:
        assert profile.rows == out.count() == 5
        assert profile.fractions["NMHC_GT"] == pytest.approx(3 / 5)
        assert got["10.00.00"]["CO_GT"] == pytest.approx(5.8 / 3)
        assert got["10.00.00"]["NO2_GT"] == pytest.approx(94.0)
        assert got[None]["Hour"] is None and got[None]["IsRushHour"] == 0


def test_clean_without_target_keeps_sentinel_row(spark, sensor):
    raw = delimited.read_delimited(spark, sensor)
    out, profile = clean.clean_readings(raw, target=None, rush_ranges=presets.RUSH_SERVICE)
    got = {r["Time"]: r for r in out.collect()}
    assert profile.fractions["NMHC_GT"] == 0.5 and profile.rows == 4 and "NMHC_GT" not in out.columns
    assert [got[f"{h}.00.00"]["IsRushHour"] for h in ("18", "19", "00", "10")] == [1, 1, 0, 1]
    assert got["10.00.00"]["NOx_GT"] == pytest.approx(331 / 3)


def test_clean_for_exploration_keeps_sparse_columns(spark, sensor):
    numeric = [*presets.SENSOR_RENAMES, "T", "RH", "AH"]
    raw = delimited.read_decimal_comma(spark, sensor, numeric)
    out, missing = clean.clean_for_exploration(raw, numeric)
    assert out.count() == 4 and "NMHC(GT)" in out.columns and "_c15" not in out.columns
    assert missing == {"CO(GT)": 1, "NMHC(GT)": 2, "NOx(GT)": 1, "NO2(GT)": 1}
    assert {r["Time"]: r["is_rush_hour"] for r in out.collect()}["10.00.00"] == 1


PEOPLE = "name string, age int, city string"


def test_people_csv_and_text(spark, tmp_path, rows):
    (tmp_path / "p.csv").write_text("Name,Age,City\nJohn,28,Delhi\nSara,,Mumbai\nMike,35,Bangalore\n")
    (tmp_path / "p.txt").write_text("Name,Age,City\nAlice,25,New York\nBob,,\nCharlie,30,London\n")
    csv = delimited.read_csv(spark, str(tmp_path / "p.csv"), PEOPLE)
    assert rows(csv) == [("John", 28, "Delhi"), ("Mike", 35, "Bangalore"), ("Sara", None, "Mumbai")]
    txt = delimited.read_csv(spark, str(tmp_path / "p.txt"))
    assert rows(txt) == [("Alice", 25, "New York"), ("Bob", None, None), ("Charlie", 30, "London")]


def test_people_json(spark, tmp_path, rows):
    (tmp_path / "p.json").write_text(
        '[\n {"name": "Alice", "age": 25, "city": "New York"},\n {"name": "Bob", "age": null, "city": "Paris"},\n'
        ' {"name": "Charlie", "age": 30, "city": "London"}\n]'
    )
    df = records.read_json_array(spark, str(tmp_path / "p.json"), PEOPLE)
    assert rows(df) == [("Alice", 25, "New York"), ("Bob", None, "Paris"), ("Charlie", 30, "London")]


def test_people_xml(spark, tmp_path, rows):
    (tmp_path / "p.xml").write_text(
        "<people>\n <person>\n  <name>Alice</name>\n  <age>25</age>\n  <city>New York</city>\n </person>\n"
        " <person>\n  <name>Bob</name>\n  <age></age>\n  <city>Paris</city>\n </person>\n</people>"
    )
    df = records.read_xml(spark, str(tmp_path / "p.xml"), "person", "name string, age string, city string")
    assert rows(df) == [("Alice", "25", "New York"), ("Bob", None, "Paris")]


def test_people_html(spark, rows):
    page = (
        "<html>\n<body>\n<table>\n<tr><th>Name</th><th>Age</th><th>City</th></tr>\n<tr><td>John</td><td>28</td><td>Delhi</td></tr>\n"
        "<tr><td>Sara</td><td></td><td>Mumbai &amp; <b>more</b></td></tr>\n</table>\n</body>\n</html>"
    )
    pages = spark.createDataFrame([(1, page), (2, "<p>none</p>")], "id int, html string")
    df = markup.table_rows(pages, "html", ["name", "age", "city"], ["id"])
    assert rows(df) == [(1, 1, "John", "28", "Delhi"), (1, 2, "Sara", "", "Mumbai & more")]


def test_documents_of_varying_shape(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id": "a", "age": 24}\n{"_id": "b", "city": "Delhi"}\nnot json\n')
    df = records.read_documents(spark, str(tmp_path / "d.json"))
    got = df.select(F.try_variant_get("doc", "$._id", "string"), F.try_variant_get("doc", "$.age", "int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 24), ("b", None), (None, None)], key=str)


def test_fixed_width_roundtrip_and_layout(spark, tmp_path):
    values = [10, 20, 30, 40, 50, 60, 70, 80, 0, 255, 256, 4294967295]
    out = str(tmp_path / "numbers")
    fixed_width.write_uint32(spark.createDataFrame([(v,) for v in values], "v long").coalesce(1), "v", out)
    names = [n for n in os.listdir(out) if n.endswith(".bin")]
    raw = b"".join((tmp_path / "numbers" / n).read_bytes() for n in names)
    assert raw == struct.pack("<12I", *values)
    assert not os.listdir(tmp_path / "numbers" / "_temporary")
    for split in (3, 8, 1 << 21):  # a file is cut into batches of so many bytes
        assert [r.value for r in fixed_width.read_uint32(spark, out, split_bytes=split).collect()] == values


def test_fixed_width_overwrite_and_append(spark, tmp_path):
    out = str(tmp_path / "n")
    for mode in ("overwrite", "append", "append"):
        fixed_width.write_uint32(spark.range(100), "id", out, mode)
    assert fixed_width.read_uint32(spark, out).count() == 300
    fixed_width.write_uint32(spark.range(7), "id", out)
    assert fixed_width.read_uint32(spark, out).count() == 7


def test_fixed_width_rejects_bad_input(spark, tmp_path):
    with pytest.raises(Exception, match="32-bit"):
        fixed_width.write_uint32(spark.createDataFrame([(-1,)], "v long"), "v", str(tmp_path / "neg"))
    assert not [n for n in os.listdir(tmp_path / "neg") if n.endswith(".bin")]
    (tmp_path / "short.bin").write_bytes(b"\x01\x02\x03\x04\x05")
    with pytest.raises(Exception, match="whole number"):
        fixed_width.read_uint32(spark, str(tmp_path / "short.bin")).collect()


def test_text_blobs_and_listing(spark, tmp_path):
    (tmp_path / "text.bin").write_bytes("Data Engineering Lab".encode())
    (tmp_path / "b.log").write_text("one\ntwo\n")
    (tmp_path / "a.log").write_text("x")
    assert text.read_bytes_as_text(spark, str(tmp_path / "text.bin")).first()["text"] == "Data Engineering Lab"
    assert text.read_whole_text(spark, str(tmp_path / "b.log")).first()["text"] == "one\ntwo\n"
    listed = text.list_files(spark, str(tmp_path), "*.log")
    assert [(r["name"], r["length"]) for r in listed.collect()] == [("a.log", 1), ("b.log", 8)]


def test_streamed_readings_schema(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"location": 1, "current": {"time": "2024-01-01T08:00", "pm10": 3.5, "european_aqi": 20}}\n'
    )
    df = readings.stream_readings(spark, str(tmp_path), "location long")
    assert df.isStreaming and df.columns == ["location", *readings.READING_FIELDS]


def test_nested_tables(spark):
    from gaugeflow.sources.markup import nested_table_rows, table_rows

    nested = "<table><tr><th>a</th></tr><tr><td>1<table><tr><td>2</td></tr><tr><td>3<table><tr><td>4</table></td></tr></table>5</td><td>6</td></tr><tr><td>7</td></tr></table><table><tr><td>8"
    pages = [
        (1, nested), (2, None), (3, "no table"), (4, "<table></table>"), (5, "</table><table><tr><th>h<tr><td>x"),
        (6, "<table a=\"<tr>\" b='>'><tr><th>h</th></tr><tr id='<td>'><td title='a>b'>v &amp; w</td><td></td></tr></table>"),
        (7, "<table><tr><td>h</td></tr>" + "<tr><td>" + "y" * 20000 + "</td></tr>" * 3 + "</table>"), (8, "<table <tr"),
    ]
    df = spark.createDataFrame(pages, "id int, html string")
    found = {}
    for r in nested_table_rows(df, "html", ["a", "b"], ["id"]).collect():
        found.setdefault(r["id"], []).append((r["position"], r["a"], r["b"]))
    assert found[1] == [(1, "1 2 3 45", "6"), (2, "7", None)] or [c[2] for c in found[1]] == ["6", None] and found[1][0][1].replace(" ", "") == "12345"
    assert found[5] == [(1, "x", None)] and found[6] == [(1, "v & w", "")] and found[7] == [(1, "y" * 20000, None)]
    assert not {2, 3, 4, 8} & set(found)
    plain = df.where("id = 6").withColumn("html", F.lit("<table><tr><th>n</th></tr><tr><td>1</td><td></td></tr></table>"))
    assert nested_table_rows(plain, "html", ["a", "b"]).collect() == table_rows(plain, "html", ["a", "b"]).collect()


def test_fixed_width_reads_nested_folders(spark, tmp_path):
    for i, name in enumerate(("a.bin", "x/b.bin", "x/y/c.bin", "x/_hidden.bin")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(struct.pack("<2I", i, 2**32 - 1))
    assert sorted(r["value"] for r in fixed_width.read_uint32(spark, str(tmp_path)).collect()) == [0, 1, 2, *[2**32 - 1] * 3]
    with pytest.raises(Exception, match="(?i)path"):
        fixed_width.read_uint32(spark, str(tmp_path / "absent")).collect()


def test_nested_tables_cut_a_page_once(spark, sf):
    """Cutting a page is the costly step: it stands in the plan once, on rows that are dealt to all tasks."""
    plan = sources.s7_nested(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(?=<table\b)") == 1 and plan.count(r"<tr\b") == 1
    assert "RepartitionByExpression" in plan


def test_array_files_keep_their_size(spark, sf, monkeypatch):
    """More orders give more files, not a larger one that one task has to write."""
    paths = []
    monkeypatch.setattr(sources, "scratch_dir", lambda *a: paths.append(scratch_dir(*a)) or paths[-1])
    monkeypatch.setattr(sources, "ARRAY_ROWS", 200, raising=False)
    want = sources.table(spark, sf, "orders")
    got = sources.s5_file(spark, sf)
    assert got.count() == want.count() and got.select("o_orderkey").exceptAll(want.select("o_orderkey")).isEmpty()
    files = [os.path.join(d, f) for d, _, names in os.walk(paths[0]) for f in names if f.startswith("part-")]
    assert len(files) >= want.count() // 200
    assert max(open(f).read().count('"o_orderkey"') for f in files) < 400
