"""Streams against batch, restarts, late and repeated data."""

import json

from pyspark.sql import functions as F

from gaugeflow.sources.readings import stream_readings
from gaugeflow.sources.records import split_malformed
from gaugeflow.streaming.latest import follow_latest, maintain_latest, read_followed, read_latest
from gaugeflow.streaming.rejects import route_malformed
from gaugeflow.streaming.scoring import score_stream


def land(folder, name, records):
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def reading(location, time, aqi):
    return {"location": location, "current": {"time": time, "european_aqi": aqi}}


def test_scoring_continues_where_it_stopped(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        source = stream_readings(spark, str(inbox), "location int")
        score_stream(source, lambda df: df.withColumn("twice", F.col("european_aqi") * 2), out, checkpoint).awaitTermination()
        return sorted((r["location"], r["twice"]) for r in spark.read.parquet(out).collect())

    land(inbox, "a.json", [reading(1, "t1", 10)])
    assert run() == [(1, 20.0)]
    land(inbox, "b.json", [reading(2, "t1", 5)])
    assert run() == [(1, 20.0), (2, 10.0)]
    assert run() == [(1, 20.0), (2, 10.0)]


def test_late_records_never_replace_newer_ones(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    table, checkpoint = str(tmp_path / "latest"), str(tmp_path / "ck")

    def run():
        source = stream_readings(spark, str(inbox), "location int").select("location", "time", "european_aqi")
        maintain_latest(source, ["location"], ["time"], table, checkpoint, keep=2).awaitTermination()
        return sorted(tuple(r) for r in read_latest(spark, table).collect())

    land(inbox, "a.json", [reading(1, "t5", 10), reading(2, "t1", 1)])
    assert run() == [(1, "t5", 10.0), (2, "t1", 1.0)]
    land(inbox, "b.json", [reading(1, "t4", 99), reading(2, "t2", 7)])
    assert run() == [(1, "t5", 10.0), (2, "t2", 7.0)]
    land(inbox, "c.json", [reading(3, "t0", 0)])
    assert run() == [(1, "t5", 10.0), (2, "t2", 7.0), (3, "t0", 0.0)]
    assert len(list((tmp_path / "latest").glob("version=*"))) == 2


def test_malformed_records(spark, tmp_path):
    texts = [(1, '{"k": 1}'), (2, '{"k": '), (3, "nope"), (4, None), (5, '{"z": 2}')]
    df = spark.createDataFrame(texts, "i int, body string")
    good, bad = split_malformed(df, "body", "k long", "parsed")
    assert sorted((r["i"], r["parsed"] and r["parsed"]["k"]) for r in good.collect()) == [(1, 1), (4, None), (5, None)]
    assert sorted(r["i"] for r in bad.collect()) == [2, 3]
    odd = [(1, "[1,2]"), (2, '"x"'), (3, '{"k":"abc"}'), (4, '{"k":1,"k":2}'), (5, " "), (6, ' {"k": 7}')]
    good, bad = split_malformed(spark.createDataFrame(odd, "i int, body string"), "body", "k long", "parsed")
    assert sorted((r["i"], r["parsed"]["k"]) for r in good.collect()) == [(4, 2), (6, 7)]
    assert sorted(r["i"] for r in bad.collect()) == [1, 2, 3, 5]
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    paths = [str(tmp_path / p) for p in ("good", "bad", "ck")]
    route_malformed(source, "body", "k long", "parsed", *paths).awaitTermination()
    assert spark.read.parquet(paths[0]).count() == 3 and spark.read.parquet(paths[1]).count() == 2


def test_followed_latest_writes_only_changed_keys(spark, tmp_path):
    inbox, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "ck")
    inbox.mkdir()

    def run(fold_every=32):
        source = stream_readings(spark, str(inbox), "location int").select("location", "time", "european_aqi")
        follow_latest(source, ["location"], ["time"], table, checkpoint, fold_every).awaitTermination()
        return sorted((tuple(r) for r in read_followed(spark, table, ["location"], ["time"]).collect()), key=lambda r: (r[0] is None, r[0]))

    def written(n):
        return sorted(tuple(r) for r in spark.read.parquet(f"{table}/changed={n}").collect())

    land(inbox, "a.json", [reading(i, "t5", i) for i in range(100)])
    assert len(run()) == 100
    land(inbox, "b.json", [reading(1, "t4", 99), reading(2, "t6", 7), reading(2, "t3", 0)])  # late, new, late
    found = run()  # the state comes back from the checkpoint
    assert written(1) == [(1, "t5", 1.0), (2, "t6", 7.0)]
    assert found[:4] == [(0, "t5", 0.0), (1, "t5", 1.0), (2, "t6", 7.0), (3, "t5", 3.0)] and len(found) == 100
    land(inbox, "c.json", [reading(100, None, 1), reading(None, "t1", 2)])
    assert len(run()) == 102
    for i in range(3, 9):  # folds at batches 3, 5 and 7
        land(inbox, f"d{i}.json", [reading(3, f"u{i}", i)])
        assert (3, f"u{i}", float(i)) in [r[:3] for r in run(2)]
    assert len(run(2)) == 102
    left = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert left == ["base=5", "base=7", "changed=6", "changed=7", "changed=8"]


def test_repeated_batch_gives_the_same_table(spark, tmp_path):
    """A batch whose commit was lost runs again and writes the same folder."""
    inbox, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), tmp_path / "ck"
    inbox.mkdir()

    def run():
        source = stream_readings(spark, str(inbox), "location int").select("location", "time", "european_aqi")
        follow_latest(source, ["location"], ["time"], table, str(checkpoint)).awaitTermination()
        return sorted((tuple(r) for r in read_followed(spark, table, ["location"], ["time"]).collect()), key=lambda r: (r[0] is None, r[0]))

    land(inbox, "a.json", [reading(1, "t1", 1), reading(2, "t1", 2)])
    run()
    land(inbox, "b.json", [reading(1, "t2", 5)])
    first = run()
    for name in ("1", ".1.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    assert run() == first == [(1, "t2", 5.0), (2, "t1", 2.0)]
