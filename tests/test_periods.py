"""Weeks and days of the wide tables over more than one month."""

from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from gaugeflow.queries import registry


def test_periods_of_many_months(spark, tmp_path):
    start = datetime(2022, 11, 3, 5)
    rows = [(u, start + timedelta(hours=31 * k), registry.CHANNELS[k % 5], float(k * (u + 1))) for u in (0, 1, 7, 149) for k in range(700)]
    path = str(tmp_path / "events.parquet")
    spark.createDataFrame(rows, "user_id long, ts timestamp, event_type string, value double").write.parquet(path)
    monday, eve = date(2024, 1, 1), date(2023, 12, 31)
    for frame, period in ((registry.weekly, lambda t: (t.date() - monday).days // 7), (registry.daily, lambda t: (t.date() - eve).days)):
        expected = defaultdict(list)
        for u, t, c, v in rows:
            expected[u, period(t), c].append(v)
        got = frame(spark, str(tmp_path)).collect()
        assert Counter((r["user_id"], r["period"]) for r in got) == Counter({k[:2] for k in expected})
        assert len({r["reading_id"] for r in got}) == len(got)
        for r in got:
            for c in registry.CHANNELS:
                own = expected.get((r["user_id"], r["period"], c))
                assert r[c] == (sum(own) / len(own) if own else None)


def test_keys_of_the_first_month(spark, sf):
    for frame, old, factor in ((registry.weekly, F.floor((F.dayofmonth("first_ts") - 1) / 7), 10), (registry.daily, F.dayofmonth("first_ts"), 100)):
        got = frame(spark, sf)
        assert got.where((F.col("period") != old) | (F.col("reading_id") != F.col("user_id") * factor + old)).isEmpty()
        assert dict(got.dtypes)["reading_id"] == "bigint"


def test_averages_follow_the_order_of_the_table(spark, tmp_path):
    """Tasks that read parts of a group do not change the last digit of its averages."""
    start = datetime(2024, 1, 1)
    rows = [(k, k % 4, start + timedelta(minutes=k % 1000), registry.CHANNELS[k // 4 % 5], k * 7919 % 56021 / 100) for k in range(8000)]
    path = str(tmp_path / "events.parquet")
    frame = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double")
    frame.repartitionByRange(7, "event_id").sortWithinPartitions("event_id").write.parquet(path)
    expected = defaultdict(list)
    for _, u, _, c, v in rows:
        expected[u, c].append(v)
    for frame in (registry.weekly, registry.daily):
        got = frame(spark, str(tmp_path)).collect()
        assert len(got) == 4
        for r in got:
            for c in registry.CHANNELS:
                own, total = expected[r["user_id"], c], 0.0
                for v in own:  # sum() of Python 3.12 makes up for rounding
                    total += v
                assert r[c] == total / len(own)
