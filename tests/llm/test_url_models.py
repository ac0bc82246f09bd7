"""The URL models against dictionaries of counts, by broadcast and by joins."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import url_filter


def _urls(n, seed=1):
    rng = random.Random(seed)
    tails = ["", "?q=casino&x=1", "#top", "/é/ü?a=b://c", "/" + "z" * 300]
    hosts = ["a.org", "B.ORG", "news.com/fr", "shop.com/de", "example.org/es", "other.net", "plain", "m.example.org/en/12"]
    return [f"http://{rng.choice(hosts)}/{''.join(rng.choice('abcdef/0123') for _ in range(rng.randint(0, 20)))}{rng.choice(tails)}" for _ in range(n)] + [None, "", "no scheme 7", "http://"]


class Plain:
    """Counts of every context and byte, by class."""

    def __init__(self, known):
        self.n, self.after = Counter(), defaultdict(set)
        for view, side in known:
            data = view.encode()
            for i, byte in enumerate(data):
                for order in range(6):
                    context = (b"\0" * 6 + data)[i + 6 - order : i + 6]
                    self.n[side, context, byte] += 1
                    self.n[side, context] += 1
                    self.after[side, context].add(byte)

    def log_likelihood(self, view, side):
        data, total = view.encode(), 0.0
        for i, byte in enumerate(data):
            p = 1 / 256
            for order in range(6):
                context = (b"\0" * 6 + data)[i + 6 - order : i + 6]
                n, t = self.n[side, context], len(self.after[side, context])
                if n:
                    p = (self.n[side, context, byte] + t * p) / (n + t)
            total += math.log(p)
        return total

    def difference(self, view):
        return (self.log_likelihood(view, 1) - self.log_likelihood(view, 0)) / max(1, len(view.encode()))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(_urls(260))], "page_id long, url string, difference string").repartition(5)


def test_counts_and_differences(spark):
    known = [(u or "", i % 2) for i, u in enumerate(_urls(80, 2))]
    plain = Plain(known)
    model = url_filter.fit(spark.createDataFrame(known, "view string, accepted long").repartition(4))
    assert model.where("kind = 0").count() == len({k[1:] for k in plain.n if len(k) == 3})
    table = url_filter._table(model.toArrow())
    views = [u or "" for u in _urls(60, 3)]
    for view, found in zip(views, url_filter.difference(table, pa.array(views))):
        assert found == pytest.approx(plain.difference(view), abs=1e-10)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate([*views, None])], "i long, view string")
    one, two = ({r["i"]: r["d"] for r in url_filter.apply(frame, "view", model, "d", held).collect()} for held in (10**9, 0))
    assert one.keys() == two.keys() and all(one[i] == pytest.approx(two[i], abs=1e-12) for i in one)


def test_judge_by_plain_models(spark, pages):
    rows = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    by_join = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, held=0).collect()}
    assert by_join == {i: r["verdict"] for i, r in rows.items()}
    import zlib

    view = lambda u: re.sub("[0-9]", "0", u or "")
    ruled = [(view(r["url"]), int(r["verdict"] == "allow"), zlib.crc32(str(i).encode()) % 5) for i, r in rows.items() if r["rule"]]
    plain = Plain({(v, side) for v, side, fold in ruled if fold})
    for r in rows.values():
        assert r["difference"] == pytest.approx(plain.difference(view(r["url"])), abs=1e-10)
    free = [r for r in rows.values() if not r["rule"]]
    cut = [r["difference"] for r in free if r["verdict"] == "allow"], [r["difference"] for r in free if r["verdict"] == "block"]
    assert free and (not cut[0] or not cut[1] or min(cut[0]) >= max(cut[1]))


def test_repeated_rows_change_no_verdict(spark, pages):
    once = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    five = url_filter.judge(pages.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(5)]))))
    assert {(r["page_id"], r["verdict"]) for r in five.collect()} == set(once.items())
    assert url_filter.judge(pages.limit(0)).count() == 0
