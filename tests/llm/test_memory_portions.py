"""What a Python task holds or hands over at a time has a bound that the texts of a batch do not move."""

import numpy as np
import pyarrow as pa
from gaugeflow.llm import shingle_join
from gaugeflow.session import BATCH, materialise


def _long_texts(n, words, seed=3):
    draw = np.random.default_rng(seed)
    return [" ".join(f"w{x}" for x in draw.integers(0, 1 << 40, words)) for _ in range(n)]


def test_routing_keys_leave_a_task_in_portions():
    texts = _long_texts(900, 700) + ["", "one two three four five"]
    texts += texts[:5]
    batches = [pa.record_batch([pa.array(texts[i : i + 600])], names=["text"]) for i in range(0, len(texts), 600)]
    out = list(shingle_join._keys(5, 80)(iter(batches)))
    assert len(out) > 2 * len(batches)
    assert max(b.num_rows for b in out) < 2 * shingle_join.PORTION
    found = [(k, n) for b in out for k, n in zip(b.column("key").to_pylist(), b.column("node").to_pylist())]
    want = []
    for batch in batches:
        for _, own in shingle_join._each_set(batch, "text", 5):
            if len(own):
                want += [(k, shingle_join._set_hash(own, 1)) for k in shingle_join.routing_keys(own, 80).tolist()]
    assert set(found) == set(want)
    assert len(found) == len(set(want))  # a set that is met again is not given again


def test_tables_are_written_in_batches_of_bounded_bytes(spark):
    before = spark.conf.get(BATCH)
    rows = spark.range(0, 3000, numPartitions=1).selectExpr("id", "repeat('x', 4000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    found = materialise(rows.mapInArrow(sizes, "n long, size long"), "sizes").collect()
    assert sum(r["n"] for r in found) == 3000
    assert max(r["size"] for r in found) < 6_000_000  # 12 MB in all
    assert spark.conf.get(BATCH) == before
