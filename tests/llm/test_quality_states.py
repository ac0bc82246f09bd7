"""The learners' states stay with the tasks; the driver gets the weights alone."""

import numpy as np
from pyspark.sql.classic.dataframe import DataFrame

from gaugeflow.llm import quality

BITS = 16


def _labelled(spark, n=40):
    draw = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in draw.integers(0, 3000, 60)) + (" good river" if i % 2 else " BUY $$$"), i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def _state_by_hand(rows, shards, rounds):
    """The averaged state after all rounds, learner by learner in this process."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(rounds):
        made = []
        for shard in range(shards):
            own = sorted((r["rank"], r["text"], r["label"]) for r in rows if r["rank"] % shards == shard)
            if own:
                leader = quality.Leader(BITS)
                leader.z, leader.n = z.copy(), n.copy()
                for _, text, y in own:
                    data = np.frombuffer(text.encode(), np.uint8)
                    _, slot, value = quality.features(data, np.array([0, len(data)]), BITS)
                    leader.learn(*quality._with_bias(slot, value), y)
                made.append(leader)
        z, n = np.mean([x.z for x in made], axis=0), np.mean([x.n for x in made], axis=0)
    leader = quality.Leader(BITS)
    leader.z, leader.n = z, n
    return leader.weights().astype(np.float32)


def test_only_weights_come_to_the_driver(spark, monkeypatch):
    got = []

    def collect(self, own=DataFrame.collect):
        rows = own(self)
        got.extend(sum(len(v) for v in r if isinstance(v, (bytes, bytearray))) for r in rows)
        return rows

    labelled = _labelled(spark)
    monkeypatch.setattr(DataFrame, "collect", collect)
    weights = quality.fit(labelled, bits=BITS)
    assert sum(got) <= 4 << BITS  # 4 bytes a weight; each learner's state has 16, in each round
    assert len(weights) == 1 << BITS and weights.any()


def test_states_pass_between_rounds(spark):
    labelled = _labelled(spark)
    rows = labelled.selectExpr("xxhash64(cast(doc_id AS string), 17) AS rank", "text", "label").collect()
    for shards in (1, 3, 64):  # more shards than rows: some have none
        assert np.allclose(quality.fit(labelled, bits=BITS, shards=shards), _state_by_hand(rows, shards, quality.ROUNDS), rtol=1e-5, atol=1e-7)
