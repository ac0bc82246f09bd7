"""Routing keys of the near-copy join: no link is lost, and what is not alike stays apart."""

import numpy as np
import pyarrow as pa
import pytest

from gaugeflow.llm import shingle_join
from gaugeflow.session import materialise


def _keys(own, percent, hot):
    return set(shingle_join.routing_keys(own, percent, *hot).tolist())


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_key_whatever_is_hot(percent):
    rng = np.random.default_rng(percent)
    for n in (1, 3, 7, 12, 25, 48, 90, 200, 450):
        for _ in range(12):
            whole = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            a = b = whole
            while True:  # as far apart as a link allows
                least = (a, b) if len(a) < len(b) else (b, a)
                c, d = least[0][1:], np.append(least[1], rng.integers(0, 1 << 63, 1).astype(np.uint64))
                c, d = rng.permutation(c), np.unique(d)
                both = len(np.intersect1d(c, d))
                if not len(c) or 100 * both < percent * (len(c) + len(d) - both):
                    break
                a, b = np.sort(c), d
            if np.array_equal(a, b):
                continue
            every = np.unique(np.array([*_keys(a, percent, ()), *_keys(b, percent, ())], np.int64))
            for share in (0.0, 0.3, 1.0):
                hot = every[rng.random(len(every)) < share]
                lists = (hot, rng.integers(3, 6, len(hot)))
                assert _keys(a, percent, lists) & _keys(b, percent, lists)


def test_unlike_texts_of_equal_length_have_no_edges(spark):
    rng = np.random.default_rng(1)
    texts = [(k, " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 125 + k % 30)), k) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, hash long")
    schema = "doc_id long, hash long, n_shingles long, s1 long, s2 long, point binary"
    signed = materialise(docs.mapInArrow(shingle_join._signatures(5), schema), "signed")
    edges, _ = shingle_join.candidate_edges(docs, signed, 5, 80)
    assert edges.isEmpty()


def test_meetings_of_keys_cut_by_batches():
    rng = np.random.default_rng(2)
    sizes = [1, 2, 3, 64, 65, 200, 1, 1, 40, 700, 5]
    rows = sorted((key, 0, int(x)) for key, n in enumerate(sizes) for x in rng.choice(10_000, n, replace=False))
    rows = [r for r in rows for _ in range(1 + r[2] % 2)]  # copies
    for step in (1, 7, 100, 5000):
        batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[k : k + step])], names=["key", "salt", "node"]) for k in range(0, len(rows), step)]
        found = set()
        for out in shingle_join._meetings(np.zeros(0, np.int64))(iter(batches)):
            found |= {tuple(r.values()) for r in out.to_pylist()}
        plain = set()
        for key, n in enumerate(sizes):
            own = sorted({r[2] for r in rows if r[0] == key})
            few = n <= shingle_join.PAIRS
            plain |= {(int(few), u, v) for i, u in enumerate(own) for v in own[i + 1 :] if few or i == 0}
        assert found == plain
