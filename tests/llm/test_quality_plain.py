"""The quality classifier against a plain follow-the-regularised-leader over dictionaries."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import quality

M = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15
BITS = 12


def _mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def _word_hash(word):
    total = sum(_mix((byte + 1) * ODD & M) * pow(ODD, i, 1 << 64) for i, byte in enumerate(word))
    return _mix((total + len(word) * ODD) & M)


def _sequence(hashes):
    out = len(hashes)
    for h in hashes:
        out = _mix((out * ODD + h) & M)
    return out


def _shape(word):
    kinds = [97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in word]
    return bytes(k for i, k in enumerate(kinds) if not i or kinds[i - 1] != k)


def _features(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    word, shape = [_word_hash(w) for w in words], [_word_hash(_shape(w)) for w in words]
    grams = [*word, *(h ^ 0x5A for h in shape)]
    for n, source, tag in ((2, word, 1), (2, shape, 2), (3, shape, 3)):
        grams += [(_sequence(source[i : i + n]) + tag) & M for i in range(len(source) - n + 1)]
    grams += [7 for a, b in zip(word, word[1:]) if a == b]
    counts = Counter(_mix(g) >> (64 - BITS) for g in grams)
    return {slot: math.sqrt(n / len(grams)) for slot, n in counts.items()}


def _weight(z, n):
    return 0.0 if abs(z) <= 0.02 else -(z - math.copysign(0.02, z)) / ((1.0 + math.sqrt(n)) / 5.0 + 0.0002)


def _fit(rows, shards, rounds):
    state = defaultdict(float), defaultdict(float)
    for _ in range(rounds):
        made = []
        for shard in range(shards):
            own = sorted(r for r in rows if r[0] % shards == shard)
            if not own:
                continue
            z, n = defaultdict(float, state[0]), defaultdict(float, state[1])
            for _, text, y in own:
                x = {0: 1.0} | {slot: v for slot, v in sorted(_features(text).items()) if slot}
                w = {s: _weight(z[s], n[s]) for s in x}
                g = 1 / (1 + math.exp(-sum(w[s] * v for s, v in x.items()))) - y
                for s, v in x.items():
                    z[s] += g * v - (math.sqrt(n[s] + (g * v) ** 2) - math.sqrt(n[s])) / 5.0 * w[s]
                    n[s] += (g * v) ** 2
            made.append((z, n))
        state = tuple(defaultdict(float, {s: sum(m[i][s] for m in made) / len(made) for s in set().union(*(m[i] for m in made))}) for i in (0, 1))
    return {s: _weight(state[0][s], state[1][s]) for s in state[0]}


def _texts():
    rng = random.Random(8)
    good, bad = ["river", "stone", "Light", "and", "café", "2024"], ["BUY", "now", "$$$", "x1x1", "!!", "now"]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(rng.randint(0, 30))), i % 3 and 1) for i in range(60)]
    return [*rows, (60, None, 1), (61, "", 0), (62, "word " * 3000, 1), rows[4]]


@pytest.mark.parametrize("shards", [1, 3])
def test_weights_and_scores(spark, shards):
    rows = _texts()
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(4)
    ranks = {r["doc_id"]: r["h"] for r in frame.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)).alias("h")).collect()}
    plain = _fit([(ranks[i], t or "", y) for i, t, y in rows], shards, 2)
    weights = quality.fit(frame, bits=BITS, shards=shards, rounds=2)
    dense = np.zeros(1 << BITS)
    for slot, w in plain.items():
        dense[slot] = w
    assert np.allclose(weights, dense, atol=1e-5)
    for r in quality.score(frame, weights).collect():
        x = {0: 1.0} | {s: v for s, v in _features(r["text"]).items() if s}
        expected = 1 / (1 + math.exp(-sum(float(weights[s]) * v for s, v in x.items())))
        assert r["score"] == pytest.approx(expected, abs=1e-9)
