"""The pipeline's near-copy stage: five words, 0.8 alike, and which rows stay."""

import re
from collections import Counter

import corpus_pipeline

from gaugeflow.llm import shingle_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _words(n, name="w"):
    return [f"{name}{k}" for k in range(n)]


def _text(words):
    return " ".join(words)


def _changed(n, at, block):
    words = _words(n)
    words[at : at + block] = _words(block, "new")
    return _text(words)


def _kept(texts, width=5, percent=80):
    """Smallest key of each component, by comparing all pairs."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.lower())
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or {tuple(w)}
    name = {i: i for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((name[i], name[j]))
                name = {k: low if v == high else v for k, v in name.items()}
    return set(name.values())


def test_five_words_and_eight_tenths(spark, sf):
    pairs = [(350, 160, 30), (400, 180, 32), (50, 25, 1), (60, 25, 12)]
    texts = {}
    for k, (n, at, block) in enumerate(pairs):
        own = lambda t: re.sub(r"(\w+)", rf"p{k}\1", t)  # noqa: B023, E731
        texts[10 * k], texts[10 * k + 1] = own(_text(_words(n))), own(_changed(n, at, block))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()}
    assert kept == _kept(texts) == {0, 10, 20, 30, 31}


def test_rows_stay_or_go_by_row_not_by_key(spark):
    base = [_text(_words(60, f"t{k}_")) for k in range(6)]
    rows = [
        (7, base[0], "stays"), (None, base[0] + " end", "goes"), (None, base[1], "clean"), (None, None, "empty"), (None, "", "empty"),
        (None, base[2], "nulls"), (None, base[2] + " end", "nulls"),
        (3, base[3], "stays"), (9, base[3] + " end", "goes"), (9, base[4], "clean"),
        (5, base[5], "twice"), (5, base[5] + " end", "twice"), (8, base[5] + " last", "goes"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, what string").repartition(3)
    got = shingle_join.keep_one(docs, width=5, percent=80)
    assert got.columns == docs.columns
    assert Counter(r["what"] for r in got.collect()) == {"stays": 2, "clean": 2, "empty": 2, "nulls": 1, "twice": 1}
