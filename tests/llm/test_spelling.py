"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from gaugeflow.llm import spelling
from gaugeflow.llm.common import read

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _words(documents, changed=97, shortest=5, least=3):
    counts = Counter()
    for key, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % changed == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def _grouped(counts, factor=2):
    near = {w: [v for v in counts if _one_edit(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= factor * counts[w]}
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(near[w]), form.get(w), counts[form[w]] if w in form else None, root))
    return out


COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def _found(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("depth", [24, 3])
def test_all_pairs(spark, depth):
    """Few letters, so that every kind of edit at every place occurs; both a deep and a shallow trie."""
    rng = random.Random(depth)
    vocabulary = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(250)}
    vocabulary |= {"x" * 60, "x" * 61, "x" * 59 + "y", "y" + "x" * 59, "x" * 30 + "y" + "x" * 29, "aaaa", "aaaaa", "aaaaaa"}
    vocabulary |= {w + "ß𐐷" for w in list(vocabulary)[:20]}
    counts = {w: rng.choice([1, 2, 3, 5, 8, 30]) for w in vocabulary}
    rows = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, form string").repartition(4)
    assert _found(spelling.group_variants(rows, depth=depth)) == _grouped(counts)


def test_words_of_texts(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("aetÀß") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(300)) + "don't X1Y ÀÉÎ×÷ Ā" for _ in range(30)]
    documents = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, texts[6]), (90, None), (91, ""), (None, None), (92, "Q" * 4000 + " " + "q" * 4000 + " " + "Qq" * 2000)]
    frame = spark.createDataFrame([(*d, "w", 1) for d in documents], "doc_id long, text string, word string, n int").repartition(3)
    for changed in (97, 3):
        found = {r["word"]: r["n"] for r in spelling.words(frame, changed=changed).collect()}
        assert found == _words(documents, changed)
    assert _found(spelling.group_variants(spelling.words(frame, changed=3))) == _grouped(_words(documents, 3))


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    found = spelling.group_variants(spelling.words(empty))
    assert found.count() == 0 and set(found.columns) == set(COLUMNS)


def test_whole_table(spark, sf):
    documents = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    counts = _words(documents)
    found = {r["word"]: r for r in spelling.spelling_variants(spark, sf).collect()}
    assert {w: r["n"] for w, r in found.items()} == counts
    deletions = {}
    for w in counts:
        for i in range(len(w)):
            deletions.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        deletions.setdefault(w, set()).add(w)
    for w, r in found.items():
        around = set().union(*(deletions.get(x, set()) for x in [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))]))
        near = [v for v in around if _one_edit(w, v)]
        assert r["n_near"] == len(near)
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        assert r["form"] == (best if best and counts[best] >= 2 * counts[w] else None)
        assert r["root"] == (found[r["form"]]["root"] if r["form"] else w)


@pytest.mark.parametrize("most", [None, "4k"])
def test_small_files_are_not_broadcast(spark, monkeypatch, most):
    """Files of large tables can be small, also before an explode. Only states may pass through the driver, by the bytes of their rows."""
    plans, sizes = [], []

    def written(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        table = materialise(df, label)
        if label == "frontier":
            words = [r["s"] for r in table.where("position < m AND depth < 24").select("s").collect()]
            sizes.append(sum(72 + len(w.encode()) for w in words))
        return table

    materialise = spelling.materialise
    monkeypatch.setattr(spelling, "materialise", written)
    rng = random.Random(11)
    vocabulary = {"".join(rng.choice("abcé") for _ in range(rng.randint(3, 9))) for _ in range(150)} | {"x" * 70, "x" * 71}
    counts = {w: rng.choice([1, 2, 4, 9]) for w in vocabulary}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    if most:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    try:
        found = spelling.group_variants(rows)
        plans.append(("found", found._jdf.queryExecution().executedPlan().toString()))
        assert _found(found) == _grouped(counts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rounds = [plan for label, plan in plans if label == "frontier"][1:]
    others = [(label, plan) for label, plan in plans if plan not in rounds]
    assert [label for label, plan in others if "Broadcast" in plan] == []
    assert {"frontier", "pairs", "forms", "roots", "found"} <= {label for label, plan in others if "SortMergeJoin" in plan}
    assert len(rounds) == len(sizes) - 1 and sizes[-1] == 0
    sent = [size for plan, size in zip(rounds, sizes) if "Broadcast" in plan]
    assert sent and max(sent) <= (4096 if most else 10 << 20)
    assert most is None or len(sent) < len(rounds)
