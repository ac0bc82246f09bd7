"""The pipeline as a whole against plain versions of its stages."""

from collections import Counter

import corpus_pipeline
from test_brute_force import _components, _crc, _gapless, _ids

from gaugeflow.llm import common, mixing, quality
from gaugeflow.session import materialise


def test_stages(spark, sf):
    docs = common.read(spark, sf, "documents")
    start = {r["doc_id"]: r["text"] for r in docs.collect()}
    frames = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf), "stage")
        frames.append(docs)
    rows = [f.collect() for f in frames]
    source = common.read(spark, sf, "documents")
    assert all(f.columns == source.columns for f in frames[:-1])
    scores = {r["doc_id"]: r["score"] for r in quality.quality_classifier(spark, sf).collect()}
    kept = {r["doc_id"] for r in rows[0]}
    assert kept == {i for i, s in scores.items() if s >= 0.3}
    first = {}
    for i in sorted(kept):
        first.setdefault(_norm(start[i]), i)
    assert {r["doc_id"] for r in rows[1]} == set(first.values())
    assert {r["doc_id"] for r in rows[2]} == {c for _, _, c in _components({i: start[i] for i in first.values()}, 5, 80)}
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(frames[2]).collect()}
    assert Counter(r["doc_id"] for r in rows[3]) == Counter({i: n for i, n in taken.items() if n})
    texts = [r["text"] for r in rows[3]]
    ids = _ids("word_bpe_49k.json", texts, 0)
    expected = Counter((r["doc_id"], k, s, len(i[s : s + 2048]), _crc(i[s : s + 2048])) for r, i in zip(rows[3], ids) for k, s in enumerate(range(0, len(i), 2048)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows[4]) == expected
    _gapless(rows[4], 2048)


def _norm(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_odd_rows_keep_their_values(spark, sf):
    """Nulls, empty and very long texts, repeated rows and keys, and columns named like the stages' own."""
    extra = ["size", "target", "kept", "copies", "score", "component_id", "text_sha256", "keep_id", "taken", "label"]
    base = common.read(spark, sf, "documents").select("doc_id", "text", "source").limit(120).collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in base]
    rows += [rows[3], rows[3], (None, rows[4][1], None), (None, None, None), (10**6, "", "x"), (10**6 + 1, "word " * 60_000, "x"), (rows[5][0], "another text of the same key", "y")]
    rows = [(*r, *[f"{c}-{i % 7}" for c in extra]) for i, r in enumerate(rows)]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in extra)
    docs = spark.createDataFrame(rows, schema)
    given = set(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf), "stage")
        assert docs.columns == [f.name for f in docs.schema] == ["doc_id", "text", "source", *extra]
        assert {tuple(r) for r in docs.collect()} <= given
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(pieces) >= docs.count() > 0
    _gapless(pieces, 2048)


def test_empty_tables(spark, sf, tmp_path):
    for name in ("documents", "labels"):
        common.read(spark, sf, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = common.read(spark, sf, "documents").limit(30)
    left = corpus_pipeline.classify_quality(spark, docs, str(tmp_path))  # no labels: every score is one half
    assert left.count() == 30
