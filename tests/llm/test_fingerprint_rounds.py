"""Each round of sketches reads the pairs again, so they must lie ready."""

from gaugeflow.llm import fingerprint


def test_rounds_read_pairs_without_joining_documents(spark, monkeypatch):
    plans = []

    def differences(pairs, *rest, own=fingerprint.differences):
        plans.append(pairs._jdf.queryExecution().optimizedPlan().toString())
        return own(pairs, *rest)

    monkeypatch.setattr(fingerprint, "differences", differences)
    texts = [(k, "".join(f"Line {k % 3} {x}.\n" for x in range(5 * k))) for k in range(6)]
    out = fingerprint.compare_versions(spark.createDataFrame(texts, "doc_id long, text string"))
    assert out.count() == 6
    assert len(plans) == 1 and "Join" not in plans[0]
