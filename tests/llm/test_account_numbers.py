"""Account numbers end where their country's length ends, whatever follows."""

from gaugeflow.llm import pii


def test_what_follows_hides_no_account_number(spark):
    cases = [
        ("iban ES91 2100 0418 4502 0005 1332 EUR 500", ["ES91 2100 0418 4502 0005 1332"]),
        ("BE68539007547034 FROM the bank", ["BE68539007547034"]),
        ("AT611904300234573201 OR iban", ["AT611904300234573201"]),
        ("\U00010000 bank AT61 1904 3002 3457 3201 DE89 3704 0044 0532 0130 00 2024", ["AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00"]),
        ("account AB12 3456 7890 AT61 1904 3002 3457 3201", ["AT61 1904 3002 3457 3201"]),
        ("iban DE89370400440532013001, ES91 2100 0418 4502 0005 1333 EUR", []),
        ("NO9386011117947 iban", ["NO9386011117947"]),
        ("iban xAT611904300234573201 AT611904300234573201x", []),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    for r in pii.find_pii(docs).collect():
        text, expected = cases[r["doc_id"]]
        spans = [s for s in r["pii"] if s["kind"] == "iban"]
        assert [s["value"] for s in spans] == expected, text
        assert all(text[s["start"] : s["end"]] == s["value"] for s in spans)
