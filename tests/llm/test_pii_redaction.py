from ledgerloom.llm import pii


def test_redaction_masks_the_spans_of_find(spark):
    texts = ["mail a1b2c3d4e5f6a7b8c9d0e1f2a3b4c5d6@example.org now", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" é😀 x@y.zz', "10.0.0.1 and 1.2.3.4@x.y", "nothing", "", None]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, email string")
    spans = {r.id: r.spans for r in pii.find(df).collect()}
    got = {r.doc_id: r for r in pii.redact(df).collect()}
    assert pii.redact(df).columns == df.columns and all(r.email == "x" for r in got.values())
    for k, t in enumerate(texts):
        want, at = "", 0
        for s in spans[k]:
            if s.start >= at:
                want += t[at : s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.end)
        assert got[k].text == (None if t is None else want + t[at:])
    assert got[0].text == "mail [EMAIL] now"
