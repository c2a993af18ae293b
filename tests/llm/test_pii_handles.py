from pyspark.sql import functions as F

from ledgerloom.llm import pii


def test_the_prefilter_never_hides_a_handle(spark):
    made = [(t, y) for k, t, y in pii.examples() if k == "handle"]
    texts = ["jane at example.com", "jane at  example.com", "jane (at) example.com", "jane[at]a dot org", "at home", "look at it. Now", "jane at 10.0", ""]
    df = spark.createDataFrame([(t, 2) for t in texts] + made, "text string, y int")
    t = F.col("text")
    got = df.select("text", "y", t.rlike(pii.PATTERNS["handle"]).alias("match"), F.size(pii.matches(t, "handle")).alias("found")).collect()
    assert all((r.found > 0) == r.match for r in got)
    assert {r.text for r in got if r.found} >= set(texts[:4])
    assert all(r.found for r in got if r.y == 0)  # negatives reach the calibration


def test_a_span_does_not_depend_on_unrelated_text(spark):
    df = spark.createDataFrame([(1, "we met jane at example.com"), (2, "we met jane at example.com and bob (at) here (dot) org")], "doc_id long, text string")
    spans = {r.id: r.spans for r in pii.report(df).collect()}
    assert ("handle:7:" in spans[1]) == ("handle:7:" in spans[2])
