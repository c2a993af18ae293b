import hashlib
import random
import re

from pyspark.sql import functions as F

from ledgerloom.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(t):
    out = []
    for rank, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}
            if ok[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns(spark):
    r = random.Random(3)
    parts = ["a", "b.", "@", "1", "23", "255", ".", "-", " ", "+", "(", ")", "%", "_", "é", "😀", "4111 1111 1111 1111", "x@y.zz", "+1 (555) 123-4567"]
    texts = [None, "", "no data", "a" * 20000, "1" * 5000, "10.0.0.1 " * 200] + ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(800)]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "x@y.zz", "x")], "doc_id long, text string, base string")
    got = {x.id: x for x in pii.report(df).collect()}
    for k, t in [*enumerate(texts), (None, "x@y.zz")]:
        b = base(t)
        assert got[k].base_sha256 == hashlib.sha256(",".join(f"{kind}:{s}:{e}" for s, _, kind, e in b).encode()).hexdigest(), t
        assert [got[k][f"n_{kind}"] for kind in PLAIN] == [sum(x[2] == kind for x in b) for kind in PLAIN]
        shown = [x for x in got[k].spans.split(",") if x]
        assert {f"{kind}:{s}:{e}" for s, _, kind, e in b} <= set(shown)
    assert pii.report(df.limit(0)).collect() == []


def test_added_spans_and_redaction(spark):
    texts = ['see token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" here', "write to jane.doe (at) example (dot) org now", "the wonderfullylongword ended", None, "mail a.b@c.de or 4111 1111 1111 1111 or 1234 5678 9012 3456 7 at 10.0.0.1", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {x.id: x.spans for x in pii.report(df).collect()}
    assert spans[0] == "secret:13:53" and spans[1].startswith("handle:9:") and spans[2] == ""
    out = {x.doc_id: x.text for x in pii.redact(df).collect()}
    assert out[0] == 'see token = "[SECRET]" here' and "[HANDLE]" in out[1] and out[2] == texts[2] and out[3] is None and out[5] == ""
    assert out[4].startswith("mail [EMAIL] or [CARD] or ") and out[4].endswith("[IP]")


def test_main_path_has_no_python(spark):
    df = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a@b.cc").alias("text"))
    for out in (pii.report(df), pii.redact(df)):
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
