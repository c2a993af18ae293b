import random
import time

from pyspark.sql import functions as F

from ledgerloom.llm import pii


def test_scan_equals_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 3)
    r = random.Random(1)
    rows = [([r.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 9, 10, 31)]
    got = spark.createDataFrame(rows, "x array<int>").select("x", pii.scan(F.col("x"), F.lit(0), lambda v: v, lambda a, b: a + b).alias("s"), pii.scan(F.col("x"), F.lit(-1), lambda v: v, lambda a, b: F.greatest(a, b)).alias("m")).collect()
    for x, s, m in got:
        assert s == [sum(x[:k]) for k in range(len(x))] and m == [max([-1, *x[:k]]) for k in range(len(x))]


def test_apart_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 4)
    r, rows = random.Random(2), []
    for k in range(150):
        base, at = [], 0
        for _ in range(r.randint(0, 4)):
            at += r.randint(0, 6)
            base.append((at, r.randrange(4), "email", at + r.randint(1, 5)))
            at = base[-1][3]
        rows.append((k, base, [(s := r.randrange(30), 4 + r.randrange(3), "x", s + r.randint(1, 8)) for _ in range(r.randint(0, 9))]))
    span = "array<struct<start:int,rank:int,kind:string,end:int>>"
    df = spark.createDataFrame(rows, f"k int, base {span}, added {span}")
    got = {r.k: sorted(map(tuple, r.out)) for r in df.select("k", pii._apart(F.col("base"), F.col("added")).alias("out")).collect()}
    over = lambda a, b: a[0] < b[3] and b[0] < a[3]
    for k, base, added in rows:
        free = sorted((a for a in added if not any(over(a, b) for b in base)), key=lambda a: (a[0], -a[3], a[1]))
        want = [a for i, a in enumerate(free) if not any(over(a, b) for b in free[:i])]
        assert got[k] == sorted(want), (base, added)


def test_many_matches_take_linear_time(spark):
    def seconds(n: int) -> float:
        df = spark.createDataFrame([(1, " ".join(f"user{k}@mail{k}.example.com" for k in range(n)))], "doc_id long, text string")
        began = time.time()
        row = pii.report(df).first()
        assert row.n_email == n
        return time.time() - began

    seconds(100)
    assert seconds(16_000) < 3 * seconds(8_000) + 1


def test_recall_of_planted_kinds(spark):
    """Secrets, numbers and spelled-out addresses in running text."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8)))
    some = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    made = {
        "secret": lambda: r.choice(["api_key = ", "token: ", "password=", "secret is "]) + "8" + some("0123456789abcdef", 31),
        "number": lambda: r.choice(["ssn ", "passport ", "account no "]) + f"{some('123456789', 3)}-{some('123456789', 3)}-{some('123456789', 4)}",
        "handle": lambda: f"{word()}.{word()}" + r.choice(["(at)", " at ", "[at]"]) + word() + r.choice(["(dot)", " dot ", "[dot]"]) + "com",
    }
    rows, clean = [], []
    for k in range(300):
        kind = list(made)[k % 3]
        rows.append((k, " ".join(word() for _ in range(12)) + " " + made[kind]() + " " + " ".join(word() for _ in range(12)), kind))
    clean = [(1000 + k, " ".join(word() for _ in range(30)) + r.choice([" at home. ", " in 1999 ", " chapter-12 ", " 12.5 "]) + word()) for k in range(200)]
    df = spark.createDataFrame([(k, t) for k, t, _ in rows] + clean, "doc_id long, text string")
    got = {x.id: x for x in pii.report(df).collect()}
    for kind in made:
        own = [got[k][f"n_{kind}"] > 0 for k, _, other in rows if other == kind]
        assert sum(own) >= 0.9 * len(own), kind
    assert sum(got[k].n_spans for k, _ in clean) <= 4
