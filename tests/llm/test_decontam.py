import hashlib
import random
import re

from ledgerloom.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ws(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    out = {}
    for i, t in docs:
        d, hit, found = ws(t), set(), set()
        for k, text in items:
            p = ws(text)
            n = min(window, len(p))
            for s in range(len(p) - n + 1) if n else ():
                for at in range(len(d) - n + 1):
                    if d[at : at + n] == p[s : s + n]:
                        hit |= set(range(at, at + n))
                        found.add(str(k))
        out[i] = (len(d), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def rows():
    r = random.Random(1)
    vocab = ["a", "b", "c", "Ünï", "d9", "E"]
    some = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(k, some(r.choice([1, 4, 9, 10, 12, 20]))) for k in range(2, 14)] + [(14, ""), (15, None), (16, "..."), (17, "q r s"), (18, "q r s")]
    docs = [(k, some(r.randint(0, 60))) for k in range(40)] + [(40 + k, some(8) + "--" + str(items[k][1]).upper() + "!" + some(5)) for k in range(12)]
    return docs + [(60, None), (61, ""), (62, "Q, r; S " * 500)], items


def test_equals_brute_force_in_one_block_and_in_many(spark):
    docs, items = rows()
    items = [x for x in items if x[1] is None or len(x[1].split()) != 1]  # one letter would hit everything
    want = brute(docs, items)
    d = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, n_words int, items string")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    for size in (1 << 20, 20):
        got = {r.id: tuple(r)[1:] for r in decontam.report(d, b, block_bytes=size).collect()}
        assert got == want
    assert all(not r.contaminated for r in decontam.report(d, b.limit(0)).collect())
    assert decontam.report(d.limit(0), b).collect() == []


def test_one_word_patterns():
    m = decontam.Matcher([("1", "x"), ("2", "x y")])
    assert m.find([b"x", b"z", b"x", b"y"]) == ([[0, 1], [2, 4]], {"1", "2"})
