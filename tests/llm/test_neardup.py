import random

from ledgerloom.llm import neardup


def brute(rows, width, percent):
    def shingles(t):
        ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        ws = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", ws) if w]
        n = min(width, len(ws))
        return {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if n else set()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def family(r, words, edits):
    out = list(words)
    for _ in range(edits):
        out[r.randrange(len(out))] = f"x{r.randrange(10**9)}"
    return " ".join(out)


def test_components_equal_brute_force_where_links_are_near_the_threshold(spark, monkeypatch):
    r = random.Random(5)
    rows = []
    for f in range(3):
        base = [f"w{f}_{k}" for k in range(100)]
        rows += [(1000 * f + k, family(r, base, r.choice([1, 2, 3, 4, 5]))) for k in range(60)]
    rows += [(9000 + k, " ".join(f"lone{k}_{j}" for j in range(20))) for k in range(10)]
    r.shuffle(rows)
    monkeypatch.setattr(neardup, "BLOCK", 16)  # hot keys are compared in several blocks
    want = brute(rows, 4, 80)
    assert len({c for _, c in want.values()}) > 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(df).collect()}
    assert got == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "one two"), (6, "one two"), (None, "one two"), (None, None), (7, "a b c d " * 3000), (8, "a b c d " * 3000), (9, "z y"), (9, "one two")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, id string, a string")
    got = sorted(((x.id, x.n_shingles, x.component_id, x.kept) for x in neardup.near_duplicates(df).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 4, False), (6, 1, 4, False), (7, 4, 7, True), (8, 4, 7, False), (9, 1, 4, False), (9, 1, 4, False), (None, 0, None, True), (None, 1, None, True)]
    assert got == sorted(want, key=str)
    assert neardup.near_duplicates(df.limit(0)).collect() == []
