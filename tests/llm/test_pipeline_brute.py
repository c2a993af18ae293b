"""The pipeline's stages against plain Python that shares no code with them."""

import random
import re

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline as cp

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def survivors(rows):
    """Ids that stay: the smallest of each component of texts whose sets of five words overlap by 0.8 or more."""
    sets = {}
    for k, t in rows:
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(t)) if w]
        n = min(5, len(ws))
        sets[k] = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if ws else set()
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {k for k in sets if top(k) == k}


def hit(text, items):
    """Whether a text holds ten words of an item in a row, or all of a shorter one."""
    ws = WORD.findall(lower(text))
    for item in items:
        p = WORD.findall(lower(item))
        n = min(10, len(p))
        for s in range(len(p) - n + 1) if n else ():
            if any(ws[i : i + n] == p[s : s + n] for i in range(len(ws) - n + 1)):
                return True
    return False


def test_stages_equal_plain_python(spark, tmp_path):
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7)))
    text = lambda n: [word() for _ in range(n)]
    items = [(f"i{k}", " ".join(text(r.choice([4, 10, 25])))) for k in range(6)]
    rows = [text(r.randint(0, 80)) for _ in range(40)]
    for _ in range(30):  # copies with some words changed, some beyond the threshold
        own = list(r.choice(rows[:40]))
        for _ in range(r.choice([0, 1, 2, 6])):
            if own:
                own[r.randrange(len(own))] = word()
        rows.append(own)
    for k in range(6):  # passages of items, whole or all but a word
        p = items[k][1].split()
        rows.append([*text(10), *(p if k % 2 else p[:-1]), *text(10)])
    docs = [(k, " ".join(t)) for k, t in enumerate(rows)]
    r.shuffle(docs)
    sf = f"file://{tmp_path}"
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    df = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(cp.STAGES)
    kept = stages["near_duplicates"](spark, df, sf)
    want = survivors(docs)
    assert {x.doc_id for x in kept.collect()} == want and len(want) < len(docs)
    clean = stages["decontamination"](spark, kept, sf)
    want = {k for k, t in docs if k in want and not hit(t, [t for _, t in items])}
    assert {x.doc_id for x in clean.collect()} == want
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for x in stages["bpe"](spark, clean, sf).collect():
        ids = lib.encode(dict(docs)[x.doc_id], add_special_tokens=False).ids
        assert list(x.ids) == ids and x.decoded == lib.decode(ids, skip_special_tokens=False)
