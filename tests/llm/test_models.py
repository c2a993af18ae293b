import random
import zlib

from ledgerloom.llm import langid, toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def toxic_rows(n=400):
    r = random.Random(8)
    clean = ["the", "house", "stands", "near", "water", "with", "many", "trees", "around", "garden", "stone", "letter", "morning", "paper"]
    rude = ["idiot", "moron", "worthless", "trash"]
    hide = {"i": "1", "o": "0", "s": "$", "a": "@"}
    docs, labels = [], []
    for k in range(n):
        ws, y = [r.choice(clean) for _ in range(30)], k % 4 == 0
        if y:
            for _ in range(3):
                w = r.choice(rude)
                ws[r.randrange(30)] = w if k % 8 else "".join(hide.get(c, c) for c in w)
        docs.append((k, " ".join(ws), "x"))
        labels.append((k, int(y)))
    return docs, labels


def test_held_out_toxicity(spark):
    docs, labels = toxic_rows()
    d = spark.createDataFrame([*docs, (1000, None, "x"), (1001, "", "x"), (1001, "", "x"), (None, "the house", "x")], "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (0, None), (None, 1), (1, 0)], "doc_id long, toxic int")
    got = {x.id: x for x in toxicity.report(d, lab).collect()}
    assert len(got) == len(docs) + 3 and toxicity.report(d, lab).count() == len(docs) + 4
    right = [got[k].predicted == y for k, y in labels if held(k)]
    assert sum(right) / len(right) > 0.95 and all(got[k].held_out == held(k) for k, _ in labels)
    assert got[1000].score == got[1001].score < 0.5
    assert all(x.score == 0.5 or x.score < 1e-6 for x in toxicity.report(d, lab.limit(0)).collect())
    assert toxicity.report(d.limit(0), lab).collect() == []


def test_disguises_are_read(spark):
    docs, _ = toxic_rows()
    model = toxicity.log_model(toxicity.trigram_counts(spark.createDataFrame([(t,) for _, t, _ in docs], "text string")))
    r = toxicity.Restorer(model)
    assert [r.token(w) for w in ("1d10t", "i.d.i.o.t", "m0r0n", "tr@@@sh", "house", "house,", "***")] == ["idiot", "idiot", "moron", "trash", "house", "house", ""]
    assert r.spaced("you i d i o t there") == ["idiot"]


def test_held_out_languages(spark):
    r = random.Random(4)
    parts = {"en": ["the", "ing", "tion", "wh", "ers", "th"], "fr": ["eau", "que", "ment", "ou", "lle", "re"], "de": ["sch", "ung", "keit", "ein", "ver", "lich"]}
    rows = [(k, " ".join("".join(r.choice(parts[lang]) for _ in range(3)) for _ in range(30)), lang) for k, lang in enumerate(list(parts) * 60)]
    df = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34 !", "de"), (902, "theing", None), (None, rows[0][1], "en")], "doc_id long, text string, lang string")
    got = {x.id: x for x in langid.report(df).collect()}
    right = [got[k].lang_pred == lang for k, _, lang in rows if held(k)]
    assert sum(right) / len(right) > 0.97
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].score == 0.0 and got[902].lang_pred in parts
    assert all(0 <= x.score <= 1 for x in got.values())
    assert {x.lang_pred for x in langid.report(df.where("lang is null")).collect()} == {"und"}
    assert langid.report(df.limit(0)).collect() == []
