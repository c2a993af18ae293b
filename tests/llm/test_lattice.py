import random

import numpy as np

from ledgerloom.llm import toxicity as T


def cheapest(word, model):
    """The reading of least cost over all ways to read each character, by enumeration."""
    at = lambda c: int(T._TABLE[min(ord(c), 0x250)])
    best = [float("inf"), word]

    def go(k, a, b, cost, read):
        if k == len(word):
            cost += float(model[a, b, 0])
            if cost < best[0]:
                best[:] = [cost, read]
            return
        ch = word[k]
        held = k > 0 and ch == word[k - 1]
        ways = [(T.LETTER, c) for c in T.STANDS_FOR.get(ch, "")]
        if ch.isalpha():
            ways.append((0.0, ch))
        elif ch not in T.PARTS:
            ways.append((T.KEEP, ch))
        for w, c in ways:
            twice = T.DOUBLE if held and read and read[-1] == c else 0
            go(k + 1, b, at(c), cost + w + twice + float(model[a, b, at(c)]), read + c)
        if ch in T.PARTS or not ch.isalnum():
            go(k + 1, a, b, cost + T.DROP, read)
        if held and read:
            go(k + 1, a, b, cost + T.FOLD, read)

    go(0, 0, 0, 0.0, "")
    return best[1]


def test_decoding_equals_enumeration():
    r = random.Random(4)
    for trial in range(40):
        model = np.random.default_rng(trial).exponential(3, (T.SYMBOLS,) * 3).astype(np.float32)
        for _ in range(15):
            word = "".join(r.choice("aio1!0.$ss") for _ in range(r.randint(1, 7)))
            assert T.decode(word, model) == cheapest(word, model), word


def test_words_of_any_length_are_read_and_all_telling_words_count(spark):
    model = np.full((T.SYMBOLS,) * 3, 3.0, np.float32)
    assert T.decode("i" + "." * 60 + "d" + "." * 60 + "i.o.t", model) == "idiot"
    rude = [f"rude{chr(97 + k // 26)}{chr(97 + k % 26)}x" for k in range(300)]
    docs = [(k, f"plain words {rude[k % 300]} here" if k % 2 else "plain words are here", k % 2) for k in range(9_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    c = T.train(df, df.select("doc_id", "toxic"))
    assert sum(w in c.weights for w in rude) == 150  # those of odd numbers
