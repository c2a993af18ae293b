"""Toxicity scores of texts restored by a noisy-channel decoder.

A character trigram model is counted over all texts. Words that look disguised (digits or signs for letters, letters held
down, letters spaced out or parted by signs) become a lattice: each character may stand for letters at a cost, be dropped, or
fold into the one before it. Viterbi decoding finds the cheapest reading under the model. Letters spaced out have lost their
word borders: the model places them, and the words of every placing close to the cheapest count. The restored words are scored by
logistic regression over all words and word beginnings that tell the labels apart: held by LEAST_DOCS rows of the sample or more,
with a share of toxic rows LEAST_SPREAD standard deviations or more from what chance gives.

Labels come only from rows that aren't held out. The classifier is fitted on at most SAMPLE labelled rows, taken by a hash of
their ids. Corpus counts and scoring cover all rows and whole texts.

Defined results: null and empty texts get the score of no evidence; repeated rows each give a row; of repeated labels the
larger counts, null labels don't; without labels of both kinds every score is the share of toxic labels (0 if none); an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _arrow_type
from .common import cut, hold_out, parts, tidy

SAMPLE, LEAST_DOCS, LEAST_SPREAD, THRESHOLD = 20_000, 4, 2.0, 0.7
#: Tokens whose readings a worker keeps: while scoring (those of most tokens are empty) and while learning (words and beginnings).
KEPT_TOKENS, KEPT_LEARNED = 250_000, 80_000
SYMBOLS = 96

# What signs and digits can stand for.
STANDS_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
PARTS = ".-_*~'`^"
# Costs in nats: reading a sign as a letter, keeping it, dropping a parting sign, folding a held letter, holding a double.
LETTER, KEEP, DROP, FOLD, DOUBLE = 0.7, 6.0, 0.3, 0.2, 2.5
# Nats by which a reading of borders may be dearer than the cheapest for its words to count.
SLACK = 6.0

DISGUISED = re.compile(r"[^\W\d_][\d@$!|+€.\-_*~'`^]+[^\W\d_]|^[\d@$!|+€]+[^\W\d_]{2}|[^\W\d_]{2}[\d@$|+€]+$|([^\W\d_])\1\1")
SPACED = re.compile(r"(?<!\S)(?:[^\W\d_]|[\d@$!|])(?: (?:[^\W\d_]|[\d@$!|]))+(?!\S)")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def _symbol_table() -> np.ndarray:
    """Code points below 0x250 -> symbols: 0 space, 1 anything else, letters from 2 on."""
    out = np.ones(0x250 + 1, np.int64)
    out[[9, 10, 11, 12, 13, 32]] = 0
    letters = [c for c in range(0x250) if chr(c).isalpha() and chr(c) == chr(c).lower()][: SYMBOLS - 2]
    out[letters] = 2 + np.arange(len(letters))
    return out


_TABLE = _symbol_table()


def symbols(text: str) -> np.ndarray:
    return _TABLE[np.minimum(np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32), 0x250)]


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(SYMBOLS,) * 3 counts over all whole texts; the table's size doesn't depend on the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for b in batches:
            texts, n = [], 0
            for t in [*b.column(0), None]:
                if t is None or n > 500_000:
                    s = symbols("  ".join(texts) + " ")
                    np.add(total, np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3), out=total) if len(s) > 2 else None
                    texts, n = [], 0
                if t is not None and (t := t.as_py()):
                    texts.append(t)
                    n += len(t)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(SYMBOLS**3, np.int64)
    sums = docs.select(text_col).mapInArrow(tidy(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # as many rows as trigrams
    out[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def log_model(counts: np.ndarray) -> np.ndarray:
    """-log p(c | a, b): trigram, bigram and single counts mixed."""
    c = counts.astype(float)
    one = (c.sum((0, 1)) + 1) / (c.sum() + SYMBOLS)
    two = (c.sum(0) + 20 * one) / (c.sum((0, 2))[:, None] + 20)
    three = (c + 10 * two[None]) / (c.sum(2)[:, :, None] + 10)
    return -np.log(three).astype(np.float32)


def decode(word: str, model: np.ndarray, borders: bool = False) -> str:
    """The cheapest reading of a disguised word; with borders, of words run together, spaces between them.

    Readings are chains (letter, chain before), so that time and memory grow with the length of the word alone.
    """
    at, cost_of = _TABLE, model.item
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    prev = ""
    for ch in word:
        options = [(LETTER, c, int(at[min(ord(c), 0x250)])) for c in STANDS_FOR.get(ch, "")]
        if ch.isalpha():
            options.append((0.0, ch, int(at[min(ord(ch), 0x250)])))
        elif ch not in PARTS:
            options.append((KEEP, ch, int(at[min(ord(ch), 0x250)])))
        dropped, held = ch in PARTS or not ch.isalnum(), ch == prev
        if borders:
            for (a, b), (cost, read) in list(best.items()):
                if b:  # a word may end here
                    total = cost + cost_of(a, b, 0)
                    if (b, 0) not in best or total < best[b, 0][0]:
                        best[b, 0] = (total, (" ", read))
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, read) in best.items():
            ways = [(cost + (DOUBLE if held and read and read[0] == c else 0) + w + cost_of(a, b, s), (b, s), (c, read)) for w, c, s in options]
            if dropped:
                ways.append((cost + DROP, (a, b), read))
            if held and read:
                ways.append((cost + FOLD, (a, b), read))
            for total, state, said in ways:
                if state not in step or total < step[state][0]:
                    step[state] = (total, said)
        best, prev = step or best, ch
    ends = [(c + cost_of(a, b, 0), r) for (a, b), (c, r) in best.items()]
    least = min((c for c, _ in ends), default=0.0)
    return min((_spelled(r) for c, r in ends if c == least), default=word)


def _spelled(chain: tuple | None) -> str:
    out = []
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return "".join(reversed(out))


def word_borders(letters: str, model: np.ndarray) -> list[str]:
    """The distinct words of all readings with borders that cost at most SLACK more than the cheapest, by place."""
    s = _TABLE[np.minimum(np.array([ord(c) for c in letters], np.int64), 0x250)]
    n = len(s)
    before = np.r_[0, s[:-1]]
    first, second = model[before, 0, s], model[0, before, s]
    inner = np.r_[0.0, np.cumsum(model[np.r_[0, 0, s[:-2]][:n], before, s].astype(float))]
    close = model[before, s, 0]  # of a word that ends with this letter

    def row(i: int) -> np.ndarray:
        """The cost of the word from i to each end."""
        out = np.empty(n - i)
        out[0] = first[i] + model[0, s[i], 0]
        if n - i > 1:
            out[1:] = first[i] + second[i + 1] + (inner[i + 2 :] - inner[i + 2]) + close[i + 1 :]
        return out

    ahead, behind = np.full(n + 1, np.inf), np.zeros(n + 1)
    ahead[0] = 0.0
    for i in range(n):
        np.minimum(ahead[i + 1 :], ahead[i] + row(i), out=ahead[i + 1 :])
    for i in range(n - 1, -1, -1):
        behind[i] = (row(i) + behind[i + 1 :]).min()
    most, out = behind[0] + SLACK, {}
    for i in range(n):
        if ahead[i] + behind[i] <= most:
            for j in np.flatnonzero(ahead[i] + row(i) + behind[i + 1 :] <= most).tolist():
                out[letters[i : i + j + 1]] = None
    return list(out)


class Restorer:
    """Texts -> their restored words; what a disguised word stands for is worked out once."""

    def __init__(self, model: np.ndarray):
        self.model = model

    def token(self, token: str) -> str:
        core = EDGES.sub("", token) if not token.isalpha() else token
        if core and not core.isalpha():
            hidden = token if DISGUISED.search(token) else core
            if DISGUISED.search(hidden):
                return EDGES.sub("", decode(hidden, self.model))
        elif core and DISGUISED.search(core):
            return decode(core, self.model)
        return core

    def spaced(self, text: str) -> list[str]:
        """Words read from letters spaced out, their borders placed by the model; the text may hold others beside them."""
        return [w for m in SPACED.finditer(text) for w in word_borders(decode(m[0].replace(" ", ""), self.model, borders=True).replace(" ", ""), self.model)]


def beginnings(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) > k)] if word else []


def readings(texts: list[str], restorer: Restorer, cache: dict, make, kept: int = KEPT_TOKENS) -> Iterator[set]:
    """For each text the set of what make() gives for its restored words. cache: by raw token, kept entries at most."""
    for t in texts:
        t = t.lower()
        tokens = set(t.split())
        if new := tokens.difference(cache):
            if len(cache) + len(new) > kept:
                cache.clear()
                new = tokens
            for w in new:
                cache[w] = make(restorer.token(w))
        out = set().union(*filter(None, map(cache.__getitem__, tokens)))
        for w in restorer.spaced(t):
            out.update(make(w))
        yield out


class Classifier:
    """Weights of features and their sum for no evidence."""

    def __init__(self, bias: float, weights: dict[str, float], model: np.ndarray):
        self.bias, self.weights, self.model = bias, weights, model


def _fit(rows: list[np.ndarray], y: np.ndarray, n: int) -> tuple[float, np.ndarray]:
    """Logistic regression with a quadratic penalty, by accelerated gradient steps, over rows of feature numbers."""
    order = np.lexsort((np.array([zlib.crc32(r.tobytes()) for r in rows]), y))  # sums don't depend on the order of the rows
    rows, y = [rows[k] for k in order], (y[order] != 0).astype(float)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.concatenate(rows) if n else np.zeros(0, np.int32)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w, b, penalty = np.zeros(n), math.log(share / (1 - share)), 2e-4
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, 401):
        z = b + np.bincount(of, w[at], len(rows))
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g, gb = np.bincount(at, e[of], n) / len(rows) + penalty * w, e.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * (1 if step < 200 else 0.3)
        c1, c2 = 1 - 0.9**step, 1 - 0.99**step
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b = b - rate * (mb / c1) / (math.sqrt(vb / c2) + 1e-8)
    return float(b), w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic") -> Classifier:
    """Count the character model over all docs and fit the classifier on at most sample labelled rows."""
    model = log_model(trigram_counts(docs, text_col))
    known = labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull() & ~hold_out(F.col(label_id)))
    known = known.groupBy(F.col(label_id).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)  # its size is bounded by sample
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id").select("text", "y")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, cache = Restorer(model), {}
        for b in (p for b in batches for p in parts(b, 0)):
            found = [sorted(s) for s in readings([t or "" for t in b.column(0).to_pylist()], restorer, cache, beginnings, KEPT_LEARNED)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), b.column(1)], names=["features", "y"])

    seen = cut(rows.mapInArrow(tidy(words), "features array<string>, y int"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for b in batches:
            for fs, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for f in fs:
                    n[f][1 if y else 0] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([v[0] for v in n.values()], pa.int64()), pa.array([v[1] for v in n.values()], pa.int64())], names=["f", "clean", "toxic"])

    clean, toxic = (seen.agg(F.count(F.when(F.col("y") == 0, 1)), F.count(F.when(F.col("y") != 0, 1))).first())
    if not clean or not toxic:
        share = min(max(toxic / max(1, clean + toxic), 1e-9), 1 - 1e-9)
        return Classifier(math.log(share / (1 - share)), {}, model)
    counts = seen.mapInArrow(tidy(count), "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("clean") + F.col("toxic") >= LEAST_DOCS)
    n = F.col("clean") + F.col("toxic")
    expected = n * (toxic / (clean + toxic))
    spread = (F.col("toxic") - expected) / F.sqrt(expected * (clean / (clean + toxic)))
    place = {r[0]: k for k, r in enumerate(counts.where(F.abs(spread) >= LEAST_SPREAD).select("f").orderBy("f").collect())}  # of at most sample rows

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [np.array([place[f] for f in fs if f in place], "<i4").tobytes() for fs in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), b.column(1)], names=["at", "y"])

    rows = seen.mapInArrow(tidy(vectors), "at binary, y int").toArrow()  # at most sample rows
    bias, w = _fit([np.frombuffer(x, "<i4") for x in rows.column(0).to_pylist()], rows.column(1).to_numpy(), len(place))
    return Classifier(bias, {f: float(w[k]) for f, k in place.items()}, model)


def score(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, score, keep...) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    kept = [c for c in keep if c not in (id_col, text_col)]
    names = [id_col, text_col, *kept]
    arrow = pa.schema([*[(f"c{k}", _arrow_type(docs, c)) for k, c in enumerate(names)], ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        restorer, cache = Restorer(c.model), {}
        weights = c.weights
        known = lambda w: tuple(f for f in beginnings(w) if f in weights)
        for b in (p for b in batches for p in parts(b, 1)):
            out = []
            for found in readings([t or "" for t in b.column(1).to_pylist()], restorer, cache, known):
                z = c.bias + math.fsum(weights[f] for f in found)
                out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
            yield pa.RecordBatch.from_arrays([*[x.cast(f.type) for x, f in zip(b.columns, arrow, strict=False)], pa.array(out, pa.float64())], schema=arrow)

    sql = ", ".join(f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(names))
    out = docs.select(*[docs[c].alias(f"c{k}") for k, c in enumerate(names)]).mapInArrow(tidy(run), f"{sql}, score double")
    return out.select(F.col("c0").alias("id"), "score", *[F.col(f"c{k}").alias(c) for k, c in enumerate(names) if c == text_col and c in keep or c in kept])


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **names) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    out = score(docs, train(docs, labels, **names))
    return out.select("id", F.coalesce(hold_out(F.col("id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
