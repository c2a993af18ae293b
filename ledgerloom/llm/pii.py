"""Personal data: rule-based spans and candidates chosen by boosted trees, all in DataFrame functions.

Base kinds (email, ip, card, phone) are the leftmost matches of their patterns that pass their checks. Further generators
with high recall propose spans that may overlap: long tokens with digits (secret), long numbers (number) and addresses spelled
out (handle). Features of a candidate's form and of the text around it go through boosted trees, which are written out as CASE
expressions; a threshold per kind, calibrated on examples apart from those of training, selects the spans to add. The trees
are trained on a fixed number of made-up examples, whose features come from the same expressions.

Patterns are anchored so that scanning is linear: a match can begin only where a run of its first class begins or where the
last match ended, which is where the plain pattern's leftmost match begins too.

Defined results: null and empty texts have no spans; positions are code points, ends exclusive; repeated rows each give a row;
null ids pass through; an empty table gives an empty result; only the named columns are read. Added spans that overlap base
spans are left out; of added spans that overlap, the one that begins first stays, of those the longer.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE, ADDED = ("email", "ip", "card", "phone"), ("secret", "number", "handle")
KINDS = BASE + ADDED

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+",
    "number": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){8,18}(?![0-9])",
    "handle": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]++ ?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot ) ?[A-Za-z]{2,}+",
}

# Words near a candidate that speak for it.
NEAR = {"secret": "token|secret|passw|pwd|api|auth|key|bearer", "number": "card|acc|iban|visa|ssn|passport|id", "contact": "call|tel|phone|fax|mail|contact|write"}
EXAMPLES, TREES, RATE = 1600, 24, 0.3
#: Items of a list that one fold goes through.
BLOCK = 128


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")


def _quick(text: Column, kind: str) -> Column:
    """False where the pattern can't match; cheaper than the pattern."""
    return {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
        "phone": text.contains("+"),
        "secret": text.rlike("[A-Za-z0-9+/_=-]{16}") & text.rlike("[0-9]"),
        "number": text.rlike(r"[0-9](?:[\x20.-]?[0-9]){8}"),
        "handle": (text.contains("at)") | text.contains("at]") | text.contains("at}") | text.contains(" at ")) & text.rlike(r"(?:[(\[{]at[)\]}]| at ) ?[A-Za-z0-9-]+ ?(?:\.|[(\[{]dot[)\]}]| dot ) ?[A-Za-z]{2}"),
    }[kind]


def _zipped(text: Column, kind: str) -> Column:
    """(value, before, after) of each match; before and after are the text between matches."""
    found, parts = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0), F.split(text, PATTERNS[kind], -1)

    def zipped(between: Column) -> Column:
        n = F.size(between) - 1
        rows = F.arrays_zip(found.alias("value"), F.slice(between, 1, n).alias("before"), F.slice(between, 2, n).alias("after"))
        return F.transform(rows, lambda x: F.struct(x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after")))

    return F.flatten(F.transform(F.array(parts), zipped))  # the text is parted once


def scan(items: Column, zero: Column, value, join) -> Column:
    """For each item, join of zero and the values of all items before it (join is associative).

    A fold that appends copies what it has made; done in blocks of BLOCK items whose joined values are scanned first, the cost
    stays close to the number of items.
    """
    blocks = F.transform(F.sequence(F.lit(0), F.size(items).cast("int"), F.lit(BLOCK)), lambda i: F.slice(items, i + 1, F.lit(BLOCK)))

    def within(block: Column, base: Column) -> Column:
        return F.aggregate(block, F.struct(base.alias("at"), F.array_repeat(base, 0).alias("out")), lambda acc, x: F.struct(join(acc["at"], value(x)).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    whole = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda acc, x: join(acc, value(x))))
    bases = F.aggregate(whole, F.struct(zero.alias("at"), F.array_repeat(zero, 0).alias("out")), lambda acc, x: F.struct(join(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), bases.alias("base")), lambda p: within(p["block"], p["base"])))


def matches(text: Column, kind: str) -> Column:
    """array<(start, end, value, before, after)>: before has 24 characters at most, after 4."""

    def placed(found: Column) -> Column:
        ends = scan(found, F.lit(0), lambda m: F.length(m["before"]) + F.length(m["value"]), lambda x, y: x + y)

        def one(p: Column) -> Column:
            m = p["m"]
            start = p["at"] + F.length(m["before"])
            return F.struct(start.alias("start"), (start + F.length(m["value"])).alias("end"), m["value"].alias("value"), F.right(m["before"], F.lit(24)).alias("before"), F.left(m["after"], F.lit(4)).alias("after"))

        return F.transform(F.arrays_zip(found.alias("m"), ends.alias("at")), one)

    # the matches once, what is made of them over them
    return F.when(_quick(text, kind), F.flatten(F.transform(F.array(_zipped(text, kind)), placed))).otherwise(_none())


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        d = F.coalesce(F.substring(digits, F.length(digits) - i + 1, F.lit(1)).try_cast("int"), F.lit(0))
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def passes(value: Column, kind: str) -> Column:
    """The check of a base kind."""
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def features(m: Column, kind: str) -> Column:
    """array<double> of a candidate's form and surroundings."""
    value, before = m["value"], F.lower(m["before"])
    digits = F.length(_digits(value))
    upper, lower = F.length(F.regexp_replace(value, "[^A-Z]", "")), F.length(F.regexp_replace(value, "[^a-z]", ""))
    flags = [
        F.when(F.length(_digits(value)).between(12, 19), luhn(_digits(value))).otherwise(False),
        value.rlike("^[0-9A-Fa-f]+$"),
        before.rlike(NEAR["secret"]),
        before.rlike(NEAR["number"]),
        before.rlike(NEAR["contact"]),
        before.rlike("[=:#][\\x20\"']*$"),
        m["after"].rlike("^[\"']"),
    ]
    return F.array(*[x.cast("double") for x in (F.lit(ADDED.index(kind)), F.length(value), digits, upper, lower, F.length(value) - digits - upper - lower, *flags)])


def _features_of(kind: str):
    return lambda m: features(m, kind)


def _ranked(kind: str):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def examples(n: int = EXAMPLES) -> list[tuple[str, str, int]]:
    """(kind, text with one candidate, whether it is to be redacted): made up, the same every time."""
    r = random.Random(11)
    word = lambda k=0: "".join(r.choice("etaoinshrdlu") for _ in range(k or r.randint(2, 8)))
    some = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    hexa, mixed, num = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789"
    out = []
    for k in range(n):
        kind, y, lead = ADDED[k % 3], r.randint(0, 1), f"{word()} {word()} "
        if kind == "secret" and y:
            value = "7" + (some(hexa, r.choice([31, 39, 63])) if r.random() < 0.6 else some(mixed, r.randint(19, 50)))
            text = lead + (r.choice(["token = \"{}\"", "api_key: {} ", "secret='{}'", "password = {} ", "auth {} "]).format(value) if r.random() < 0.8 else f"\"{value}\"")
        elif kind == "secret":
            text = lead + r.choice([f"{word(9)}-{word(8)}-{r.randint(1, 99)} ", f"/{word(8)}/{word(9)}/{r.randint(1, 2030)} ", f"{some(num, 17)} ", f"{word(18)}2 ", f"page_{word(10)}_{r.randint(1, 40)} "])
        elif kind == "number" and y:
            text = lead + r.choice(["card ", "account no ", "iban ", "ssn: ", "call ", "tel: ", "passport "]) + r.choice([some("123456789", 16), f"{some('123456789', 3)}-{some('123456789', 3)}-{some('123456789', 4)}", some("123456789", 10)]) + " "
        elif kind == "number":
            text = lead + r.choice([some("123456789", r.randint(9, 19)), f"1{some(num, 3)}-{some(num, 2)}-{some(num, 2)} {some(num, 3)}", f"{some(num, 3)}.{some(num, 3)}.{some('123456789', 3)}"]) + " "
        elif y:
            at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot "), (" (at) ", ".")])
            text = f"{lead}{word()}.{word()}{at}{word()}{dot}{r.choice(['com', 'org', 'net', 'de'])} "
        else:
            text = f"{lead}{word()} at {word()}{r.choice(['.', '. '])}{word().capitalize()} "
        out.append((kind, text, y))
    return out


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int):
    """A regression tree of second-order gains: a leaf's value or (feature, threshold, below, above)."""
    leaf = float(-grad.sum() / (hess.sum() + 1.0))
    if not depth or len(x) < 20:
        return leaf
    score = lambda g, h: g * g / (h + 1.0)
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        for t in np.unique(x[:, f])[:-1]:
            below = x[:, f] <= t
            gain = score(grad[below].sum(), hess[below].sum()) + score(grad[~below].sum(), hess[~below].sum()) - score(grad.sum(), hess.sum())
            if gain > best[0]:
                best = (gain, f, float(t))
    if best[1] is None:
        return leaf
    below = x[:, best[1]] <= best[2]
    return best[1], best[2], _tree(x[below], grad[below], hess[below], depth - 1), _tree(x[~below], grad[~below], hess[~below], depth - 1)


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], _value(tree[2], x), _value(tree[3], x))


def boost(x: np.ndarray, y: np.ndarray) -> list:
    z, trees = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        trees.append(_tree(x, p - y, p * (1 - p), 2))
        z += RATE * _value(trees[-1], x)
    return trees


def _column(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(round(tree, 6))
    return F.when(f[tree[0]] <= tree[1], _column(tree[2], f)).otherwise(_column(tree[3], f))


class Chooser:
    """Trees and the threshold of each added kind."""

    def __init__(self, trees: list, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def chosen(self, m: Column, kind: str) -> Column:
        f = features(m, kind)
        # the features once, the trees over them
        total = F.element_at(F.transform(F.array(f), lambda v: sum((_column(t, v) for t in self.trees[1:]), _column(self.trees[0], v)) * RATE), 1)
        return total >= self.thresholds[kind]


@lru_cache(maxsize=1)
def _trained() -> tuple[list, tuple]:
    spark = SparkSession.active()
    rows = []
    frame = spark.createDataFrame([(k, *e) for k, e in enumerate(examples())], "n int, kind string, text string, y int").coalesce(1)
    for kind in ADDED:
        own = frame.where(F.col("kind") == kind).select("n", "y", F.transform(matches(F.col("text"), kind), _features_of(kind)).alias("f"))
        rows += [(r.n, r.y, x) for r in own.collect() for x in r.f]  # a fixed number of examples
    rows.sort(key=lambda r: (r[0], r[2]))
    x, y, n = np.array([r[2] for r in rows]), np.array([r[1] for r in rows], float), np.array([r[0] for r in rows])
    fit = n // 3 % 2 == 0
    trees = boost(x[fit], y[fit])
    z = RATE * sum(_value(t, x) for t in trees)
    thresholds = []
    for k in range(len(ADDED)):  # the threshold of best F1 on the other half, in the middle of the gap it lies in
        own = ~fit & (x[:, 0] == k)
        cuts = np.unique(z[own])
        f1 = [2 * ((z[own] >= c) & (y[own] == 1)).sum() / max(1, (z[own] >= c).sum() + (y[own] == 1).sum()) for c in cuts]
        at = int(np.argmax(f1))
        thresholds.append(float((cuts[at] + cuts[at - 1]) / 2 if at else cuts[at]))
    return trees, tuple(thresholds)


def chooser() -> Chooser:
    trees, thresholds = _trained()
    return Chooser(trees, dict(zip(ADDED, thresholds, strict=True)))


def _selected(text: Column, kind: str, c: Chooser) -> Column:
    return F.filter(matches(text, kind), (lambda m: passes(m["value"], kind)) if kind in BASE else (lambda m: c.chosen(m, kind)))


def _decided(docs: DataFrame) -> DataFrame:
    """docs (key, text) with base, the base spans, and spans, those and the added ones, by start, then kind."""
    c = chooser()
    found = docs.select("key", "text", *[_selected(F.col("text"), k, c).alias(k) for k in KINDS])
    ranked = found.select("key", "text", *[F.transform(F.col(k), _ranked(k)).alias(k) for k in KINDS])
    both = ranked.select("key", "text", F.array_sort(F.concat(*BASE)).alias("base"), F.array_sort(F.concat(*ADDED)).alias("added"))
    both = both.withColumn("added", F.when(F.size("added") > 0, _apart(F.col("base"), F.col("added"))).otherwise(F.col("added")))
    return both.select("key", "text", "base", F.array_sort(F.concat("base", "added")).alias("spans"))


def _apart(base: Column, added: Column) -> Column:
    """The added spans that overlap no base span and, of those left, no other that begins first (or there and is longer, or ranks lower)."""
    top, most = F.lit(0), lambda x, y: F.greatest(x, y)

    def free(both: Column) -> Column:
        """both: all spans by start, base ones first. Reach of the base ones before each, start of the next one after it."""
        back = F.reverse(both)
        reach = scan(both, top, lambda s: F.when(s["added"], 0).otherwise(s["end"]), most)
        coming = F.reverse(scan(back, F.lit(2**31 - 1), lambda s: F.when(s["added"], 2**31 - 1).otherwise(s["start"]), lambda x, y: F.least(x, y)))
        clear = F.filter(F.arrays_zip(both.alias("s"), reach.alias("reach"), coming.alias("coming")), lambda p: p["s"]["added"] & (p["reach"] <= p["s"]["start"]) & (p["coming"] >= p["s"]["end"]))
        return F.transform(clear, lambda p: p["s"])

    def first(spans: Column) -> Column:
        reach = scan(spans, top, lambda s: s["end"], most)
        return F.transform(F.filter(F.arrays_zip(spans.alias("s"), reach.alias("reach")), lambda p: p["reach"] <= p["s"]["start"]), lambda p: F.struct(*[p["s"][c].alias(c) for c in ("start", "rank", "kind", "end")]))

    def marked(spans: Column, added: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(added).alias("added"), (-s["end"]).alias("far"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))

    once = lambda make, x: F.flatten(F.transform(F.array(x), make))
    return once(first, once(free, F.array_sort(F.concat(marked(base, False), marked(added, True)))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): array<(start, rank, kind, end)> of base and added spans by start, then kind."""
    rows = docs.select(F.col(id_col).alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))
    return _decided(rows).select(F.col("key").alias("id"), "base", "spans")


def _shown(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, **names) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_number, n_handle, n_spans) of every document."""
    f = find(docs, **names)
    counts = {k: F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS}
    shown = F.sha2(F.encode(_shown("base"), "UTF-8"), 256).alias("base_sha256"), _shown("spans").alias("spans")
    return f.select("id", *[counts[k] for k in BASE], *shown, *[counts[k] for k in ADDED], F.size("spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the spans of find() replaced by their kinds in brackets; base spans that overlap give way to the first's kind."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))
    text, first = F.col("text"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        plain = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], plain, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    end = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    masked = F.when(F.size("spans") > 0, F.aggregate("spans", first, step, end)).otherwise(F.col("key")[text_col])
    out = _decided(rows).withColumn("masked", masked)
    return out.select(*[F.col("masked").alias(c) if c == text_col else F.col("key")[c].alias(c) for c in docs.columns])
