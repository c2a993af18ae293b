"""Near-duplicate documents: MinHash signatures joined by a multi-index Hamming join, links confirmed on full sets.

A document's set holds the distinct shingles of ``width`` words. Its signature has SYMBOLS places of SYMBOL_BITS bits each, the
low bits of the set's smallest value under as many hash functions; two sets of Jaccard similarity s differ in a place with
probability 1 - s. Signatures within MOST_ERRORS places are found without loss: the places are split into CHUNKS chunks, and
as MOST_ERRORS < 2 * CHUNKS, one chunk at least has one error at most (pigeonhole). That error is enumerated:
each chunk gives a key for each place left out. At similarity 0.8, 40 places and 19 errors, a pair is missed once in
some 50,000 times; closer pairs far less often.

Groups of copies are never expanded. Equal sets fall into one class by their hash. Then, for each key, classes are matched
with the smallest class that has the key (an aggregate, so that hot keys don't gather), and each class takes the smallest of
those it met: one candidate link a class. Links are confirmed and components formed. Only keys under which several
components still meet are compared further: within such a key, classes of different components whose signatures are within
MOST_ERRORS places and whose sizes allow the similarity are held against each other on their full sets; large keys are
compared in blocks of BLOCK rows that spread over tasks. A block gives out its rows with their partners' places, not pairs, and
after the sets are in, only the links that join different components. So every link between different components is tried,
and a link inside a component can't change the result.

The first links are confirmed star by star: the texts of a star's members are sent to the text of its centre, hot centres in
several parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, integers, tidy
from .graph import components
from .wordhash import Words, mix

SYMBOLS, SYMBOL_BITS, CHUNKS, MOST_ERRORS = 40, 16, 10, 19
#: Rows of a key that are held against as many others in one task.
BLOCK = 300
#: Members of a centre that one part holds.
STAR_PART = 100
#: Words are parted by ASCII white space.
WORDS = Words(b"\x20\x09\x0a\x0b\x0c\x0d")

_rng = np.random.default_rng(20240229)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _rng.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text's word hashes, ascending. A text of fewer words has one shingle, all of it."""
    if not len(h):
        return h
    n = min(width, len(h))
    total = np.full(len(h) - n + 1, np.uint64(n), np.uint64)
    for k in range(n):
        total += h[k : len(h) - n + 1 + k] * _PLACE[k]
    return np.unique(mix(total))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first text, sets) of runs of texts of some 500 kB together."""
    for at, _, h, cuts in WORDS.pieces(texts, 1 << 19):
        yield at, [shingles(h[x:y], width) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, SYMBOLS) 16-bit symbols; the sets aren't empty."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), SYMBOLS), "<u2")
    for k in range(SYMBOLS):
        h = flat * _MUL[k]
        h ^= h >> np.uint64(29)
        h *= _MUL[-1 - k]
        out[:, k] = mix(np.minimum.reduceat(h, first)) & np.uint64(2**SYMBOL_BITS - 1)
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, SYMBOLS) 64-bit keys: for each chunk and each of its places, the chunk without that place."""
    out = np.empty(sig.shape, np.int64)
    edges = np.linspace(0, SYMBOLS, CHUNKS + 1).astype(int)
    for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        for gone in range(a, b):
            key = np.full(len(sig), np.uint64(c * 64 + gone - a + 1), np.uint64)
            for k in range(a, b):
                if k != gone:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, k].astype(np.uint64))
            out[:, gone] = key.view(np.int64)
    return out


def describe(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n_shingles, set_hash, sig): sig and set_hash are null for empty sets."""
    arrow = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, sets in shingle_sets(b.column(1), width):
                full = [s for s in sets if len(s)]
                sigs = iter(signatures(full)) if full else iter(())
                rows = [(len(s), xxhash.xxh3_128_digest(s.tobytes()), next(sigs).tobytes()) if len(s) else (0, None, None) for s in sets]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(sets)), *[pa.array([r[k] for r in rows], f.type) for k, f in enumerate(list(arrow)[1:])]], schema=arrow)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(tidy(run), "id long, n_shingles long, set_hash binary, sig binary")


def keyed(classes: DataFrame) -> DataFrame:
    """(key, id) rows of classes (id, sig): SYMBOLS for each class, less those that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, SYMBOLS)
                ids = np.asarray(b.column(0))
                for k in range(0, len(ids), 20_000):
                    keys = chunk_keys(sig[k : k + 20_000])
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids[k : k + 20_000], SYMBOLS))], names=["key", "id"])

    return classes.select("id", "sig").mapInArrow(tidy(run), "key long, id long")


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets. docs needs a row for each id."""
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_PART).cast("int").alias("parts"))
    asked = pairs.join(fan, "a").select("a", F.col("b").alias("id"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    asked = asked.unionByName(fan.select("a", F.col("a").alias("id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    star = asked.join(texts, "id").select("a", "part", "id", "text")
    star = star.repartition("a", "part").sortWithinPartitions("a", "part", (F.col("id") != F.col("a")), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            sets = (x for _, some in shingle_sets(batch.column(3), width) for x in some)
            for c, i, other in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), sets, strict=True):
                if c == i:
                    own = other
                    continue
                if not 100 * min(len(own), len(other)) >= percent * max(len(own), len(other)):
                    continue
                both = len(np.intersect1d(own, other, assume_unique=True))
                if both and 100 * both >= percent * (len(own) + len(other) - both):
                    a.append(c)
                    b.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return star.mapInArrow(tidy(run), "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.Array]]:
    """The columns of each run of rows that are equal in the first `keys` columns (integers); rows come sorted by them."""
    rest: list[pa.Array] | None = None
    for batch in batches:
        cols = [c if rest is None else pa.concat_arrays([r, c]) for c, r in zip(batch.columns, rest or batch.columns, strict=True)]
        if not len(cols[0]):
            continue
        new = np.zeros(len(cols[0]) - 1, bool)
        for c in cols[:keys]:
            new |= np.diff(np.asarray(c)) != 0
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield [c.slice(x, y - x) for c in cols]
        rest = [pa.concat_arrays([c.slice(cuts[-1])]) for c in cols]
    if rest is not None and len(rest[0]):
        yield rest


def _in_reach(rows: DataFrame, percent: int) -> DataFrame:
    """(block, at, id, comp, partners) from rows (key, i, j, side, id, comp, n, sig) sorted by (key, i, j).

    For each class of a block with partners in reach: its place in the block and the places of the partners it is to be held
    against. A pair is taken at the first of the keys that it shares, so it is taken once.
    """
    edges = np.linspace(0, SYMBOLS, CHUNKS + 1).astype(int)

    def first_shared(same: np.ndarray) -> np.ndarray:
        """The number of the first key each pair shares, from (pairs, SYMBOLS) equality of symbols."""
        out = np.full(len(same), SYMBOLS, np.int64)
        for a, b in reversed(list(zip(edges[:-1], edges[1:], strict=True))):
            wrong = (b - a) - same[:, a:b].sum(axis=1)
            only = a + np.argmin(same[:, a:b], axis=1)  # the place that differs if one does
            out = np.where(wrong == 0, a, np.where(wrong == 1, only, out))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, i, j, side, ids, comp, n, sig in _groups(batches, 3):
            if len(ids) < 2:
                continue
            side, ids, comp, n = (np.asarray(c) for c in (side, ids, comp, n))
            sig = np.frombuffer(b"".join(sig.to_pylist()), "<u2").reshape(-1, SYMBOLS)
            one = i[0].as_py() == j[0].as_py()
            left = np.flatnonzero(side == 0)
            right = left if one else np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            far = np.zeros((len(left), len(right)), np.uint8)
            for k in range(SYMBOLS):
                far += sig[left, k][:, None] != sig[right, k][None, :]
            low, high = np.minimum.outer(n[left], n[right]), np.maximum.outer(n[left], n[right])
            x, y = np.nonzero((far <= MOST_ERRORS) & (comp[left][:, None] != comp[right][None, :]) & (100 * low >= percent * high))
            x, y = left[x], right[y]
            if one:
                x, y = x[x < y], y[x < y]
            if not len(x):
                continue
            # which key this block is of: the one that all its rows share, told by any two of them
            mine = np.array([int(k) for k in np.flatnonzero(chunk_keys(sig[:1])[0] == key[0].as_py())])
            first = np.concatenate([first_shared(sig[x[c : c + 20_000]] == sig[y[c : c + 20_000]]) for c in range(0, len(x), 20_000)])
            own = np.isin(first, mine)
            x, y = x[own], y[own]
            if not len(x):
                continue
            order = np.argsort(x, kind="stable")
            x, y = x[order], y[order]
            used = np.unique(np.r_[x, y])
            begins, ends = np.searchsorted(x, used), np.searchsorted(x, used, side="right")
            block = int(mix(np.array([(key[0].as_py() * 1_000_003 + i[0].as_py() * 1_009 + j[0].as_py()) & (2**64 - 1)], np.uint64)).view(np.int64)[0])
            partners = [y[a:b].astype("<u2").tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), block)), pa.array(used.astype(np.int32)), pa.array(ids[used]), pa.array(comp[used]), pa.array(partners, pa.binary())], names=["block", "at", "id", "comp", "partners"])

    return rows.mapInArrow(tidy(run), "block long, at int, id long, comp long, partners binary")


def _confirm_blocks(reach: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) among the partners of each block, confirmed on full sets; no more of them than join its components."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = reach.join(texts, "id").select("block", "at", "id", "comp", "partners", "text").repartition(tasks, "block").sortWithinPartitions("block", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, at, ids, comp, partners, text in _groups(batches, 1):
            at, ids, root = np.asarray(at), np.asarray(ids).tolist(), {c: c for c in np.asarray(comp).tolist()}
            comp = np.asarray(comp).tolist()
            sets = [x for _, some in shingle_sets(text, width) for x in some]
            place = {p: k for k, p in enumerate(at.tolist())}

            def top(c: int, root=root) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            a, b = [], []
            for k, raw in enumerate(partners):
                mine = [place[p] for p in np.frombuffer(raw.as_py(), "<u2").tolist()]
                mine = [m for m in mine if top(comp[m]) != top(comp[k])]
                if not mine:
                    continue
                own, flat = sets[k], np.concatenate([sets[m] for m in mine])
                found = np.searchsorted(own, flat)
                found[found == len(own)] = 0
                size = np.array([len(sets[m]) for m in mine])
                both = np.add.reduceat((own[found] == flat).astype(np.int64), np.r_[0, np.cumsum(size)[:-1]])
                for m, linked in zip(mine, (100 * both >= percent * (len(own) + size - both)).tolist(), strict=True):
                    if linked and top(comp[m]) != top(comp[k]):
                        root[top(comp[m])] = top(comp[k])
                        a.append(min(ids[k], ids[m]))
                        b.append(max(ids[k], ids[m]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(tidy(run), "a long, b long")


def _one_row_each(docs: DataFrame) -> DataFrame:
    """docs (id, text) with the smallest text of each id; dealt out by id only where ids repeat at all."""
    repeated = docs.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    if repeated.isEmpty():
        return docs
    some = docs.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return docs.join(repeated, "id", "left_anti").unionByName(some)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document.

    Defined results: null or empty text, or one without words, has an empty set, is linked with nothing and is its own
    component; of rows that repeat an id the smallest text stands for the id, and each row gives a row; a null id has no
    component, is linked with nothing and is kept; an empty table gives an empty result; only the named columns are read.
    Ids are integers; others are refused.
    """
    every = docs.select(integers(docs, id_col).alias("id"), F.col(text_col).alias("text"))
    texts = _one_row_each(every.where("id is not null"))
    described = cut(describe(texts, "id", "text", width))
    copies = described.where("set_hash is not null").groupBy("set_hash").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = cut(copies.select(F.col("rep").alias("id"), "set_hash", "n", "sig"))
    equal = described.select("id", "set_hash").join(classes.select("set_hash", F.col("id").alias("a")), "set_hash").where("id != a").select("a", F.col("id").alias("b"))
    keys = keyed(classes)
    # written before it is joined: a join whose side is still an aggregate can't have its large partitions split
    least = cut(keys.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").drop("z"))
    shared = cut(keys.join(least, "key").select("key", "id", "a"))
    star = shared.where("id != a").groupBy("id").agg(F.min("a").alias("a")).select("a", F.col("id").alias("b"))
    links = cut(confirm(star, texts, "id", "text", width, percent))
    comp = components(links)
    placed = cut(shared.select("key", "id").join(comp, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("comp")))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).where("lo < hi")
    mixed = cut(mixed.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")))
    rows = placed.join(mixed, "key").join(classes.select("id", "n", "sig"), "id")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "comp", "n", "sig")
    # by number, not by size: what a block costs isn't told by its bytes
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    more = _confirm_blocks(cut(_in_reach(rows, percent)), texts, width, percent)
    comp = components(links.unionByName(more).unionByName(equal))
    out = described.select("id", "n_shingles").join(comp, F.col("id") == F.col("node"), "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    out = every.select("id").where("id is not null").join(out, "id").select("id", "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
    lone = describe(every.where("id is null"), "id", "text", width).select("id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(lone)
