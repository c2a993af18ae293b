"""Benchmark decontamination by Wu-Manber search for many patterns at once.

A text is a row of words: A-Z lower-cased, every ASCII character other than a letter or digit between words. The patterns are
the windows of the benchmark: WINDOW words, or all of a shorter item. Patterns of one length are searched together: a table of
blocks of two neighbouring words tells how far the search may go on without missing an occurrence; where it says 0, the bucket
of the block is looked up and its patterns are compared word by word.

The benchmark is a set of queries against all rows. It is dealt by hash into as many blocks as its bytes make up BLOCK_BYTES.
Each block is searched in a pass of its own over the documents, which adds to the words hit and items found so far; what a pass
made is written to the shared checkpoint folder before the next, so that one block at a time is in memory.

Defined results: a null or empty text has no words and no hits; an item without words has no windows; items of equal text are
all reported; a null item id is left out; repeated rows each give a row; an empty benchmark gives no hits; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _arrow_type
from .common import cut, parts, tidy

WINDOW = 10
BLOCK_BYTES = 8 << 20

_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class Patterns:
    """The shift table and buckets of patterns of one length."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        b = self.block
        for end in range(b, self.length + 1):
            key = pattern[end - b : end]
            self.shift[key] = min(self.shift.get(key, self.far), self.length - end)
        self.bucket.setdefault(pattern[self.length - b :], {}).setdefault(pattern, set()).add(item)

    def search(self, text: list[bytes], found: set[str]) -> Iterator[int]:
        """Starts of occurrences; the items they belong to go to found."""
        length, b, far, shift = self.length, self.block, self.far, self.shift.get
        pairs = text if b == 1 else list(zip(text, text[1:], strict=False))
        at, last = length - b, len(pairs)  # of the block that ends the window
        while at < last:
            key = (pairs[at],) if b == 1 else pairs[at]
            step = shift(key, far)
            if step:
                at += step
                continue
            start = at + b - length
            for pattern, items in self.bucket[key].items():
                if text[start] == pattern[0] and tuple(text[start : start + length]) == pattern:
                    found |= items
                    yield start
            at += 1


class Matcher:
    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.by_length: dict[int, Patterns] = {}
        for item, text in items:
            ws = words(text)
            n = min(window, len(ws))
            for k in range(len(ws) - n + 1) if n else ():
                self.by_length.setdefault(n, Patterns(n)).add(tuple(ws[k : k + n]), item)

    def find(self, ws: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged [first, end) ranges of the words hit, and the items found."""
        found: set[str] = set()
        hits = sorted([s, s + p.length] for p in self.by_length.values() if p.length <= len(ws) for s in p.search(ws, found))
        return merge(hits), found


def merge(ranges: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _numbered(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> tuple[DataFrame, int]:
    """The distinct items (item, text, block), and the number of blocks."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("item is not null and text is not null").distinct()
    blocks = -(-(items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // size) or 1
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))), blocks


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, keep..., n_words, ranges, items): the word ranges of each document that lie in a window's occurrence."""
    numbered, blocks = _numbered(benchmark, item_col, item_text_col, block_bytes)
    kept = [c for c in keep if c not in (id_col, text_col)]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"kept_{c}") for c in kept], F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<int>>").alias("ranges"), F.array().cast("array<string>").alias("items"))
    arrow = pa.schema([("id", _arrow_type(docs, id_col)), ("text", pa.string()), *[(f"kept_{c}", _arrow_type(docs, c)) for c in kept], ("n_words", pa.int64()), ("ranges", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string()))])
    shape = out.schema
    for block in range(blocks):
        items = [(r[0], r[1]) for r in numbered.where(F.col("block") == block).select("item", "text").collect()]  # some block_bytes
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, window)
            for b in (p for b in batches for p in parts(b, 1)):
                n, ranges, found = [], [], []
                for t, r, f in zip(b.column("text"), b.column("ranges").to_pylist(), b.column("items").to_pylist(), strict=True):
                    ws = words(t.as_py())
                    own, items = matcher.find(ws)
                    n.append(len(ws))
                    ranges.append(merge(r + own) if own else r)
                    found.append(sorted({*f, *items}))
                cols = [b.column(k) for k in range(b.num_columns - 3)]
                yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(cols, arrow, strict=False)], pa.array(n, pa.int64()), pa.array(ranges, arrow.field("ranges").type), pa.array(found, arrow.field("items").type)], schema=arrow)

        out = out.mapInArrow(tidy(run), shape)
        if block < blocks - 1:
            out = cut(out)
    return out


def report(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    h = hits(docs, benchmark, **names)
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda s, r: s + (r[1] - r[0]).cast("long"))
    return h.select("id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def sha256_of(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
