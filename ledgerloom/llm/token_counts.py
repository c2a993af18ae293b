"""Token counts by heap and linked list.

A word's symbols form a doubly linked list and its known pairs a heap by (rank, place). The lowest pair is popped, merged if
both its ends are still what they were, and the pairs beside it are pushed. The count is the number of symbols at the start
less the number of merges; no ids are given out.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows each give a row; null ids pass through; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytebpe
from .bpe import _arrow_type
from .common import arrow_map, holds, narrow

#: Bytes that a worker's tables of words and pieces may take, counted as characters and ENTRY_BYTES more for each.
KEPT_BYTES, ENTRY_BYTES = 80_000_000, 100


def count_word(bpe: bytebpe.ByteBPE, word: bytes) -> int:
    """Tokens of one word: symbols at first, less merges. A heap entry is rank * 2**32 + place; it is stale when the pair
    that now starts at the place has another rank."""
    n = len(word)
    if n < 2:
        return n
    size, rank_of, by_rank = bpe.size, bpe.rank_of, bpe.by_rank
    sym = [bpe.byte_list[b] for b in word]
    rank = [rank_of.get(a * size + b, -1) for a, b in zip(sym, sym[1:], strict=False)]
    rank.append(-1)
    heap = [(r << 32) + i for i, r in enumerate(rank) if r >= 0]
    if not heap:
        return n
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        i, r = entry & 0xFFFFFFFF, entry >> 32
        if rank[i] != r:
            continue
        merges += 1
        made, j = by_rank[r], after[i]
        sym[i], rank[j] = made, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            rank[i] = r = rank_of.get(made * size + sym[k], -1)
            if r >= 0:
                heappush(heap, (r << 32) + i)
        else:
            rank[i] = -1
        if (h := before[i]) >= 0:
            rank[h] = r = rank_of.get(sym[h] * size + made, -1)
            if r >= 0:
                heappush(heap, (r << 32) + h)
    return n - merges


class Counter:
    """Counts tokens; keeps the counts of the words and pieces it has met."""

    def __init__(self, path: str):
        self.bpe = bytebpe.ByteBPE(path)
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = dict.fromkeys(self.bpe.special, 1)
        self.pieces: dict[str, int] = {}
        self.kept = 0

    def word(self, w: str) -> int:
        n = self.words[w] = count_word(self.bpe, w.encode())
        self.kept += len(w) + ENTRY_BYTES
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        ps, new = bytebpe.pieces(text, self.pieces, self.bpe.special_pattern)
        if new:
            if self.kept > KEPT_BYTES:
                self.forget()
                new = set(ps)
            self.kept += sum(map(len, new)) + ENTRY_BYTES * len(new)
            split = self.bpe.words
            for p in new:
                self.pieces[p] = sum([self.words.get(w) or self.word(w) for w in split(p)])
        return sum(map(self.pieces.__getitem__, ps))


_counters: dict[str, Counter] = holds("token_counts")


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every whole text."""

    def run(b):
        c = counter(tokenizer)
        n = [c.count(t or "") for t in b["text"]]
        return {"id": b["id"], "n_bytes": [len((t or "").encode()) for t in b["text"]], "n_tokens": n, "over_limit": [x > limit for x in n]}

    arrow = pa.schema([("id", _arrow_type(docs, id_col)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(narrow(docs, id=id_col, text=text_col), run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean", arrow, "token_counts")
