"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round finds each pair's rank by binary search over the sorted pair
keys, takes the lowest rank of every word and merges all its occurrences from left to right; words without a known pair
leave the array. Only pairs beside a merge are searched again. Words repeat, so the ids of words seen by a worker are kept
in a table that is emptied when it is full; nothing but speed depends on it.

Defined results: null text counts as empty (no ids, empty decoded text); repeated rows each give a row; null ids pass
through; an empty table gives an empty result; only the named columns are read, so extra columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytebpe
from .common import arrow_map, holds, narrow, parts, tidy

#: What a worker keeps of the pieces it has met (bytes, some 160 more for each), and the characters of the texts whose new words merge together.
KEPT_BYTES, PIECE_BYTES, GROUP_CHARS = 56_000_000, 160, 2_000_000


def _search(bpe: bytebpe.ByteBPE, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = left * bpe.size + right
    at = np.searchsorted(bpe.keys, keys)
    at[at == len(bpe.keys)] = 0
    found = bpe.keys[at] == keys if len(bpe.keys) else np.zeros(len(keys), bool)
    return np.where(found, bpe.ranks[at], bytebpe.NONE), bpe.made[at]


def merge_rounds(bpe: bytebpe.ByteBPE, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols (in order) after all merges inside each word, and the word of each. word ascends."""
    done_sym, done_word = [], []
    rank, made = np.full(len(sym), bytebpe.NONE), np.zeros(len(sym), np.int64)  # of the pair that starts at each symbol
    within = np.flatnonzero(word[:-1] == word[1:])
    rank[within], made[within] = _search(bpe, sym[within], sym[within + 1])
    while len(sym):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[first, len(sym)])
        least = np.minimum.reduceat(rank, first)
        still = least != bytebpe.NONE
        if not still.all():
            stay = np.repeat(still, size)
            done_sym.append(sym[~stay])
            done_word.append(word[~stay])
            sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
            least, size = least[still], size[still]
            if not len(sym):
                break
        at = np.flatnonzero(rank == np.repeat(least, size))
        # equal symbols in a row overlap: of a run of chosen neighbours every other one merges
        if (at[1:] == at[:-1] + 1).any():
            begins = np.r_[True, at[1:] != at[:-1] + 1]
            offset = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at = at[offset % 2 == 0]
        sym[at] = made[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        now = at - np.arange(len(at))  # each merge before it took one place
        sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
        touched = np.zeros(len(sym), bool)
        touched[now] = True
        touched[now[now > 0] - 1] = True
        rank[touched] = bytebpe.NONE
        touched[-1] = False
        again = np.flatnonzero(touched)
        again = again[word[again] == word[again + 1]]
        rank[again], made[again] = _search(bpe, sym[again], sym[again + 1])
    if not done_sym:
        return sym, word
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


class Encoder:
    """Encodes texts; keeps the ids (as 32-bit integers in bytes) of the space-delimited pieces it has met."""

    def __init__(self, path: str):
        self.bpe = bytebpe.ByteBPE(path)
        self.known: dict[str, bytes] = {}
        self.kept = 0
        self.decimals = list(map(str, range(self.bpe.size)))

    def learn(self, new: list[str]) -> None:
        """Make self.known hold every piece of new."""
        words, owner, special = [], [], {}
        for k, p in enumerate(new):
            for w in self.bpe.words(p):
                if w in self.bpe.special:
                    special[len(words)] = self.bpe.special[w]
                    w = " "  # one symbol holds its place
                words.append(w.encode())
                owner.append(k)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.bpe.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        sym, word = merge_rounds(self.bpe, sym, np.repeat(np.arange(len(words)), lens))
        if special:
            for at in np.flatnonzero(np.isin(word, list(special))):
                sym[at] = special[int(word[at])]
        ends = (4 * np.cumsum(np.bincount(np.array(owner, np.int64)[word], minlength=len(new)))).tolist()
        flat, begin = sym.astype("<u4").tobytes(), 0
        for p, end in zip(new, ends, strict=True):
            self.known[p] = flat[begin:end]
            begin = end
        self.kept += len(flat) + sum(map(len, new)) + PIECE_BYTES * len(new)

    def forget(self) -> None:
        self.known.clear()
        self.kept = 0

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text. New words of many texts are merged together."""
        at = 0
        while at < len(texts):
            cuts, new, chars = [], set(), 0
            while at < len(texts) and chars < GROUP_CHARS:
                ps, unknown = bytebpe.pieces(texts[at], self.known, self.bpe.special_pattern) if texts[at] else ([], ())
                cuts.append(ps)
                new.update(unknown)
                chars += len(texts[at])
                at += 1
            if self.kept > KEPT_BYTES:
                self.forget()
                new = {p for ps in cuts for p in ps}
            self.learn(list(new)) if new else None
            for ps in cuts:
                yield np.frombuffer(b"".join(map(self.known.__getitem__, ps)), "<u4").tolist()

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def show(self, ids: list[int]) -> str:
        return ",".join(map(self.decimals.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bpe.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = holds("bpe")


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the ids of every whole text."""

    def run(b):
        e = encoder(tokenizer)
        return {"id": b["id"], "ids": list(e.encode_all([t or "" for t in b["text"]]))}

    arrow = pa.schema([("id", _arrow_type(docs, id_col)), ("ids", pa.list_(pa.int32()))])
    return arrow_map(narrow(docs, id=id_col, text=text_col), run, f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>", arrow, "bpe")


def decode(coded: DataFrame, tokenizer: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text): what the ids stand for, special tokens included; bad UTF-8 gives replacement characters."""

    def run(b):
        e = encoder(tokenizer)
        return {"id": b["id"], "text": [None if x is None else e.decode(x) for x in b["ids"]]}

    arrow = pa.schema([("id", _arrow_type(coded, id_col)), ("text", pa.string())])
    return arrow_map(narrow(coded, id=id_col, ids=ids_col), run, f"id {coded.schema[id_col].dataType.simpleString()}, text string", arrow, "bpe")


def _arrow_type(df: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[col].dataType)


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, ids array<int>, n_tokens, decoded, keep...) of every whole text."""
    arrow = pa.schema([(id_col, _arrow_type(docs, id_col)), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("decoded", pa.string()), *[(c, _arrow_type(docs, c)) for c in keep]])

    def run(batches):
        e = encoder(tokenizer)
        for b in batches:
            for part in parts(b, 1):
                ids = list(e.encode_all([t or "" for t in part.column(1).to_pylist()]))
                made = [pa.array(ids, arrow.field("ids").type), pa.array([len(x) for x in ids], pa.int64()), pa.array([e.decode(x) for x in ids], pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(arrow.field(0).type), *made, *[x.cast(f.type) for x, f in zip(part.columns[2:], list(arrow)[4:], strict=True)]], schema=arrow)

    kept = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(id_col, text_col, *keep).mapInArrow(tidy(run, "bpe"), f"{id_col} {docs.schema[id_col].dataType.simpleString()}, ids array<int>, n_tokens long, decoded string{kept}")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row, without carrying the ids through Spark."""

    def run(b):
        e = encoder(tokenizer)
        n, coded, back = [], [], []
        for ids in e.encode_all([t or "" for t in b["text"]]):
            n.append(len(ids))
            coded.append(hashlib.sha256(e.show(ids).encode()).hexdigest())
            back.append(hashlib.sha256(e.decode(ids).encode()).hexdigest())
        return {"id": b["id"], "n_tokens": n, "ids_sha256": coded, "decoded_sha256": back}

    kind = docs.schema[id_col].dataType.simpleString()
    arrow = pa.schema([("id", _arrow_type(docs, id_col)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return arrow_map(narrow(docs, id=id_col, text=text_col), run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", arrow, "bpe")
