import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, token_counts, token_files

ODD = [None, "", "a", " ", " a", "  a b", "a  b  ", "\n\n x", "x<|endoftext|> y", "x <|endoftext|>z", "a" * 3000, "ab" * 1000 + " " * 50 + "\n" * 9, "don't I'll 12 !!??", "日本語 テスト", "😀 a   \tb"]


def texts():
    r = random.Random(3)
    chars = " \n\tab'se.9é<|>A 　Ĳ😀\x1c\x85​ İΣ́"
    return ODD + ["".join(r.choice(chars) for _ in range(r.randint(1, 30))) for _ in range(600)] + ODD[3:6]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts())] + [(None, "a b", "x", 1)], "doc_id long, text string, id string, ids int")


def test_byte_bpe_equals_the_library(spark, docs):
    path = P.path("byte_bpe_50k.json")
    lib, want = Tokenizer.from_file(path), {}
    for k, t in [*enumerate(texts()), (None, "a b")]:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[k] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r.id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, path).collect()} == want
    counts = {r.id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, path).collect()}
    assert counts == {k: (len((t or "").encode()), want[k][0], want[k][0] > 512) for k, t in [*enumerate(texts()), (None, "a b")]}
    back = bpe.decode(bpe.encode(docs, path), path)
    assert {r.id: r.text for r in back.collect()} == {k: t or "" for k, t in [*enumerate(texts()), (None, "a b")]}
    assert bpe.digests(docs.limit(0), path).collect() == []


def test_a_full_table_changes_nothing(monkeypatch):
    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    monkeypatch.setattr(bpe, "KEPT_BYTES", 500)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 10)
    monkeypatch.setattr(token_counts, "KEPT_BYTES", 500)
    e, c, ts = bpe.Encoder(path), token_counts.Counter(path), [t or "" for t in texts()[:200]]
    want = [lib.encode(t, add_special_tokens=False).ids for t in ts]
    assert list(e.encode_all(ts)) == want and [c.count(t) for t in ts] == list(map(len, want))


def test_token_files_round_trip(spark, docs):
    path = P.path("word_bpe_49k.json")
    lib, start, want = Tokenizer.from_file(path), 0, []
    for k, t in [(None, "a b"), *enumerate(texts())]:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.round_trip(docs, path).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.round_trip(docs.limit(0), path).collect() == []


def test_ids_dont_depend_on_what_was_encoded_before():
    """Random texts over all white space, with one encoder in two orders."""
    path = P.path("byte_bpe_50k.json")
    lib, r = Tokenizer.from_file(path), random.Random(12)
    white = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2003\u200a\u2028\u2029\u202f\u205f\u3000\x1c\x1f"
    made = ["a \u00a0", "a \u00a0 \u00a0"] + ["".join(r.choice(white) if r.random() < 0.3 else r.choice(" ab9.'é") for _ in range(r.randint(1, 9))) for _ in range(30_000)]
    want = {t: e.ids for t, e in zip(made, lib.encode_batch(made, add_special_tokens=False), strict=True)}
    for order in (made, made[::-1]):
        e, c = bpe.Encoder(path), token_counts.Counter(path)
        for t in order:
            assert e.encode(t) == want[t], t
            assert c.count(t) == len(want[t]), t


def test_token_files_refuse_what_they_cant_hold(spark):
    with pytest.raises(ValueError):
        token_files.LibraryEncoder(P.path("byte_bpe_50k.json"))
    with pytest.raises(Exception, match="can't be an id"):
        token_files.round_trip(spark.createDataFrame([(-(2**63), "a")], "doc_id long, text string"), P.path("word_bpe_49k.json"))
    rows = [(5, t) for t in ("b", "a", "a", None)]
    got = token_files.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), P.path("word_bpe_49k.json")).collect()
    assert sorted(r.start for r in got) == [0, *sorted(r.start + r.n_tokens for r in got)[:-1]] and len(got) == 4
