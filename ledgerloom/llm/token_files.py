"""Token ids as flat unsigned-integer files with 64-bit document offsets.

Documents are dealt by ranges of their id and sorted; each partition becomes one set of files in shared storage:
``NAME.ids`` (16-bit ids if the vocabulary allows, else 32-bit, little endian), ``NAME.off`` (64-bit offsets within the
file, one more than documents) and ``NAME.doc`` (64-bit document ids). A task writes under a name of its own and reports it,
so that of repeated or speculative attempts only the reported files count. The base of each partition, the number of ids in
all partitions before it, comes from prefix sums over one row per partition.

Defined results: null text counts as empty (the end id alone); rows of equal id each count, in the order of a hash of their
texts, then of the texts, so that they spread over partitions too; a null id sorts first and reads back as null (the files mark it
by the least 64-bit integer, which is refused as an id); an empty table writes no files and gives an empty result; only the named
columns are read; ids are integers.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, holds, integers, narrow, parts, tidy

KEPT_PIECES = 1_000_000
NO_ID = -(2**63)
MANIFEST = "part int, name string, docs long, tokens long, width int"


_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: ASCII signs that end pieces; not the apostrophe, which may begin a word.
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)


class LibraryEncoder:
    """The tokenizers library over space-delimited pieces, whose ids are kept.

    For vocabularies that lower-case, drop white space and whose words never reach over it nor from a letter or digit to a
    sign: a text is cut at ASCII white space, a piece met for the first time is parted from the signs at its end, and only
    what wasn't met before goes to the library. A-Z are lower-cased at once unless a special string might be made by it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if '"Lowercase"' not in json.dumps(json.loads(self.library.to_str())["normalizer"]):
            raise ValueError(f"{path}: only vocabularies that lower-case their texts can be read piece by piece")
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 2**16 else 4
        self.known: dict[bytes, bytes] = {}

    def learn(self, new: set[bytes]) -> None:
        parted = {}
        for p in new:
            word = p.rstrip(_SIGNS)
            if word and len(word) < len(p) and b"<|" not in p and word[-1:].isalnum():
                parted[p] = (word, p[len(word) :])
        kind = "H" if self.width == 2 else "I"
        ask = list({x for p in new for x in parted.get(p, (p,)) if x not in self.known})
        for p, e in zip(ask, self.library.encode_batch_fast([p.decode() for p in ask], add_special_tokens=False), strict=True):
            self.known[p] = array(kind, e.ids).tobytes()
        for p, (word, signs) in parted.items():
            self.known[p] = self.known[word] + self.known[signs]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of UTF-8 texts, as unsigned integers of self.width bytes."""
        cuts = [(t if b"<|" in t else t.translate(_LOWER)).split() for t in texts]
        new = set().union(*cuts).difference(self.known)
        if new and len(self.known) + len(new) > KEPT_PIECES:
            self.known.clear()
            new = set().union(*cuts)
        self.learn(new)
        return [b"".join(map(self.known.__getitem__, ps)) for ps in cuts]


_encoders: dict[str, LibraryEncoder] = holds("token_files")


def library_encoder(path: str) -> LibraryEncoder:
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Write the files below folder (shared by driver and executors); gives the partitions in order, with their bases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        e, part = library_encoder(tokenizer), TaskContext.get().partitionId()
        store, at = _open(folder)
        name, out, docs_seen, tokens = f"part-{part:06d}-{uuid.uuid4().hex[:12]}", None, 0, 0
        end = np.array([end_id], f"<u{e.width}").tobytes()
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                out = [store.open_output_stream(f"{at}/{name}.{x}") for x in ("ids", "off", "doc")]
                out[1].write(np.zeros(1, "<i8").tobytes())
            for p in parts(b, 1, 4 << 20):
                ids = p.column(0).to_pylist()
                if NO_ID in ids:
                    raise ValueError(f"{NO_ID} can't be an id")
                coded = [x + end for x in e.encode_all([t or b"" for t in p.column(1).cast(pa.binary()).to_pylist()])]
                ends = tokens + np.cumsum([len(x) // e.width for x in coded])
                out[0].write(b"".join(coded))
                out[1].write(ends.astype("<i8").tobytes())
                out[2].write(np.array([NO_ID if x is None else x for x in ids], "<i8").tobytes())
                docs_seen, tokens = docs_seen + len(coded), int(ends[-1])
        if out:
            for f in out:
                f.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "docs": [docs_seen], "tokens": [tokens], "width": pa.array([e.width], pa.int32())})

    store, at = _open(folder)
    store.create_dir(at, recursive=True)
    spark = docs.sparkSession
    dealt = narrow(docs, id=id_col, text=text_col).withColumn("h", F.xxhash64("text")).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "id", "h").sortWithinPartitions("id", "h", "text").drop("h")
    files = sorted((r.asDict() for r in dealt.mapInArrow(tidy(run, "token_files"), MANIFEST).collect()), key=lambda p: p["part"])  # a row for each partition
    base = 0
    for p in files:
        p["base"], base = base, base + p["tokens"]
    return files


def read(spark: SparkSession, folder: str, files: list[dict], id_name: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the memory-mapped files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = _open(folder)

        def mapped(name: str, kind: str) -> np.ndarray:
            if isinstance(store, fs.LocalFileSystem):
                return np.memmap(f"{at}/{name}", kind, "r")
            return np.frombuffer(store.open_input_file(f"{at}/{name}").read(), kind)

        for b in batches:
            for p in b.to_pylist():
                ids, off, doc = mapped(f"{p['name']}.ids", f"<u{p['width']}"), mapped(f"{p['name']}.off", "<i8"), mapped(f"{p['name']}.doc", "<i8")
                if len(ids) != p["tokens"] or len(off) != p["docs"] + 1 or len(doc) != p["docs"]:
                    raise ValueError(f"{p['name']}: the files don't hold what was reported")
                for i in range(0, p["docs"], 10_000):
                    cuts = off[i : i + 10_001]
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                    own = np.array(doc[i : i + 10_000])
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(p["base"] + cuts[:-1], pa.int64()), pa.array(np.diff(cuts), pa.int64()), pa.array(crc, pa.int64())], names=[id_name, "start", "n_tokens", "ids_crc32"])

    rows = spark.createDataFrame([(p["part"], p["name"], p["docs"], p["tokens"], p["width"], p["base"]) for p in files], f"{MANIFEST}, base long")
    if files:
        rows = rows.repartition(len(files))
    return rows.mapInArrow(tidy(run, "token_files"), f"{id_name} long, start long, n_tokens long, ids_crc32 long")


def fresh_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and describe each document from what they hold."""
    folder = folder or fresh_folder(docs.sparkSession)
    cast = docs.select(integers(docs, id_col).alias(id_col), text_col)
    return read(docs.sparkSession, folder, write(cast, tokenizer, folder, end_id, id_col, text_col), id_col)
