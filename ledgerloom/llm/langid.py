"""Language by compression: the language whose dictionary makes a text smallest.

Each language's dictionary is raw content for zstandard: whole texts of that language from rows that aren't held out,
SAMPLE_DOCS rows at most, chosen and put in order by a hash of the row. A whole text, lower-cased and with spaces for all but
letters, is encoded with every dictionary in turn; the window reaches over all of the dictionary. The score is the share of
the second smallest size that the smallest saves; a text whose score lies below MARGIN is marked as rejected, its language
still named.

Defined results: null text, or text without a letter, gives ``und``, score 0, rejected; of equal sizes the language that sorts
first wins; with one learned language every text with a letter gets it, score 1; with none, ``und``; repeated rows each give a
row; rows with null ids aren't learned from; of very long texts all is read and compressed; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import _arrow_type
from .common import hold_out, tidy

SAMPLE_DOCS, LEVEL, MARGIN = 256, 3, 0.01

SPARE = 4
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The lower-cased words of a text with single spaces for all else."""
    return _OTHER.sub(" ", text.lower())


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary content by language, from a bounded sample of rows that aren't held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("id is not null and lang is not null and text is not null").where(~hold_out(F.col("id")))
    # a share of each language by hash, some SPARE times the sample, so that the window over a language stays small at any size
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return {}
    per = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col("lang")]
    place = F.xxhash64("id", "text")
    rows = rows.where(F.pmod(place, per) < SPARE * SAMPLE_DOCS)
    first = F.row_number().over(W.partitionBy("lang").orderBy(place, "id", "text"))
    out: dict[str, list[bytes]] = {}
    chosen = rows.select("lang", "text", first.alias("n")).where(F.col("n") <= SAMPLE_DOCS)
    for lang, text, _ in sorted(chosen.collect(), key=lambda r: (r[0], r[2])):  # SAMPLE_DOCS rows for each language at most
        out.setdefault(lang, []).append(letters(text).encode())
    return {lang: b"\n".join(texts) for lang, texts in out.items()}


class Sizer:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.by = []
        for lang, raw in sorted(dictionaries.items()):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            window = max(10, min(27, len(raw).bit_length() + 1))
            d.precompute_compress(compression_params=zstandard.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(raw), window_log=window))
            self.by.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)))

    def name(self, text: str | None) -> tuple[str, float]:
        if not self.by or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        raw = letters(text).encode()
        sizes = sorted((len(c.compress(raw)), lang) for lang, c in self.by)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], 1 - sizes[0][0] / sizes[1][0]


def predict(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    arrow = pa.schema([("id", _arrow_type(docs, id_col)), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(shared.value)
        for b in batches:
            got = [sizer.name(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow.field(0).type), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[1] < MARGIN for g in got], pa.bool_())], schema=arrow)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, lang_pred string, score double, rejected boolean")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) of every document."""
    out = predict(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col)
    return out.select("id", F.coalesce(hold_out(F.col("id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
