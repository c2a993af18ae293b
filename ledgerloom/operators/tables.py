"""Cells from filings' text: Markdown tables, space-aligned statements, vertical balance sheets, prose, iXBRL.

Layout parsing is imperative, so it runs over Arrow batches, one document at a time; all else is SQL over the cells.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

CELL = "doc string, section string, table_index int, row_index int, col_index int, label string, column_header string, raw_text string"
_CELL_ARROW = pa.schema([("doc", pa.string()), ("section", pa.string()), ("table_index", pa.int32()), ("row_index", pa.int32()), ("col_index", pa.int32()), ("label", pa.string()), ("column_header", pa.string()), ("raw_text", pa.string())])
_NUMBER = re.compile(r"\(?[-−]?[$€£¥]?\s?\d[\d.,]*\)?%?|[—–-](?=\s|$)")
_YEAR = re.compile(r"\b(?:19|20)\d{2}\b")


def _per_document(docs: DataFrame, parse, schema: str, arrow: pa.Schema) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = [dict(zip(arrow.names, (doc, *r), strict=True)) for r in parse(text.as_py() or "")]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, schema)


def parse_markdown(text: str) -> Iterator[tuple]:
    """Rows of pipe tables under their last heading: (section, table, row, column, label, header, raw)."""
    section, table, header, row, last = "", -1, [], 0, False
    for line in text.split("\n"):
        s = line.strip()
        if s.startswith("#"):
            section, last = s.lstrip("#").strip(), False
            continue
        if not s.startswith("|"):
            last = False
            continue
        cells = [c.strip() for c in s.strip("|").split("|")]
        if not last:
            table, header, row, last = table + 1, cells, 0, True
            continue
        if all(re.fullmatch(r":?-{2,}:?", c) for c in cells if c):
            continue
        if not cells[0] and all(not c or _YEAR.search(c) for c in cells) and row == 0:  # years under a header row
            header = [f"{h} {c}".strip() for h, c in zip(header + [""] * len(cells), cells, strict=False)]
            continue
        for k, c in enumerate(cells[1:], 1):
            if c:
                yield section, table, row, k, cells[0], header[k] if k < len(header) else "", c
        row += 1


def parse_aligned(text: str) -> Iterator[tuple]:
    """Numbers of space-aligned statements; each goes to the nearest year of the last line of years."""
    section, table, anchors, row = "", -1, [], 0
    for line in text.split("\n"):
        years = [(m.end(), m[0]) for m in _YEAR.finditer(line)]
        if len(years) > 1 and not re.search(r"[A-Za-z]{4,}\s+\d{4}\D+[A-Za-z]{4,}.*\d{4}", line):
            table, anchors, row = table + 1, years, 0
            continue
        m = re.match(r"\s*(\S.*?)(?:\s{2,}|\s*\.{3,}\s*|$)(.*)$", line)
        if not m or not m[1]:
            continue
        numbers = [(m.start(2) + x.end(), x[0]) for x in _NUMBER.finditer(m[2])]
        if not numbers:
            if m[1].isupper():
                section = m[1]
            continue
        for at, raw in numbers if anchors else ():
            k = min(range(len(anchors)), key=lambda i: (abs(anchors[i][0] - at), i))
            yield section, table, row, k + 1, m[1].strip(" .:"), anchors[k][1], raw
        row += 1


def parse_vertical(text: str) -> Iterator[tuple]:
    """Balance sheets with a label on one line and its values on the next ones."""
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    years, label, at, row, on = [], None, 0, 0, False
    for k, s in enumerate(lines):
        if s.upper() == "ASSETS":
            years = [y for x in lines[max(0, k - 9) : k] for y in _YEAR.findall(x)][:2]
            on = any("CONSOLIDATED" in x.upper() for x in lines[max(0, k - 15) : k])
        elif on and _NUMBER.fullmatch(s):
            if label and at < len(years):
                yield "balance_sheet", 0, row, at + 1, label, years[at], s
                at += 1
        elif on:
            label, at, row = s.strip(" :"), 0, row + 1


def parse_prose(text: str) -> Iterator[tuple]:
    """Sentences that say what something was: label, verb, amount, scale."""
    p = re.compile(r"\b((?:total |net )?(?:revenue|revenues|net income|net loss|operating income|gross profit|cash flow|capex|capital expenditures?))\b[^.\d$€£]{0,60}?\b(?:was|were|of|totaled|totalled|amounted to|reached)\b\s+(?:approximately\s+)?([$€£]?\s?\(?\d[\d.,]*\)?(?:\s+(?:million|billion|thousand))?)", re.I)
    for k, m in enumerate(p.finditer(text)):
        around = text[max(0, m.start() - 200) : m.end() + 200]
        year = _YEAR.search(around)
        yield "narrative", 0, k, 1, m[1].lower(), year[0] if year else "", m[2].rstrip(".,")


def cells(docs: DataFrame, layout: str) -> DataFrame:
    """Cells of docs (doc, text) in one layout, with the parsed value."""
    parse = {"markdown": parse_markdown, "aligned": parse_aligned, "vertical": parse_vertical, "prose": parse_prose}[layout]
    out = _per_document(docs, parse, CELL, _CELL_ARROW)
    number = F.regexp_replace("raw_text", r"(?i)\s*(million|billion|thousand)$", "")
    scale = F.lower(F.regexp_extract("raw_text", r"(?i)(million|billion|thousand)$", 1))
    return out.withColumns({"value": T.parse_number(number), "scale": F.when(scale == "", "raw").otherwise(F.concat(scale, F.lit("s")))})


class _Tags(HTMLParser):
    """Contexts and non-fraction facts of an inline-tagged document."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.contexts: dict[str, dict] = {}
        self.facts: list[dict] = []
        self.context: dict | None = None
        self.field = ""
        self.open: list[dict] = []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        name = tag.split(":")[-1]
        if name == "context":
            self.context = self.contexts.setdefault(a.get("id", ""), {"dimensional": False})
        elif self.context is not None and name in ("startdate", "enddate", "instant"):
            self.field = name
        elif self.context is not None and name in ("explicitmember", "typedmember"):
            self.context["dimensional"] = True
        elif tag == "ix:nonfraction":
            self.open.append({"concept": a.get("name", "").split(":")[-1], "context": a.get("contextref", ""), "scale": a.get("scale", "0"), "negated": a.get("sign") == "-", "text": ""})

    def handle_endtag(self, tag):
        name = tag.split(":")[-1]
        if name == "context":
            self.context = None
        elif tag == "ix:nonfraction" and self.open:
            self.facts.append(self.open.pop())
        self.field = ""

    def handle_data(self, data):
        if self.context is not None and self.field:
            self.context[self.field] = self.context.get(self.field, "") + data.strip()
        for f in self.open:
            f["text"] += data


def _parse_ixbrl(html: str) -> Iterator[tuple]:
    p = _Tags()
    p.feed(html)
    for k, f in enumerate(p.facts):
        c = p.contexts.get(f["context"], {"dimensional": True})
        if not c["dimensional"]:
            yield k, f["concept"], f["context"], c.get("startdate"), c.get("enddate") or c.get("instant"), int(f["scale"] or 0) if re.fullmatch(r"-?\d*", f["scale"]) else 0, f["negated"], f["text"].strip()


def ixbrl_facts(docs: DataFrame, concepts: DataFrame, fye_month: int = 12) -> DataFrame:
    """(doc, period, field, value, ...): tagged facts by period, the preferred concept of each field.

    concepts: (concept, field, preference). Durations of 335-400 days are years, 80-100 quarters and 175-195 halves; an instant
    is the year if it ends in the fiscal year's last month, else its quarter. Dimensional contexts are left out.
    """
    schema = "doc string, ord int, concept string, context string, start string, end string, scale int, negated boolean, raw_text string"
    arrow = pa.schema([("doc", pa.string()), ("ord", pa.int32()), ("concept", pa.string()), ("context", pa.string()), ("start", pa.string()), ("end", pa.string()), ("scale", pa.int32()), ("negated", pa.bool_()), ("raw_text", pa.string())])
    f = _per_document(docs, _parse_ixbrl, schema, arrow)
    start, end = F.col("start").try_cast("date"), F.col("end").try_cast("date")
    days, year = F.datediff(end, start) + 1, F.year(end)
    fiscal = (year + F.when(F.month(end) > fye_month, 1).otherwise(0)).cast("string")
    quarter = F.concat(F.lit("Q"), F.quarter(end).cast("string"), F.lit("-"), year.cast("string"))
    half = F.concat(F.lit("H"), F.when(F.month(end) <= 6, "1").otherwise("2"), F.lit("-"), fiscal)
    period = F.when(days.between(335, 400), F.concat(F.lit("FY"), fiscal)).when(days.between(80, 100), quarter).when(days.between(175, 195), half).when(start.isNull() & end.isNotNull(), F.when(F.month(end) == fye_month, F.concat(F.lit("FY"), fiscal)).otherwise(quarter))
    value = T.parse_displayed(F.col("raw_text"))
    f = f.withColumns({"period": period, "value": F.when(F.col("negated"), -value).otherwise(value)}).where("period is not null and value is not null")
    j = f.join(F.broadcast(concepts), "concept")
    return j.groupBy("doc", "period", "field").agg(F.min_by(F.struct("value", "scale", "concept", "context"), F.struct("preference", "ord")).alias("w")).select("doc", "period", "field", "w.*")


def wide_history(cells: DataFrame, at_least: int = 8) -> DataFrame:
    """Cells of tables whose columns are at least so many consecutive years, the two latest years left out."""
    years = cells.where(F.col("column_header").rlike(r"^\d{4}$")).select("doc", "table_index", F.col("column_header").cast("int").alias("y")).distinct()
    ok = years.groupBy("doc", "table_index").agg(F.count("*").alias("n"), F.max("y").alias("top"), F.min("y").alias("low")).where((F.col("n") >= at_least) & (F.col("top") - F.col("low") == F.col("n") - 1))
    return cells.join(ok.select("doc", "table_index", "top"), ["doc", "table_index"]).where(F.col("column_header").try_cast("int") <= F.col("top") - 2).drop("top")
