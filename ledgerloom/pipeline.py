"""Phases run one after another over named tables, with observers and metrics of the run.

A phase takes the context's tables and adds its own; what it builds is a plan, so that one plan per sink is what Spark optimizes.
Sources give rows of filings, extractors turn these into candidate values: both are functions from DataFrame to DataFrame.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from .operators.rules import SEVERITIES


class Source(Protocol):
    """Gives (ticker, source_id, filing_type, period, text) of issuers' filings."""

    def fetch(self, issuers: DataFrame) -> DataFrame: ...


class Extractor(Protocol):
    """Gives (ticker, source_id, period_key, field, value, location) of filings."""

    def extract(self, filings: DataFrame) -> DataFrame: ...


@dataclass
class PhaseResult:
    name: str
    severity: str = "ok"
    message: str = ""
    seconds: float = 0.0


@dataclass
class Context:
    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)
    settings: dict[str, object] = field(default_factory=dict)
    results: list[PhaseResult] = field(default_factory=list)


class Phase(Protocol):
    name: str

    def run(self, context: Context) -> PhaseResult: ...


def run(context: Context, phases: Iterable[Phase], observers: Iterable[Callable[[PhaseResult], None]] = ()) -> Context:
    """Run phases in order up to one that is fatal; each observer is called after each phase. A phase that raises is fatal."""
    watching = list(observers)
    for phase in phases:
        began = time.monotonic()
        try:
            result = phase.run(context)
        except Exception as e:  # what went wrong belongs into the run's metrics
            result = PhaseResult(phase.name, "fatal", f"{type(e).__name__}: {str(e)[:500]}")
        result.seconds = round(time.monotonic() - began, 3)
        context.results.append(result)
        for tell in watching:
            tell(result)
        if result.severity == "fatal":
            break
    return context


def worst(severities: Iterable[str]) -> str:
    """The worst of states; what isn't known counts as ok."""
    return max((s for s in severities if s in SEVERITIES), key=SEVERITIES.index, default="ok")


def metrics(context: Context) -> dict[str, object]:
    """What a run did: the worst state, its duration and one entry for each phase that ran."""
    phases = [{"phase": r.name, "severity": r.severity, "message": r.message, "duration_ms": round(r.seconds * 1000, 1)} for r in context.results]
    return {"final_severity": worst(r.severity for r in context.results), "duration_ms": round(sum(r.seconds for r in context.results) * 1000, 1), "phases": phases}


def write_metrics(context: Context, folder: str) -> None:
    """The metrics as one JSON line below folder, in any store that Spark writes to."""
    context.spark.createDataFrame([(json.dumps(metrics(context), sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(folder)
