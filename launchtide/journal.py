"""A journal beside each published table: what a run began, what it wrote, and that it is done.

A job writes several tables: a segment table and its audit, or deltas, histograms and a report.
Each run first enters that it has begun, then writes, then counts what is stored, and last
enters that it is committed, with those counts. That last entry is the one step which makes
the run's tables valid; it is one append of one file. A run that dies before leaves its tables
uncommitted: readers refuse them, and the next run replaces them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BEGUN, COMMITTED = "begun", "committed"
ENTRY = "nth int, run string, event string, part string, n_rows bigint, note string, at timestamp"


@dataclass(frozen=True)
class Run:
    """A run that a journal knows of."""

    nth: int
    name: str
    committed: bool = False
    #: What the run set out to write, such as months.
    parts: frozenset[str] = frozenset()
    #: Rows of each part when the run was committed.
    counts: Mapping[str, int] = field(default_factory=dict)
    #: What the run noted of itself, by part.
    notes: Mapping[str, str] = field(default_factory=dict)


class NotCommitted(RuntimeError):
    """A table whose last run has not been committed."""


def journal_path(path: str) -> str:
    return f"{path.rstrip('/')}-journal"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The journal of what lies at ``path``; empty if there is none."""
    if not exists(spark, journal_path(path)):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(journal_path(path))


def runs(spark: SparkSession, path: str) -> list[Run]:
    """All runs at ``path`` in the order in which they began. A journal has a few rows a run."""
    begun, done = {}, {}
    for row in entries(spark, path).orderBy("nth").collect():
        of = begun if row["event"] == BEGUN else done
        of.setdefault((row["nth"], row["run"]), []).append(row)
    return [
        Run(
            *key,
            key in done,
            frozenset(row["part"] for row in rows if row["part"] is not None),
            {row["part"]: row["n_rows"] for row in done.get(key, []) if row["n_rows"] is not None},
            {row["part"]: row["note"] for row in done.get(key, []) if row["note"] is not None},
        )
        for key, rows in begun.items()
    ]


def last_run(spark: SparkSession, path: str) -> Run | None:
    """The run that began last."""
    return max(runs(spark, path), key=lambda run: run.nth, default=None)


def last_committed(spark: SparkSession, path: str) -> Run | None:
    """The committed run that began last, whether or not others died since."""
    return max((run for run in runs(spark, path) if run.committed), key=lambda run: run.nth, default=None)


def unfinished(spark: SparkSession, path: str) -> frozenset[str]:
    """Parts that a run began and no run has committed since."""
    open_parts: frozenset[str] = frozenset()
    for run in sorted(runs(spark, path), key=lambda run: run.nth):
        open_parts = open_parts - run.parts if run.committed else open_parts | run.parts
    return open_parts


def _append(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    table = spark.createDataFrame(rows, ENTRY.removesuffix(", at timestamp"))
    table.coalesce(1).withColumn("at", F.current_timestamp()).write.mode("append").parquet(journal_path(path))


def begin(spark: SparkSession, path: str, parts: Iterable[str | int] = ()) -> Run:
    """Enter that a run begins at ``path``, and what it will write."""
    known = last_run(spark, path)
    parts = frozenset(map(str, parts))
    run = Run(known.nth + 1 if known else 1, uuid.uuid4().hex, parts=parts)
    _append(spark, path, [(run.nth, run.name, BEGUN, part, None, None) for part in sorted(parts) or [None]])
    return run


def commit(
    spark: SparkSession, path: str, run: Run, counts: Mapping[str, int], notes: Mapping[str, str] | None = None
) -> Run:
    """Enter that the run is done, with the rows of each part: one file, written at once."""
    notes = dict(notes or {})
    parts = [*counts, *(part for part in notes if part not in counts)] or [None]
    rows = [(run.nth, run.name, COMMITTED, part, counts.get(part), notes.get(part)) for part in parts]
    _append(spark, path, rows)
    return replace(run, committed=True, counts=dict(counts), notes=notes)


def require_committed(spark: SparkSession, path: str) -> Run:
    """The last run at ``path``; an error if it never ended, or if there was none."""
    run = last_run(spark, path)
    if run is None:
        raise NotCommitted(f"nothing has been published at {path}")
    open_parts = unfinished(spark, path)
    if not run.committed or open_parts:
        named = f" of {', '.join(sorted(open_parts))}" if open_parts else ""
        raise NotCommitted(f"a run{named} at {path} has not been committed; run it again")
    return run


def require_counts(what: str, wanted: Mapping[str, int], found: Mapping[str, int]) -> None:
    """An error that names the parts whose stored rows are not as many as they should be."""
    off = [f"{part} has {found.get(part, 0)} rows, not {n}" for part, n in wanted.items() if found.get(part, 0) != n]
    if off:
        raise RuntimeError(f"{what}: {'; '.join(off)}")
