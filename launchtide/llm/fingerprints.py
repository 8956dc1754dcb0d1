"""Packed one-permutation MinHash fingerprints of documents, and of an edited copy of each."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.minhash import signatures
from launchtide.llm.shared import stored
from launchtide.llm.words import shingle_sets

_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
#: ``edge``: 1 for the first row of a part, 2 for the last, 3 for both; these carry their text.
_EDGED = f"{_RESULT}, text string, part int, edge int"


def fingerprints(texts: list[str], size: int, n_bins: int, bits: int) -> np.ndarray:
    """A row of ``n_bins`` low-order values of ``bits`` bits per text."""
    column = pa.array(texts, pa.large_string())
    rows = [signatures(sets, n_bins) for sets in shingle_sets(column, size)]
    return (np.concatenate(rows) if rows else np.zeros((0, n_bins), np.uint32)) & np.uint32((1 << bits) - 1)


def packed(values: np.ndarray, bits: int) -> str:
    """The values' bits one after another, as hexadecimal text."""
    each = (values[:, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(each.astype(np.uint8).ravel()).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Similarity of two rows of fingerprints, from 0 to 1.

    Low-order bits of different values agree by chance once in ``2 ** bits``; the share of
    agreeing bins is corrected for that.
    """
    chance = 0.5**bits
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)


def edited(text: str, after: str) -> str:
    """The last half of a text's code points replaced by the first as many of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _results(ids: list, texts: list[str], after: list[str], size: int, n_bins: int, bits: int) -> dict:
    changed = [edited(a, b) for a, b in zip(texts, after, strict=True)]
    own = fingerprints(texts, size, n_bins, bits)
    new = fingerprints(changed, size, n_bins, bits)
    following = fingerprints(after, size, n_bins, bits)
    has, has_new, has_next = ([bool(t.strip(" \t\n\v\f\r")) for t in x] for x in (texts, changed, after))

    def near(other: np.ndarray, there: list[bool]) -> list[float]:
        both = zip(likeness(own, other, bits).tolist(), has, there, strict=True)
        return [x if a and b else float(a == b) for x, a, b in both]

    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [packed(v, bits) if a else "" for v, a in zip(own, has, strict=True)],
        "edited_fingerprint": [packed(v, bits) if a else "" for v, a in zip(new, has_new, strict=True)],
        "near_edited": near(new, has_new),
        "near_next": near(following, has_next),
    }


def fingerprint_documents(
    docs: DataFrame, *, size: int = 5, n_bins: int = 256, bits: int = 4
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    A fingerprint is the one-permutation MinHash of a text's distinct ``size``-word
    shingles in ``n_bins`` bins, densified, with the lowest ``bits`` bits of each bin, as
    hexadecimal text. ``near_edited`` and ``near_next`` estimate the Jaccard similarity of
    the shingle sets of a text and its edited text, and of a text and the next one.

    Documents are sorted by doc_id into parts, and each part is read once, with the row
    before in memory. Only the first and last row of each part are kept with their texts,
    to be joined across parts; the last document is followed by the first.

    A null text is empty. A text without words has the fingerprint "" and likeness 0 to
    one with words, 1 to another without. Rows without doc_id come last; rows that repeat
    a doc_id are ordered by a hash of their texts, then by these. Only ``doc_id`` and ``text`` are read.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = _arrow_schema()
        waiting: list[tuple[int | None, str]] = []
        held, first = 0, True

        def known(rows: list, after: list[str]) -> pa.RecordBatch:
            nonlocal first
            found = _results([r[0] for r in rows], [r[1] for r in rows], after, size, n_bins, bits)
            edge = [0] * len(rows)
            edge[0], first = int(first), False
            found |= {"text": [rows[0][1] if edge[0] else None, *[None] * (len(rows) - 1)], "part": [part] * len(rows), "edge": edge}
            return pa.RecordBatch.from_pydict(found, schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                waiting.append((doc_id, text.as_py() or ""))
                held += len(waiting[-1][1])
                if held > 1 << 20 and len(waiting) > 1:
                    yield known(waiting[:-1], [r[1] for r in waiting[1:]])
                    waiting = waiting[-1:]
                    held = len(waiting[0][1])
        if len(waiting) > 1:
            yield known(waiting[:-1], [r[1] for r in waiting[1:]])
        if waiting:
            last = {c: [None] for c in schema.names}
            last |= {"doc_id": [waiting[-1][0]], "text": [waiting[-1][1]], "part": [part], "edge": [2 + first]}
            yield pa.RecordBatch.from_pydict(last, schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(list(_arrow_schema())[:7])
        for batch in batches:
            for row in batch.to_pylist():
                found = _results([row["doc_id"]], [row["text"]], [row["after"]], size, n_bins, bits)
                yield pa.RecordBatch.from_pydict(found, schema)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows of one doc_id part by their texts, and equal rows, whose order means nothing, by number.
    order = (F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text")
    walked = stored(
        docs.repartitionByRange(*order[:2], F.monotonically_increasing_id())
        .sortWithinPartitions(*order)
        .mapInArrow(walk, _EDGED),
        "fingerprints",
    )
    # A row or two per part: its number, and the text that the part before it needs.
    edges = walked.filter("edge > 0")
    starts = edges.filter("edge in (1, 3)").select("part", F.col("text").alias("after"))
    order = Window.orderBy("part")
    following = starts.select(
        F.lead("part").over(order).alias("next"), F.min("part").over(Window.partitionBy()).alias("least"), F.col("part").alias("at")
    ).select("at", F.coalesce("next", "least").alias("next"))
    ends = edges.filter("edge in (2, 3)").select("doc_id", "text", "part")
    finished = (
        ends.join(following, ends.part == following["at"])
        .select("doc_id", "text", "next")
        .join(starts, F.col("next") == starts.part)
        .select("doc_id", "text", "after")
        .mapInArrow(finish, _RESULT)
    )
    return walked.filter("edge < 2").drop("text", "part", "edge").union(finished)


def _arrow_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _EDGED.split(", "))])
