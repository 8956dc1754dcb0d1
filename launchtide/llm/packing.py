"""Packing token pieces into sequences by shortest-pack-first over the length histogram."""

from __future__ import annotations

import re
from base64 import b64decode
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.shared import stored

CAPACITY = 1024
END_ID = 0
#: The added token of ``byte_bpe_50k.json``, which no rank file holds.
SPECIAL = {"<|endoftext|>": 50256}
#: Pieces of one length that are numbered together, about.
GROUP = 1 << 16
#: White space characters in a row from which on a run is encoded apart from what is around it.
LONG = 100_000
# The characters of Unicode's property White_Space.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class Encoder:
    """The byte-level encoder of a rank file, by default the 50k one of ``public_tokenizers``.

    Its ids are those of the same vocabulary's ``byte_bpe_50k.json`` in the library
    ``tokenizers``, in about a fifth of the time. The mark of its one special token,
    ``SPECIAL``, is that token wherever it stands in a text, as there. Other rank files
    have none.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
            ranks = {b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.special = {} if path else SPECIAL
        self.usual = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.whole = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.run = re.compile(f"[{SPACE}]{{{LONG},}}")

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text.

        The pattern's engine gives up on a very long run of white space. The pattern makes such
        a run one piece, but for its last character where something else than a special token
        follows; so it may be encoded as that piece, and the text before and after for itself.
        """
        parts, at = [], 0
        for run in self.run.finditer(text) if len(text) >= LONG else ():
            end = run.end()
            if end < len(text) and not any(text.startswith(mark, end) for mark in self.special):
                end -= 1
            parts += [self.usual.encode_to_numpy(text[at : run.start()], allowed_special="all"), self.whole.encode_to_numpy(text[run.start() : end])]
            at = end
        parts.append(self.usual.encode_to_numpy(text[at:], allowed_special="all"))
        return np.concatenate(parts).astype("<u4")


def token_pieces(
    docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None
) -> DataFrame:
    """Each document's ids, ``end_id`` last, cut into pieces of ``capacity`` and a rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder.encode(text.as_py() or ""), np.array(end_id, "<u4"))
                for start in range(0, len(ids), capacity):
                    own = ids[start : start + capacity]
                    rows.append((doc_id, start, len(own), crc32(own.tobytes()), len(ids)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(values), pa.int64()) for values in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(cut, _PIECES)


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns of lengths, each with the number of sequences that follow it.

    Lengths are placed longest first, and all pieces of one length together: each goes to
    the shortest pattern that has room, splitting that pattern's count if there are fewer
    pieces. Only counts are handled, so the work depends on the lengths that occur and
    not on the number of pieces.
    """
    open_packs: dict[int, list[tuple[list[int], int]]] = {}
    totals: list[int] = []  # of open packs, rising

    def add(pattern: list[int], count: int) -> None:
        total = sum(pattern)
        if total not in open_packs:
            open_packs[total] = []
            totals.insert(bisect_right(totals, total), total)
        open_packs[total].append((pattern, count))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if totals and totals[0] + length <= capacity:
                shortest = totals[0]
                pattern, count = open_packs[shortest].pop()
                if not open_packs[shortest]:
                    del open_packs[shortest], totals[0]
                used = min(left, count)
                if count > used:
                    add(pattern, count - used)
                add([*pattern, length], used)
            else:
                each = min(capacity // length, left)
                used = left // each * each
                add([length] * each, left // each)
            left -= used
    return [pack for total in totals for pack in open_packs[total]]


def _slots(packs: list[tuple[list[int], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """For each length, runs of ranks: where a run begins, its first sequence, the offset."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    placed = dict.fromkeys(range(capacity + 1), 0)
    sequence = 0
    for pattern, count in packs:
        offset = 0
        for length in pattern:
            runs.setdefault(length, []).append((placed[length], sequence, offset))
            placed[length] += count
            offset += length
        sequence += count
    flat = [(length, *run) for length in sorted(runs) for run in runs[length]]
    return tuple(np.array(flat, np.int64).reshape(-1, 4).T.copy())


def _ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rank``: pieces of one length numbered from 0, in groups of about ``GROUP``.

    ``counts`` tells how many pieces of each length there are, and so how many groups it
    is split into. A piece's rank is its place in its group and the pieces in the groups
    before. Pieces that are alike are dealt out by their place in the stored table.
    """
    spark = pieces.sparkSession
    groups = [(length, -(-k // GROUP)) for length, k in counts.items()]
    groups = F.broadcast(spark.createDataFrame(groups, "length bigint, salts bigint"))
    salt = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.col("salts"))
    salted = pieces.join(groups, "length").withColumn("salt", salt).drop("salts")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("k"))
        .select("length", "salt", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("before"))
    )
    place = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    return (
        salted.join(earlier, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.row_number().over(place) - 1)
        .drop("salt", "before")
    )


def pack(
    docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every document's ids, with ``end_id`` after them, are cut into pieces of ``capacity``
    ids and one rest. A histogram of piece lengths, at most ``capacity`` numbers, goes to
    the driver and is packed there by :func:`pack_lengths`; pieces then find their place by
    their rank among those of equal length. ``sequence_id`` counts from 0 without gaps.

    A null or empty text is the one id ``end_id``. Rows that repeat a doc_id, or have
    none, are packed like any other; no document gives no rows. Only ``doc_id`` and
    ``text`` are read. Pieces are stored before they are counted.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, capacity=capacity, end_id=end_id, path=path), "pieces")
    rows = pieces.groupBy("length").agg(F.count("*").alias("k")).collect()
    counts = {row["length"]: row["k"] for row in rows}
    packs = pack_lengths(counts, capacity)
    known = spark.sparkContext.broadcast(_slots(packs, capacity))

    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lengths, begins, sequences, offsets = known.value
        first = np.searchsorted(lengths, np.arange(capacity + 2))
        for length, rank in batches:
            own, rank = length.to_numpy(), rank.to_numpy()
            at = np.zeros(len(own), np.int64)
            for each in np.unique(own):
                rows = own == each
                a, b = first[each], first[each + 1]
                at[rows] = a + np.searchsorted(begins[a:b], rank[rows], "right") - 1
            found = [sequences[at] + rank - begins[at], offsets[at]]
            yield pa.StructArray.from_arrays(list(map(pa.array, found)), ["sequence_id", "offset"])

    place.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    placed = F.arrow_udf(place, "struct<sequence_id:bigint,offset:bigint>")
    return (
        _ranked(pieces, counts)
        .withColumn("place", placed("length", "rank"))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "place.*")
    )
