"""Ranked lexical search: term-at-a-time over short lists, document-at-a-time over long ones.

The documents are read once into segments: a segment is a run of documents with the posting
lists of the terms that are asked for. Each item then walks every segment. Its short lists are
added up term by term into accumulators; these and the long lists are iterators in document
order, each with a bound for every window of documents. A window whose bounds cannot reach
the item's last kept score is skipped; in others only documents of essential iterators (those
without which the score is out of reach) are looked at, and the remaining lists are probed for
as long as a document can still get in. Bounds are exact maxima, and documents that tie are
kept, so the ranking is the one of scoring every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.shared import broadcast_if_small, stored
from launchtide.llm.words import ALPHANUMERIC, pieces, texts_of, words

#: Text bytes and documents after which a segment ends.
SEGMENT_BYTES = 4 << 20
SEGMENT_ROWS = 1 << 14
#: Documents of a window, the unit that is skipped.
WINDOW = 1 << 11
#: A list is short in a segment if it holds at most this share of its documents.
SHORT = 1 / 16
#: Distinct (item, term) pairs that are sent to the tasks at once; more items go in turns.
PAIRS = 1 << 21
#: Parts in which the hits of one item are ranked ahead of the last ranking.
PARTS = 32

_SEGMENT = (
    "n_docs bigint, n_words bigint, docs array<bigint>, sizes array<bigint>, "
    "terms array<int>, lengths array<int>, places array<int>, counts array<bigint>"
)


def _distinct_terms():
    def terms(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            sets = []
            data, offsets = texts_of(column)
            for a, b in pieces(offsets):
                inner = offsets[a : b + 1] - offsets[a]
                hashes, row, _ = words(data[offsets[a] : offsets[b]], inner, ALPHANUMERIC)
                ends = np.searchsorted(row, np.arange(b - a + 1))
                sets += [np.unique(hashes[x:y]).view(np.int64) for x, y in zip(ends, ends[1:])]
            ends = np.cumsum([0, *(len(own) for own in sets)])
            values = np.concatenate([np.zeros(0, np.int64), *sets])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))

    terms.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(terms, "array<bigint>")


def _segment(parts: list[tuple], n_docs: int, n_words: int) -> pa.RecordBatch:
    """One row: posting lists by term, places in the order of the segment's documents."""
    ids, sizes, row, term, count = [], [], [], [], []
    base = 0
    for own_ids, own_sizes, own_row, own_term, own_count in parts:
        ids.append(own_ids)
        sizes.append(own_sizes)
        row.append(own_row + base)
        term.append(own_term)
        count.append(own_count)
        base += len(own_sizes)
    row, term, count = np.concatenate(row), np.concatenate(term), np.concatenate(count)
    order = np.lexsort((row, term))
    row, term, count = row[order], term[order], count[order]
    terms, lengths = np.unique(term, return_counts=True)
    ids = pa.concat_arrays(ids)

    def one(values, kind):
        values = values if isinstance(values, pa.Array) else pa.array(values, kind)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [
            pa.array([n_docs], pa.int64()),
            pa.array([n_words], pa.int64()),
            one(ids, pa.int64()),
            one(np.concatenate(sizes), pa.int64()),
            one(terms, pa.int32()),
            one(lengths, pa.int32()),
            one(row, pa.int32()),
            one(count, pa.int64()),
        ],
        [part.split()[0] for part in _SEGMENT.split(", ")],
    )


def segments(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Posting lists of the sorted term hashes ``vocabulary``, a row for each run of documents.

    ``n_docs`` and ``n_words`` count documents with a term and all terms, asked for or not.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        held = rows = n_docs = n_words = 0
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            data, offsets = texts_of(batch.column(1))
            for a, b in pieces(offsets):
                inner = offsets[a : b + 1] - offsets[a]
                hashes, row, _ = words(data[offsets[a] : offsets[b]], inner, ALPHANUMERIC)
                sizes = np.bincount(row, minlength=b - a)
                n_docs += int((sizes > 0).sum())
                n_words += len(hashes)
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                found = vocabulary[at] == hashes
                keys, count = np.unique(row[found] * len(vocabulary) + at[found], return_counts=True)
                row, term = keys // len(vocabulary), keys % len(vocabulary)
                has, row = np.unique(row, return_inverse=True)
                if len(has):
                    # Copies: a view would hold on to the whole batch.
                    own_ids = pa.array(ids.slice(a, b - a).take(pa.array(has)).to_pylist(), pa.int64())
                    parts.append((own_ids, sizes[has], row, term, count))
                    rows += len(has)
                held += int(offsets[b] - offsets[a])
                if parts and (held >= SEGMENT_BYTES or rows >= SEGMENT_ROWS):
                    yield _segment(parts, n_docs, n_words)
                    parts, held, rows, n_docs, n_words = [], 0, 0, 0, 0
        if parts or n_docs:
            none = np.zeros(0, np.int64)
            yield _segment(parts or [(pa.array([], pa.int64()), none, none, none, none)], n_docs, n_words)

    return docs.select("doc_id", "text").mapInArrow(build, _SEGMENT)


def quotients(counts: np.ndarray, sizes: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """The share of a term's weight that a document of so many words earns for its count."""
    if len(sizes) and 90 * int(sizes.max()) * n_docs >= 1 << 63:
        long = np.array([10 + 90 * int(n) * n_docs // n_words for n in sizes], np.int64)
    else:
        long = 10 + 90 * sizes * n_docs // n_words
    return (1_000_000_000 * counts) // (1000 * counts + 8 * long)


class _Top:
    """The best documents of an item so far: highest score first, then least doc_id, null last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)
        self.least = 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        nulls = np.concatenate([self.nulls, nulls])
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]
        # A document that only ties with the last one may have a lesser doc_id: it gets in.
        self.least = max(1, int(self.scores[-1])) if len(order) == self.k else 1


class Segment:
    """A segment's lists with each posting's part of the score and each window's maxima."""

    def __init__(self, ids, nulls, sizes, terms, lengths, places, counts, weights, n_docs, n_words):
        self.ids, self.nulls, self.n = ids, nulls, len(ids)
        self.windows = max(1, ceil(self.n / WINDOW))
        self.of = {int(t): k for k, t in enumerate(terms)}
        self.lengths = lengths
        self.places = places.astype(np.int64)
        each = np.repeat(np.arange(len(terms)), lengths)
        self.scores = weights[terms[each]] * quotients(counts, sizes[self.places], n_docs, n_words)
        cell = each * self.windows + self.places // WINDOW
        self.cells = np.searchsorted(cell, np.arange(len(terms) * self.windows + 1))
        self.most = np.zeros(len(terms) * self.windows, np.int64)
        full = np.flatnonzero(self.cells[1:] > self.cells[:-1])
        if len(full):
            self.most[full] = np.maximum.reduceat(self.scores, self.cells[full])
        self.most = self.most.reshape(len(terms), self.windows)

    def part(self, own: int, window: int) -> slice:
        """Where a list's postings of a window lie."""
        cell = own * self.windows + window
        return slice(self.cells[cell], self.cells[cell + 1])

    def search(self, terms: np.ndarray, top: _Top) -> int:
        """Bring an item's best documents up to date; returns the postings looked at."""
        lists = [k for k in (self.of.get(int(t)) for t in terms) if k is not None]
        short = [k for k in lists if self.lengths[k] <= SHORT * self.n]
        long = np.array([k for k in lists if self.lengths[k] > SHORT * self.n], np.int64)
        looked = 0
        # Term at a time: the short lists become one list of summed scores.
        summed = np.zeros(self.windows * WINDOW, np.int64)
        for k in short:
            all_of_it = slice(self.cells[k * self.windows], self.cells[(k + 1) * self.windows])
            summed[self.places[all_of_it]] += self.scores[all_of_it]
            looked += all_of_it.stop - all_of_it.start
        summed = summed.reshape(self.windows, WINDOW)
        # The iterators' bounds by window; the last one is that of the summed list.
        bounds = np.vstack([self.most[long], summed.max(axis=1)[None]])
        reach = bounds.sum(axis=0)
        for window in np.flatnonzero(reach >= top.least):
            if reach[window] < top.least:
                continue
            order = np.argsort(bounds[:, window], kind="stable")
            below = np.cumsum(bounds[order, window])
            first = int(np.searchsorted(below, top.least))
            score = np.zeros(WINDOW, np.int64)
            for at in order[first:]:
                if at == len(long):
                    score += summed[window]
                else:
                    here = self.part(long[at], window)
                    score[self.places[here] - window * WINDOW] += self.scores[here]
                    looked += here.stop - here.start
            docs = np.flatnonzero(score)
            for k in range(first - 1, -1, -1):
                docs = docs[score[docs] + below[k] >= top.least]
                if not len(docs):
                    break
                if order[k] == len(long):
                    score[docs] += summed[window][docs]
                    continue
                here = self.part(long[order[k]], window)
                places = self.places[here] - window * WINDOW
                if not len(places):
                    continue
                at = np.minimum(np.searchsorted(places, docs), len(places) - 1)
                hit = places[at] == docs
                score[docs[hit]] += self.scores[here][at[hit]]
                looked += len(docs)
            docs = docs[score[docs] >= top.least]
            if len(docs):
                # Only the best k of a window can stay, and all that tie with the last of them.
                if len(docs) > top.k:
                    last = np.partition(score[docs], len(docs) - top.k)[len(docs) - top.k]
                    docs = docs[score[docs] >= last]
                at = docs + window * WINDOW
                top.add(score[docs], self.ids[at], self.nulls[at])
        return int(looked)


def _hits(index: DataFrame, items: list[tuple[int, np.ndarray]], weights: np.ndarray, n_docs: int, n_words: int, k: int) -> DataFrame:
    """The best ``k`` documents of each item in each task, as ``item, doc_id, score``."""
    sent = index.sparkSession.sparkContext.broadcast((items, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        tops = [_Top(k) for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                docs, sizes, terms, lengths, places, counts = (
                    batch.column(name)[row].values for name in ("docs", "sizes", "terms", "lengths", "places", "counts")
                )
                if not len(docs):
                    continue
                segment = Segment(
                    docs.fill_null(0).to_numpy(zero_copy_only=False),
                    docs.is_null().to_numpy(zero_copy_only=False),
                    *(x.to_numpy(zero_copy_only=False) for x in (sizes, terms, lengths, places, counts)),
                    weights,
                    n_docs,
                    n_words,
                )
                for (_, own), top in zip(items, tops, strict=True):
                    segment.search(own, top)
        for (item, _), top in zip(items, tops, strict=True):
            if len(top.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(top.scores), item), pa.int64()),
                        pa.array(top.ids, pa.int64(), mask=top.nulls),
                        pa.array(top.scores, pa.int64()),
                    ],
                    ["item", "doc_id", "score"],
                )

    return index.mapInArrow(search, "item bigint, doc_id bigint, score bigint")


def _weights(index: DataFrame, n_terms: int, n_docs: int) -> np.ndarray:
    """Each term's weight by the number of documents that hold it."""
    lists = index.select(F.inline(F.arrays_zip("terms", "lengths")))
    found = lists.groupBy("terms").agg(F.sum("lengths").alias("n"))
    weights = np.zeros(n_terms, np.int64)
    for row in found.collect():  # a row for each term asked for at once
        weights[row["terms"]] = floor(1000 * log((2 * n_docs + 2) / (2 * row["n"] + 1)))
    return weights


def search_documents(docs: DataFrame, items: DataFrame, *, k: int = 10, pairs: int = PAIRS) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    ``docs``: (doc_id, text); ``items``: (item_id, text). A term is a run of ASCII letters and
    digits and non-ASCII characters, A-Z lower-cased; an item counts each of its terms once. With
    N documents that hold a term, L terms in all of them, n terms in a document, df documents
    with a term and tf times of it in one, a document scores the sum of
    ``floor(1000 * ln((2 * N + 2) / (2 * df + 1))) * ((10**9 * tf) div (1000 * tf + 8 * m))``, where
    ``m`` is ``10 + (90 * n * N) div L``. Documents that score 0 are not listed.

    Equal scores are ranked by doc_id, null last. Each row of either table stands for
    itself: a repeated item_id has a list for each of its rows, and a repeated doc_id may be
    listed as often as it occurs. Null and empty texts have no terms: such a document is
    never listed and such an item has no rows. Other columns are not read.

    Items are sent to the tasks with at most about ``pairs`` distinct terms together; more
    items go in turns, each over all documents. A term is known by a 64-bit hash. A task
    gives out ``k`` documents an item; they are ranked in parts, then together.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = stored(
        items.select("item_id", _distinct_terms()("text").alias("terms")).withColumn(
            "item", F.monotonically_increasing_id()
        ),
        "items",
    )
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    turns = max(1, ceil(total / pairs))
    found = None
    for turn in range(turns):
        own = asked.filter((F.pmod(F.xxhash64("item"), F.lit(turns)) == turn) & (F.size("terms") > 0))
        own = [(row["item"], np.array(row["terms"], np.int64).view(np.uint64)) for row in own.select("item", "terms").collect()]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(terms for _, terms in own)]))
        if not len(vocabulary):
            continue
        index = stored(segments(docs, vocabulary), "segments")
        n_docs, n_words = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
        if not n_words:
            continue
        weights = _weights(index, len(vocabulary), n_docs)
        own = [(item, np.searchsorted(vocabulary, terms)) for item, terms in own]
        hits = _hits(index, own, weights, n_docs, n_words, k)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    best = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    for by in ((F.col("item"), part), (F.col("item"),)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best)))
        found = found.filter(F.col("rank") <= k)
    names = broadcast_if_small(asked.select("item", "item_id"))
    return found.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
