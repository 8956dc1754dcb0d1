"""Phrase mining by best-first growth with admissible bounds.

Words and pairs are counted over all documents. Longer phrases grow from a frontier of
prefixes. A phrase that begins with prefix p occurs at most f(p) times, and cut after its first
word it has f(first word) on one side and at least its own count on the other; so its score
is at most ``2000000 * f(p) / (f(first word) + f(p))``. Each round takes the prefixes whose bound
reaches a floor, a score set for each language so that its best prefixes come first, and
counts what grows from them, and what contains a phrase at or above the floor. Then all
phrases at or above the floor are known with their counts, and whether a longer one
holds them. A language is settled when as many of those survive as were asked for; else its
floor falls. Phrases that tie with the last are at the floor or above, so they are there too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.shared import broadcast_if_small, stored
from launchtide.llm.words import LOWER, mix, pieces, texts_of, words

#: Bits of a filter at most: 16 MB. A filter never loses a key; a fuller one lets more through.
FILTER_BITS = 27
#: Bytes of counts a task holds before it adds them up, and gives them out if they stay many.
HELD = 8 << 20

_WORD = np.ones(256, bool)
_WORD[[ord(c) for c in " \t.,;:!?\n\x0b\x0c\r"]] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
#: By how many bits the ids of a phrase's words are turned in its key.
_TURNS = (0, 17, 34, 51)


def _keys(ids: np.ndarray, size: int) -> np.ndarray:
    """The key of the run of ``size`` words that begins at each word."""
    n = max(len(ids) - size + 1, 0)
    total = ids[:n].copy()
    for k in range(1, size):
        own, turn = ids[k : k + n], _TURNS[k]
        total ^= (own << np.uint64(turn)) | (own >> np.uint64(64 - turn))
    return total


def _key(*words: str) -> Column:
    """The same key from columns."""
    turned = (F.shiftleft(w, t).bitwiseOR(F.shiftrightunsigned(w, 64 - t)) if t else F.col(w) for w, t in zip(words, _TURNS))
    return reduce(Column.bitwiseXOR, turned)


def _sequences(batches: Iterator[pa.RecordBatch]):
    """Some rows at a time: word ids that differ by language, whether the next word goes on in
    the same piece, and what is needed to spell them."""
    for batch in batches:
        data, offsets = texts_of(batch.column(0))
        names = batch.column(1).dictionary_encode()
        salts = [int.from_bytes(blake2b(x.encode(), digest_size=8).digest()) for x in names.dictionary.to_pylist()]
        salt = np.array(salts, np.uint64)[names.indices.to_numpy(zero_copy_only=False)]
        for a, b in pieces(offsets):
            own = data[offsets[a] : offsets[b]]
            hashes, row, begin = words(own, offsets[a : b + 1] - offsets[a], _WORD)
            ids = mix(hashes ^ salt[a:b][row])
            piece = np.searchsorted(np.flatnonzero(_STOP[own]), begin)
            goes_on = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
            yield ids, goes_on, (own, begin, names.slice(a, b - a), row)


def _together(goes_on: np.ndarray, size: int) -> np.ndarray:
    """Whether the run of ``size`` words that begins at each word lies in one piece."""
    n = max(len(goes_on) - size + 2, 0)
    whole = np.ones(n, bool)
    for k in range(size - 1):
        whole &= goes_on[k : k + n]
    return whole


class _Counts:
    """Counts by key, with the columns that go with a key."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.held = 0

    def add(self, keys: np.ndarray, columns: list, counts: np.ndarray | None = None) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
        counts = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts[order], first)
        at = order[first]
        taken = [c.take(pa.array(at)) if isinstance(c, pa.Array) else c[at] for c in columns]
        self.parts.append((sorted_keys[first], taken, counts))
        self.held += sum(c.nbytes for c in taken) + 16 * len(first)

    def full(self) -> bool:
        """Add up what is held when it is much; whether it is still much."""
        if self.held > HELD and len(self.parts) > 1:
            parts, self.parts, self.held = self.parts, [], 0
            joined = [
                pa.concat_arrays(cs) if isinstance(cs[0], pa.Array) else np.concatenate(cs)
                for cs in zip(*(columns for _, columns, _ in parts), strict=True)
            ]
            self.add(np.concatenate([k for k, _, _ in parts]), joined, np.concatenate([c for _, _, c in parts]))
        return self.held > HELD // 2 and len(self.parts) == 1

    def out(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        for _, columns, counts in self.parts:
            arrays = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64)) for c in columns]
            arrays = [c.cast(pa.string()) if pa.types.is_large_string(c.type) else c for c in arrays]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int64())], names)
        self.parts, self.held = [], 0


def _summed(texts: DataFrame, count, schema: str, name: str) -> DataFrame:
    """``count(counts, sequence)`` over all texts, summed by all columns but ``c``."""
    names = [part.split()[0] for part in schema.split(", ")]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for sequence in _sequences(batches):
            count(counts, *sequence)
            if counts.full():
                yield from counts.out(names)
        counts.full()
        yield from counts.out(names)

    return texts.select("text", "lang").mapInArrow(tally, schema).groupBy(*names[:-1]).agg(F.sum("c").alias(name))


def word_counts(texts: DataFrame) -> DataFrame:
    """``w, lang, word, f``: every word of every language with its occurrences."""

    def count(counts, ids, goes_on, spelled):
        if len(ids):
            own, begin, names, row = spelled
            member = _WORD[own]
            ends = np.concatenate(([0], np.cumsum(np.add.reduceat(member, begin, dtype=np.int64))))
            spelling = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(ends), pa.py_buffer(LOWER[own[member]]))
            counts.add(ids, [ids, names.take(pa.array(row)).cast(pa.string()), spelling])

    return _summed(texts, count, "w bigint, lang string, word string, c bigint", "f")


def pair_counts(texts: DataFrame, frequent) -> DataFrame:
    """``w1, w2, a``: pairs of words that pass a filter."""

    def count(counts, ids, goes_on, spelled):
        known = _has(frequent.value[0], ids)
        at = np.flatnonzero(_together(goes_on, 2) & known[:-1] & known[1:]) if len(ids) > 1 else []
        if len(at):
            counts.add(_keys(ids, 2)[at], [ids[at], ids[at + 1]])

    return _summed(texts, count, "w1 bigint, w2 bigint, c bigint", "a")


def triple_counts(texts: DataFrame, pairs) -> DataFrame:
    """``w1, w2, w3, a``: what grows by a word from a prefix, or ends in a phrase held up
    to the floor. ``pairs``: filters of all pairs that count, of prefixes, of phrases."""

    def count(counts, ids, goes_on, spelled):
        if len(ids) < 3:
            return
        every, prefixes, phrases = pairs.value
        two = _keys(ids, 2)
        known = _has(every, two)
        grown = _has(prefixes, two)[:-1] | _has(phrases, two)[1:]
        at = np.flatnonzero(_together(goes_on, 3) & known[:-1] & known[1:] & grown)
        if len(at):
            counts.add(_keys(ids, 3)[at], [ids[at + k] for k in range(3)])

    return _summed(texts, count, "w1 bigint, w2 bigint, w3 bigint, c bigint", "a")


def quadruple_counts(texts: DataFrame, pairs, triples) -> DataFrame:
    """``w1, w2, w3, w4, a``: the same a word further, and triples that end such a phrase
    (``w4`` null), which its first cut leaves. ``pairs``: filters of all pairs that count and
    of those that end a prefix; ``triples``: filters of prefixes and phrases."""

    def count(counts, ids, goes_on, spelled):
        if len(ids) < 3:
            return
        (every, ends), (prefixes, phrases) = pairs.value, triples.value
        two, three = _keys(ids, 2), _keys(ids, 3)
        known = _has(every, two)
        whole = _together(goes_on, 3) & known[:-1] & known[1:]
        at = np.flatnonzero(whole & _has(ends, two)[:-1])
        if len(at):
            counts.add(three[at], [*(ids[at + k] for k in range(3)), pa.nulls(len(at), pa.int64())])
        if len(ids) > 3:
            grown = _has(prefixes, three)[:-1] | _has(phrases, three)[1:]
            at = np.flatnonzero(whole[:-1] & whole[1:] & grown)
            if len(at):
                last = pa.array(ids[at + 3].view(np.int64))
                counts.add(_keys(ids, 4)[at], [*(ids[at + k] for k in range(3)), last])

    return _summed(texts, count, "w1 bigint, w2 bigint, w3 bigint, w4 bigint, c bigint", "a")


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each key; always if it does."""
    at = keys & np.uint64(8 * len(bits) - 1)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _filters(rows: DataFrame, key: Column, n: int, *conditions: Column):
    """A broadcast tuple of filters, one for the keys of the rows under each condition.

    Their size depends on ``n``, the number of keys, and has an upper bound.
    """
    bits = min(max(ceil(log2(n + 1)) + 4, 15), FILTER_BITS)
    place = key.bitwiseAND((1 << bits) - 1)
    parts = (
        rows.select(F.shiftright(place, 15).alias("part"), *(F.when(c, place.bitwiseAND(32767)).alias(f"p{i}") for i, c in enumerate(conditions)))
        .groupBy("part")
        .agg(*(F.bitmap_construct_agg(f"p{i}").alias(f"p{i}") for i in range(len(conditions))))
        .collect()
    )
    made = tuple(np.zeros(1 << (bits - 3), np.uint8) for _ in conditions)
    for row in parts:
        for i, filled in enumerate(made):
            filled[row["part"] << 12 : (row["part"] + 1) << 12] = np.frombuffer(row[f"p{i}"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(made)


def _ratio(a: str, l: str, r: str) -> Column:
    """``floor(2000000 * a / (l + r))`` in whole numbers of any size."""
    exact = "cast({} as decimal(20,0))".format
    return F.expr(f"cast(2000000 as decimal(7,0)) * {exact(a)} div ({exact(l)} + {exact(r)})")


def _cut(*sides: tuple[str, str]) -> Column:
    """Score, place and sides of the lowest-scoring cut, the first of several."""
    cuts = [
        F.struct(_ratio("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
        for k, (l, r) in enumerate(sides, 1)
    ]
    return F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]


def _with(rows: DataFrame, table: DataFrame, count: str, name: str, *pairs: tuple[str, str], more=(), how="inner") -> DataFrame:
    """Add the count of a part as ``name``; ``pairs``: (column of the part, word here)."""
    part = table.select(*(F.col(there).alias(f"_{here}") for there, here in pairs), F.col(count).alias(name), *more)
    same = reduce(lambda x, y: x & y, (F.col(here) == F.col(f"_{here}") for _, here in pairs))
    return rows.join(part, same, how).drop(*(f"_{here}" for _, here in pairs))


def _best(rows: DataFrame, cut: Column, *words: str) -> DataFrame:
    """``lang, <words>, a, l, r, score, bound``."""
    return rows.withColumn("cut", cut).select(
        "lang", *words, "a", "cut.l", "cut.r", "cut.score", _ratio("a", "f1", "a").alias("bound")
    )


def _surviving(rows: DataFrame, longer: DataFrame | None, covered: int, words: list[str]) -> DataFrame:
    """Rows of which no phrase a word longer holds nearly as many occurrences."""
    if longer is None:
        return rows
    size = len(words)
    heads = longer.select(*words, F.col("a").alias("b"))
    tails = longer.select(*(F.col(f"w{k + 2}").alias(f"w{k + 1}") for k in range(size)), F.col("a").alias("b"))
    most = heads.unionByName(tails).groupBy(*words).agg(F.max("b").alias("b"))
    exact = "cast({} as decimal(20,0))".format
    return (
        rows.join(most, words, "left")
        .filter(F.expr(f"b is null or 100 * {exact('b')} < {covered} * {exact('a')}"))
        .drop("b")
    )


def _grown(texts: DataFrame, ones: DataFrame, two: DataFrame, n_two: int, floors: DataFrame, least: int, covered: int) -> DataFrame:
    """All surviving phrases at or above their language's floor, by a round of growth."""
    at_floor = F.col("score") >= F.col("floor")
    ahead = F.col("bound") >= F.col("floor")
    pairs = two.join(floors, "lang")
    filters = _filters(pairs, _key("w1", "w2"), n_two, F.lit(True), ahead, at_floor)
    counted = triple_counts(texts, filters).filter(F.col("a") >= least)
    small = broadcast_if_small(two)

    def triples(rows: DataFrame) -> DataFrame:
        rows = _with(rows, ones, "f", "f1", ("w", "w1"), more=["lang"])
        rows = _with(rows, ones, "f", "f3", ("w", "w3"))
        rows = _with(rows, small, "a", "a12", ("w1", "w1"), ("w2", "w2"))
        rows = _with(rows, small, "a", "a23", ("w1", "w2"), ("w2", "w3"))
        return _best(rows, _cut(("f1", "a23"), ("a12", "f3")), "w1", "w2", "w3")

    three = stored(triples(counted), "triples")
    prefixes = three.join(floors, "lang")
    n_three = three.count()
    ends = stored(
        prefixes.filter(ahead).select(F.col("w2").alias("w1"), F.col("w3").alias("w2")).distinct().withColumn("end", F.lit(True)),
        "ends",
    )
    ending = pairs.join(broadcast_if_small(ends), ["w1", "w2"], "left")
    longer = stored(
        quadruple_counts(
            texts,
            _filters(ending, _key("w1", "w2"), n_two, F.lit(True), F.col("end")),
            _filters(prefixes, _key("w1", "w2", "w3"), n_three, ahead, at_floor),
        ).filter(F.col("a") >= least),
        "quadruples",
    )
    # The counts are those of whole phrases, however often a phrase was asked for.
    more = longer.filter("w4 is null").drop("w4").join(three.select("w1", "w2", "w3"), ["w1", "w2", "w3"], "left_anti")
    three = stored(three.unionByName(triples(more)), "triples")
    four = longer.filter("w4 is not null")
    four = _with(four, ones, "f", "f1", ("w", "w1"), more=["lang"])
    four = _with(four, ones, "f", "f4", ("w", "w4"))
    four = _with(four, small, "a", "a12", ("w1", "w1"), ("w2", "w2"))
    four = _with(four, small, "a", "a34", ("w1", "w3"), ("w2", "w4"))
    known = broadcast_if_small(three)
    four = _with(four, known, "a", "a123", *((f"w{k}", f"w{k}") for k in (1, 2, 3)), how="left")
    four = _with(four, known, "a", "a234", *((f"w{k}", f"w{k + 1}") for k in (1, 2, 3)), how="left")
    # Without its prefix among the triples a phrase is below the floor: it only covers others.
    four = _best(four, F.when(F.col("a123").isNotNull(), _cut(("f1", "a234"), ("a12", "a34"), ("a123", "f4"))), "w1", "w2", "w3", "w4")
    four = stored(four, "quadruples")
    alive = None
    for size, rows, next_ones in ((2, two, three), (3, three, four), (4, four, None)):
        words = [f"w{k}" for k in range(1, size + 1)]
        rows = rows.join(floors, "lang").filter(at_floor)
        rows = _surviving(rows, next_ones, covered, words)
        missing = (F.lit(None).cast("long").alias(f"w{k}") for k in range(size + 1, 5))
        rows = rows.select("lang", *words, *missing, "a", "l", "r", "score")
        alive = rows if alive is None else alive.unionByName(rows)
    return stored(alive, "alive")


def mine_phrases(docs: DataFrame, *, most: int = 2000, least: int = 30, covered: int = 80) -> DataFrame:
    """Each language's ``most`` best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs``: (text, lang). Texts are lower-cased (A-Z) and split at ``. , ; : ! ?``, line
    feeds, carriage returns, vertical tabs and form feeds into pieces, and these at spaces and
    tabs into words. A candidate is a phrase of 2 to 4 words that occurs at least ``least`` times within
    pieces (``a``, overlaps included). Cut after some of its words, ``l`` and ``r`` are the
    occurrences of both parts, and the cut's score is ``floor(2000000 * a / (l + r))``; the lowest-scoring
    cut counts, the first of several. Candidates that lie within a longer one with at least
    ``covered`` per cent of their occurrences are left out, whether or not that one is.
    ``n`` counts all words of the language. Ranks go by score, then ``a``, both falling, then by the
    phrase in UTF-8 byte order.

    A null text is empty, a null language is ``und``. Repeated rows count as often as they
    occur. Without candidates there are no rows. Other columns are not read. Words are known
    by 64-bit hashes, filters are of bounded size, and counts are summed in tasks before
    their shuffle, so a very frequent phrase is a row a task.
    """
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    counted = stored(word_counts(texts), "words")
    sizes = broadcast_if_small(stored(counted.groupBy("lang").agg(F.sum("f").alias("n")), "sizes"))
    frequent = stored(counted.filter(F.col("f") >= least), "frequent")
    ones = broadcast_if_small(frequent)
    pairs = pair_counts(texts, _filters(frequent, F.col("w"), frequent.count(), F.lit(True))).filter(F.col("a") >= least)
    pairs = _with(pairs, ones, "f", "f1", ("w", "w1"), more=["lang"])
    pairs = _with(pairs, ones, "f", "f2", ("w", "w2"))
    two = stored(_best(pairs, _cut(("f1", "f2")), "w1", "w2"), "pairs")
    n_two = two.count()
    best_first = Window.partitionBy("lang").orderBy(F.col("score").desc())
    found, unsettled, reach = None, None, 2 * most
    while n_two:
        rows = two if unsettled is None else two.join(unsettled, "lang", "left_semi")
        # The floor is the score of the pair at rank ``reach``; where there are fewer, nothing is below it.
        first = rows.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= reach)
        floor = F.when(F.max("place") >= reach, F.min("score")).otherwise(0)
        floors = broadcast_if_small(stored(first.groupBy("lang").agg(floor.alias("floor")), "floors"))
        own = texts if unsettled is None else texts.join(unsettled, "lang", "left_semi")
        alive = _grown(own, ones, two, n_two, floors, least, covered)
        each = floors.join(alive.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left")
        each = stored(each.withColumn("settled", (F.coalesce("kept", F.lit(0)) >= most) | (F.col("floor") == 0)), "settled")
        done = alive.join(broadcast_if_small(each.filter("settled").select("lang")), "lang", "left_semi")
        found = done if found is None else found.unionByName(done)
        unsettled = each.filter("not settled").select("lang")
        if unsettled.isEmpty():
            break
        unsettled = broadcast_if_small(unsettled)
        reach *= 4
    if found is None:
        kept = ", ".join(f"{name} bigint" for name in ("w1", "w2", "w3", "w4", "a", "l", "r", "score"))
        found = docs.sparkSession.createDataFrame([], f"lang string, {kept}")
    for k in range(1, 5):
        found = _with(found, ones, "word", f"s{k}", ("w", f"w{k}"), how="left")
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (
        found.withColumn("phrase", F.concat_ws(" ", *(f"s{k}" for k in range(1, 5))))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= most)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
