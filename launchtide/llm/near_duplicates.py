"""Near-duplicate groups by one-permutation MinHash, banded buckets and star edges."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchtide.llm.components import components
from launchtide.llm.minhash import signatures
from launchtide.llm.shared import broadcast_if_small, spare, stored
from launchtide.llm.words import mix, shingle_sets

#: Bytes of text whose shingles a task holds at a time; a longer text is held alone.
PIECE = 1 << 17
#: Members of a bucket that are held against as many others in one task.
BLOCK = 512
#: An over-full bucket is split this often, by so many further bins; and how often its parts are.
#: Two sets of similarity 0.8 meet in 1.3 parts of a bucket that they share (8 * 0.8^8).
TRIALS, WIDTH, DEPTHS = 8, 8, 8
_SKETCH = "struct<n:bigint,h1:bigint,h2:bigint,signature:binary>"


def _digest(own: np.ndarray, salt: int) -> int:
    return int(mix(own ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64))


def sketcher(size: int, n_bins: int):
    """Arrow function: set size, 128-bit digest of the set, and signature of each text."""

    def sketch(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for sets in shingle_sets(column, size, PIECE):
                n = [len(own) for own in sets]
                h1 = [_digest(own, 0x243F6A8885A308D3) for own in sets]
                h2 = [_digest(own, 0x13198A2E03707344) for own in sets]
                packed = [row.tobytes() for row in signatures(sets, n_bins).astype(">u4")]
                yield pa.StructArray.from_arrays(
                    [pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(packed, pa.binary())],
                    ["n", "h1", "h2", "signature"],
                )

    sketch.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(sketch, _SKETCH)


def setter(size: int):
    """Arrow function: the whole shingle set of each text, sorted."""

    def whole(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for sets in shingle_sets(column, size, PIECE):
                ends = np.cumsum([0, *(len(own) for own in sets)])
                values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))

    whole.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(whole, "array<bigint>")


def crowded(members: DataFrame) -> DataFrame:
    """Members of buckets that hold several, beside the bucket's least one: ``low, low_n``.

    ``members``: (key, node, n). Most buckets hold one node, and nothing follows from those.
    The least member is a grouped minimum; a bucket with a third of all rows is split by the
    join, as its other side is one row.
    """
    centers = (
        members.groupBy("key")
        .agg(F.min(F.struct("node", "n")).alias("center"), F.max("node").alias("most"))
        .filter("center.node < most")
        .select("key", F.col("center.node").alias("low"), F.col("center.n").alias("low_n"))
    )
    return members.join(centers, "key")


def star_edges(members: DataFrame, percent: int) -> DataFrame:
    """Distinct ``(low, high)``: each member of a bucket with the bucket's least member.

    ``members``: what :func:`crowded` gives. A bucket of m members gives m - 1 pairs. Sizes
    that rule the similarity out are dropped at once.
    """
    return (
        members.filter("low < node")
        .filter(100 * F.least("n", "low_n") >= percent * F.greatest("n", "low_n"))
        .select("low", F.col("node").alias("high"))
        .distinct()
    )


def _sets(docs: DataFrame, ends: DataFrame, size: int) -> DataFrame:
    """``node, set``: the whole shingle sets of the documents named in a stored table."""
    return stored(
        docs.join(broadcast_if_small(ends), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("node"), setter(size)("text").alias("set"))
        .distinct(),
        "sets",
    )


def _verified(docs: DataFrame, edges: DataFrame, size: int, percent: int) -> DataFrame:
    """The edges whose whole shingle sets are similar enough."""
    ends = edges.select(F.explode(F.array("low", "high")).alias("doc_id")).distinct()
    sets = _sets(docs, stored(ends, "ends"), size)
    low = sets.select(F.col("node").alias("low"), F.col("set").alias("low_set"))
    high = sets.select(F.col("node").alias("high"), F.col("set").alias("high_set"))
    common = F.size(F.array_intersect("low_set", "high_set"))
    union = F.size("low_set") + F.size("high_set") - common
    return (
        edges.join(high, "high")
        .join(low, "low")
        .filter(100 * common.cast("long") >= percent * union.cast("long"))
        .select("low", "high")
    )


def _mixed(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, stored.

    Beside each stand the component of the bucket's least member (``main``), the number of
    members (``m``), and of those left over (``others``), which are in other components.
    """
    labelled = members.drop("low", "low_n").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_bucket = (
        labelled.groupBy("key")
        .agg(F.min(F.struct("node", "component")).alias("first"), F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("m"))
        .filter("a < b")
        .select("key", "m", F.col("first.component").alias("main"))
    )
    mixed = stored(labelled.join(of_bucket, "key"), "mixed")
    left = mixed.filter("component <> main").groupBy("key").agg(F.count("*").alias("others"))
    return stored(mixed.join(left, "key"), "mixed")


def _split(big: DataFrame, nodes: DataFrame, depth: int, n_bins: int, rows: int) -> DataFrame:
    """Members of over-full buckets in ``TRIALS`` narrower ones each, by ``WIDTH`` further bins.

    Which bins are asked differs by band, trial and depth, so that a pair which one
    narrower bucket parts meets in others.
    """
    picks = []
    for band in range(n_bins // rows):
        for trial in range(TRIALS):
            salt = np.uint64((((depth << 16) + band) * TRIALS + trial) * n_bins)
            order = np.argsort(mix(np.arange(n_bins, dtype=np.uint64) + salt), kind="stable")
            picks.append((band, trial, order[:WIDTH].tolist()))
    asked = F.broadcast(big.sparkSession.createDataFrame(picks, "band int, trial int, bins array<int>"))
    values = F.transform("bins", lambda b: F.substring(F.col("signature"), 4 * b + 1, F.lit(4)))
    return (
        big.select("key", "band", "node", "n")
        .join(nodes.select("node", "signature"), "node")
        .join(asked, "band")
        .select("node", "n", "band", F.xxhash64("key", "trial", values).alias("key"))
    )


def _completed(docs: DataFrame, members: DataFrame, nodes: DataFrame, links: DataFrame, size: int, percent: int, n_bins: int, rows: int) -> DataFrame:
    """``(node, component)`` by the links and those that the buckets' stars have missed.

    Of buckets that hold several components after their stars, each member that is not in
    the least one's is held against all members (:func:`_held`). Where more than ``BLOCK``
    members are left over that would grow with their square; such a bucket is split by
    further bins of the signatures (:func:`_split`), the parts are starred, and those that
    still hold several components come back here.
    """
    found, groups = [], components(links)
    for depth in count():
        mixed = _mixed(members, groups)
        big = mixed.filter(F.col("others") > BLOCK)
        whole = depth == DEPTHS or big.isEmpty()
        # Only where every shared band is held against all, a pair can be left to its first.
        some = mixed if whole else mixed.filter(F.col("others") <= BLOCK)
        found.append(stored(_held(docs, some, nodes, size, percent, n_bins, rows, whole and not depth), "missed"))
        if whole:
            return groups if found[-1].isEmpty() and len(found) == 1 else components(reduce(DataFrame.union, [links, *found]))
        members = stored(crowded(_split(big, nodes, depth, n_bins, rows)), "members")
        edges = stored(star_edges(members, percent), "edges")
        found.append(stored(_verified(docs, edges, size, percent), "links"))
        groups = components(reduce(DataFrame.union, [links, *found]))


def _held(docs: DataFrame, mixed: DataFrame, nodes: DataFrame, size: int, percent: int, n_bins: int, rows: int, once: bool) -> DataFrame:
    """``(low, high)``: links of members left over in their buckets with any other member.

    Both sides are cut into blocks, and two blocks are a task. Signatures tell first which
    members may have a partner: by four deviations, by size, in another component, and,
    with ``once``, in no earlier band. Only those come back with their whole sets, which
    decide. Neither step gives out pairs: the first names members, the second one link for
    each member and component it reaches.
    """
    n_bands = n_bins // rows

    def blocks(of: str) -> Column:
        return F.ceil(F.col(of) / BLOCK).cast("int")

    def own(of: str) -> Column:
        return F.pmod(F.xxhash64("node", "key"), blocks(of)).cast("int")

    def each(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(of) - 1))

    columns = ["key", "band", "node", "component", "n"]
    asking = mixed.filter("component <> main").select(*columns, own("others").alias("a"), each("m").alias("b"), F.lit(True).alias("asks"))
    others = mixed.select(*columns, each("others").alias("a"), own("m").alias("b"), F.lit(False).alias("asks"))
    units = asking.union(others).join(nodes.select("node", "signature"), "node")
    margin = percent / 100 - 4 * sqrt(percent / 100 * (1 - percent / 100) / n_bins)
    schema = "key bigint, band int, node bigint, component bigint, n bigint, a int, b int, asks boolean, signature binary"

    def partners(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        """For each asking row, the rows that signatures leave possible."""
        component, n, asks = (table.column(c).to_numpy(zero_copy_only=False) for c in ("component", "n", "asks"))
        band = table.column("band")[0].as_py()
        signature = np.stack([np.frombuffer(row.as_py(), ">u4") for row in table.column("signature")]).astype(np.uint32)
        two = np.flatnonzero(~asks)
        for x in np.flatnonzero(asks):
            y = two[(component[two] != component[x]) & (100 * np.minimum(n[two], n[x]) >= percent * np.maximum(n[two], n[x]))]
            same = signature[y] == signature[x]
            near = same.mean(axis=1) >= margin
            if once:
                near &= same[:, : n_bands * rows].reshape(-1, n_bands, rows).all(axis=2).argmax(axis=1) == band
            yield x, y[near]

    def possible(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        named = np.zeros(table.num_rows, bool)
        for x, y in partners(table):
            named[y] = True
            named[x] |= len(y) > 0
        return table.filter(pa.array(named))

    def confirmed(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, component = (table.column(c).to_numpy() for c in ("node", "component"))
        sets = [row.values.to_numpy() for row in table.column("set")]
        low, high = [], []
        for x, y in partners(table):
            reached = set()
            for k in y:
                if component[k] not in reached:
                    common = len(np.intersect1d(sets[x], sets[k], assume_unique=True))
                    if 100 * common >= percent * (len(sets[x]) + len(sets[k]) - common):
                        reached.add(component[k])
                        low.append(min(node[x], node[k]))
                        high.append(max(node[x], node[k]))
        return pa.table({"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})

    named = stored(units.select(*(x.split()[0] for x in schema.split(", "))).groupBy("key", "a", "b").applyInArrow(possible, schema), "possible")
    sets = _sets(docs, stored(named.select(F.col("node").alias("doc_id")).distinct(), "ends"), size)
    pairs = named.join(sets, "node").groupBy("key", "a", "b").applyInArrow(confirmed, "low bigint, high bigint")
    return pairs.distinct()


def near_duplicates(
    docs: DataFrame, *, size: int = 5, percent: int = 80, n_bins: int = 128, rows: int = 4
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when the Jaccard similarity of their sets of distinct
    ``size``-word shingles is at least ``percent`` / 100. Words are parted by ASCII white
    space, A-Z lower-cased. ``component_id`` is the least doc_id reachable by links, and
    the document that bears it is kept.

    Documents with equal sets become one node before any pair is made. Each node puts its
    signature in ``n_bins // rows`` buckets. Every bucket ties its members to its least
    one, and the pairs are confirmed on full sets. That settles nearly all buckets; where
    one still holds several components, the members left over are held against the others
    (:func:`_completed`), so a pair is not lost because neither is near the least member. At similarity 0.8 a pair shares no
    bucket with chance (1 - 0.8^4)^32 = 5e-8, more for sets of few shingles. Where more than
    ``BLOCK`` members are left over in each bucket that a pair shares, it has to meet in a part of one of
    them: it is in some 13 of 32 buckets, hence in some 17 parts of the first split.

    A text that is null, empty or without words has no shingles and links with nothing;
    so does a document without doc_id, whose component is null and which is kept. Rows
    that repeat a doc_id are one node. Only ``doc_id`` and ``text`` are read; other
    columns, whatever their names, don't matter.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = stored(
        docs.select("doc_id", sketcher(size, n_bins)("text").alias("s")).select("doc_id", "s.*"),
        "sketches",
    )
    known = sketch.filter("doc_id is not null")
    nodes = stored(
        known.filter("n > 0")
        .groupBy("h1", "h2", "n")
        .agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last"), F.first("signature").alias("signature")),
        "nodes",
    )
    bands = [
        F.xxhash64(F.lit(k), F.substring("signature", 1 + 4 * rows * k, 4 * rows))
        for k in range(n_bins // rows)
    ]
    banded = nodes.select("node", "n", F.posexplode(F.array(*bands)).alias("band", "key"))
    # Read twice, by the stars and by what they have missed: most of the rows end here.
    members = stored(crowded(banded), "members")
    edges = stored(star_edges(members, percent), "edges")
    links = stored(_same_id(known, nodes).union(_verified(docs, edges, size, percent)), "links")
    groups = _completed(docs, members, nodes, links, size, percent, n_bins, rows)
    return _labelled(sketch, nodes, groups)


def _same_id(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the classes of rows that repeat a doc_id with other texts."""
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1")
    return (
        known.join(repeated, "doc_id")
        .join(nodes.select("h1", "h2", "n", "node"), ["h1", "h2", "n"])
        .filter("doc_id <> node")
        .select(F.col("node").alias("low"), F.col("doc_id").alias("high"))
    )


def _labelled(sketch: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """Components of nodes brought back to the documents of their classes."""
    classes = (
        nodes.join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .filter("component <> node or last <> node")
        .select("h1", "h2", "n", "component")
    )
    return (
        sketch.drop("signature")
        .join(classes, ["h1", "h2", "n"], "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns as they are, less those near a kept one of less doc_id.

    Rows that repeat a doc_id are one document: they stay or go together.
    """
    name = spare(docs, "kept_id")
    kept = near_duplicates(docs, **options).filter("kept").select(F.col("doc_id").alias(name))
    return docs.join(kept.distinct(), docs.doc_id.eqNullSafe(F.col(name)), "left_semi")
