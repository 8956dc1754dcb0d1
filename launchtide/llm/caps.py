"""Near-duplicate vectors by spherical-cap filters from structured random product codes."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchtide.llm.components import components
from launchtide.llm.shared import stored

#: Vectors of one filter that are compared in one task at a time.
BLOCK = 1024
#: Codes of a half up to which a vector's caps need not grow in number.
FEW_CODES = 1 << 7
#: Greatest cosine of a cap's edge with its direction. Narrower caps part vectors at the threshold.
NARROWEST = 0.8
_FOUND = "node bigint, links bigint, least bigint"


def codebook(dimension: int, codes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation, and random unit directions for each half of the rotated vector.

    A filter direction is a pair of codes, one of each half: ``codes ** 2`` directions.
    """
    draw = np.random.Generator(np.random.PCG64([seed, dimension, codes]))
    rotation = np.linalg.qr(draw.standard_normal((dimension, dimension)))[0]
    first = dimension - dimension // 2
    halves = [draw.standard_normal((codes, n)) for n in (first, dimension - first)]
    return rotation, *(h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-12) for h in halves)


def cap_height(book: tuple, filters: float) -> float:
    """The height that ``filters`` directions exceed on average, by the products of random vectors.

    Sums of two products have shorter tails than a normal distribution, so it is not
    taken from one: lists would shrink as the codes grow.
    """
    rotation, left, right = book
    sample = np.random.Generator(np.random.PCG64(len(rotation))).standard_normal((64, len(rotation)))
    turned = sample / np.linalg.norm(sample, axis=1, keepdims=True) @ rotation
    a = turned[:, : left.shape[1]] @ left.T
    b = np.sort(turned[:, left.shape[1] :] @ right.T, axis=1)
    low, high = -2.0, 2.0
    for _ in range(40):
        middle = (low + high) / 2
        above = sum(int((len(y) - np.searchsorted(y, middle - x[x >= middle - y[-1]])).sum()) for x, y in zip(a, b, strict=True))
        low, high = (middle, high) if above >= filters * len(sample) else (low, middle)
    return high


def raised(codes: int, filters: float, least: int) -> tuple[float, int]:
    """``filters`` and ``least`` for so many codes: more directions part two vectors more often."""
    growth = max(1.0, log2(codes) / log2(FEW_CODES))
    return filters * growth, ceil(least * growth**2)


def fitting_book(dimension: int, codes: int, seed: int, filters: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A codebook of at most so many codes, fewer if its caps would be narrower than ``NARROWEST``."""
    book = codebook(dimension, codes, seed)
    while codes > 1 and cap_height(book, min(raised(codes, filters, 1)[0], codes**2 / 2)) > NARROWEST * sqrt(2):
        codes //= 2
        book = codebook(dimension, codes, seed)
    return book


def decode(unit: np.ndarray, book: tuple, filters: float, least: int) -> list[np.ndarray]:
    """All filters whose direction exceeds the cap's height, for each unit vector, sorted.

    The height lets a random vector into ``filters`` caps on average. A vector in fewer than
    ``least`` caps takes its ``least`` nearest directions. Codes of each half are sorted by
    their products; the best of one half meets a prefix of the other, so only directions
    in the list are touched.
    """
    rotation, left, right = book
    codes = len(left)
    turned = unit @ rotation
    a = turned[:, : left.shape[1]] @ left.T
    b = turned[:, left.shape[1] :] @ right.T
    height = cap_height(book, min(filters, codes**2 / 2))
    lists = []
    for x, y in zip(a, b, strict=True):
        i, j = np.argsort(-x), np.argsort(-y)
        rising = -y[j]
        ends = np.searchsorted(rising, x[i] - height, "right")
        if ends.sum() < min(least, codes**2):
            near = np.add.outer(x[i[:least]], y[j[:least]])
            best = np.argsort(-near, axis=None)[:least]
            keys = i[best // near.shape[1]] * codes + j[best % near.shape[1]]
        else:
            keys = np.concatenate([i[k] * codes + j[: ends[k]] for k in np.flatnonzero(ends)])
        lists.append(np.sort(keys))
    return lists


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of two sets of vectors have at least that cosine, in double precision."""
    return (a @ b.T) >= threshold * np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))


def _met_before(lists: list[np.ndarray], below: int) -> Iterator[np.ndarray]:
    """Membership of rows in the filters below one that several of them share, in blocks.

    Two rows meet in such a filter if the product of their rows in a block is not 0.
    """
    row = np.repeat(np.arange(len(lists)), [len(own) for own in lists])
    key = np.concatenate(lists)
    row, key = row[key < below], key[key < below]
    several, column, count = np.unique(key, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    row, column = row[count[column] > 1], rank[column[count[column] > 1]]
    for at in range(0, int((count > 1).sum()), BLOCK):
        inside = (column >= at) & (column < at + BLOCK)
        member = np.zeros((len(lists), min(BLOCK, int((count > 1).sum()) - at)), np.float32)
        member[row[inside], column[inside] - at] = 1
        yield member


def _least_reachable(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least position each of n positions reaches by pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_vectors(
    vectors: DataFrame,
    *,
    threshold: float = 0.95,
    filters: float = 24,
    least: int = 8,
    seed: int = 10,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other vectors found with a cosine of at least ``threshold``,
    copies included; ``component_id`` is the least vec_id reachable by such links, and
    the vector that bears it is kept.

    Equal vectors are one node. Each node is decoded to all filter directions it exceeds
    (:func:`decode`), about ``filters`` of ``codes ** 2``, where the codes grow with the
    root of the number of nodes, so a filter holds about as many at any size. Beyond
    ``FEW_CODES``, ``filters`` and ``least`` grow with the codes (:func:`raised`). Nodes that
    meet in a filter are compared in full. A filter with more than ``BLOCK`` nodes is cut
    into blocks, and every two blocks are a task. A pair that meets in several filters is
    counted in the first. What leaves a task is one row per node, with its links and the
    least node it is tied to there, never the pairs. All vectors are indexed; two at a
    threshold of 0.95 share a filter with a chance above 0.97 at any number of codes
    (``tests/llm`` measures it).

    A vector that is null, empty, zero, or holds null or non-finite numbers links with
    nothing, and vectors of unequal length don't link. A row without vec_id links with
    nothing, its component is null and it is kept. Rows that repeat a vec_id are one node
    if they are equal, else tied to each other by their id only.
    """
    numbers = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(fine & F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    known = numbers.select(
        "vec_id", F.when(usable, F.col("v")).alias("v"), F.xxhash64(F.lit(1), "v").alias("k1"), F.xxhash64(F.lit(2), "v").alias("k2")
    )
    nodes = stored(
        known.filter("v is not null")
        .groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.max("vec_id").alias("last"), F.first("v").alias("v")),
        "nodes",
    )
    codes = 32
    while codes**2 * 50 < nodes.count() * filters and codes < 1 << 14:
        codes *= 2

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[int, tuple] = {}
        for batch in batches:
            v = batch.column(2)
            ends = v.offsets.to_numpy()
            flat = v.values.to_numpy()
            keys: list = [None] * len(v)
            sizes = np.diff(ends)
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                own = np.stack([flat[ends[r] : ends[r + 1]] for r in rows])
                own = own / np.abs(own).max(axis=1, keepdims=True)
                own /= np.linalg.norm(own, axis=1, keepdims=True)
                if int(d) not in books:
                    books[int(d)] = fitting_book(int(d), codes, seed, filters)
                book = books[int(d)]
                for r, found in zip(rows, decode(own, book, *raised(len(book[1]), filters, least)), strict=True):
                    keys[r] = found + int(d) * codes**2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), v, pa.array(keys, pa.list_(pa.int64()))],
                ["node", "copies", "v", "keys"],
            )

    schema = "node bigint, copies bigint, v array<double>, keys array<bigint>"
    index = stored(nodes.select("node", "copies", "v").mapInArrow(listed, schema), "index")
    entries = index.select("node", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(seed)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    units = (
        entries.join(shared, "key")
        .select("node", "key", block.alias("block"), other)
        .select("node", "key", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
        .join(index, "node")
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        columns = {name: table.column(name).to_numpy() for name in ("node", "key", "block", "a", "b", "copies")}
        node, side = columns["node"], columns["block"] == columns["a"][0]
        keys = table.column("keys").combine_chunks()
        lists = np.split(keys.flatten().to_numpy(), np.cumsum(pc.list_value_length(keys).to_numpy())[:-1])
        members = list(_met_before(lists, columns["key"][0]))
        v = np.array(table.column("v").to_pylist(), np.float64)
        v /= np.abs(v).max(axis=1, keepdims=True)
        same = columns["a"][0] == columns["b"][0]
        left, right = (np.arange(len(node)),) * 2 if same else (np.flatnonzero(side), np.flatnonzero(~side))
        links = np.zeros(len(node), np.int64)
        pairs = []
        for k in range(0, len(left), 256):
            own = left[k : k + 256]
            near = similar(v[own], v[right], threshold)
            if same:
                near &= own[:, None] < right
            i, j = np.nonzero(near)
            pairs.append((own[i], right[j]))
            for member in members:
                near &= member[own] @ member[right].T == 0
            links[own] += near @ columns["copies"][right]
            links[right] += columns["copies"][own] @ near
        i, j = (np.concatenate([pair[k] for pair in pairs] or [np.zeros(0, np.int64)]) for k in (0, 1))
        order = np.argsort(node)
        place = np.empty(len(node), np.int64)
        place[order] = np.arange(len(node))
        least_node = node[order][_least_reachable(place[i], place[j], len(node))][place]
        found = (links > 0) | (least_node < node)
        return pa.table({"node": node[found], "links": links[found], "least": least_node[found]})

    found = stored(units.groupBy("key", "a", "b").applyInArrow(compare, _FOUND), "found")
    twice = known.filter("v is not null").join(nodes.select("k1", "k2", "node"), ["k1", "k2"])
    twice = twice.filter("vec_id <> node").join(nodes.select(F.col("node").alias("vec_id")), "vec_id", "left_semi")
    groups = components(found.select("node", "least").filter("least < node").union(twice.select("vec_id", "node")))
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = (
        nodes.drop("v")
        .join(totals, "node", "left")
        .join(groups, "node", "left")
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
        .filter("n_links > 0 or component is not null")
    )
    known = known.withColumn("usable", F.col("v").isNotNull()).drop("v")
    same_class = (known.k1 == classes.k1) & (known.k2 == classes.k2) & known.usable
    component = F.when(F.col("usable"), F.coalesce("component", "vec_id")).otherwise(F.col("vec_id"))
    return known.join(classes, same_class, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id").isNull() | (F.col("vec_id") == component)).alias("kept"),
    )
