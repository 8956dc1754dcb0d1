"""Quality by a byte-level convolutional network written in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchtide.llm.shared import spare, stored
from launchtide.llm.words import pieces, texts_of

WIDTH = 8
FILTERS = 16
#: Half a chunk: chunks are two cells long and begin every cell.
CELL = 128
#: How far back a repeat of four bytes is looked for.
LAGS = 48
#: Zero bytes between two texts, more than any filter or lag reaches.
GAP = 64
#: Bytes of text that are worked on at a time.
PIECE = 1 << 17
#: Labelled rows that the network is fitted on, at most, each whole. None follows once they hold so many bytes.
FIT_ROWS = 4_000
FIT_BYTES = 64 << 20


@dataclass
class Network:
    """``tables``: what each filter adds for each symbol at each of its places."""

    tables: np.ndarray  # (WIDTH, symbols, FILTERS)
    bias: np.ndarray
    head: np.ndarray  # of mean and greatest activations
    head_bias: float


@dataclass
class Batch:
    """Texts laid in one line, with gaps, and how many cells each has.

    ``bounds`` are where cells begin, and after a text's last one where its gap does;
    ``is_cell`` tells them apart.
    """

    symbols: np.ndarray
    cells: np.ndarray
    bounds: np.ndarray
    is_cell: np.ndarray


def lay_out(texts: list[np.ndarray]) -> Batch:
    """Symbols of texts: a byte, plus 256 where its four bytes stand up to 48 bytes before."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = GAP + np.concatenate(([0], np.cumsum(sizes + GAP)[:-1]))
    line = np.zeros(int(begin[-1] + sizes[-1] + GAP + WIDTH), np.uint8)
    for at, text in zip(begin.tolist(), texts, strict=True):
        line[at : at + len(text)] = text
    wide = line.astype(np.uint32)
    four = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    seen = np.zeros(len(four), bool)
    for lag in range(1, LAGS + 1):
        seen[lag:] |= four[lag:] == four[:-lag]
    symbols = line.astype(np.int16)
    symbols[:-3][seen] += 256
    symbols[line == 0] = 0
    return Batch(symbols, *_bounds(begin, sizes))


def _bounds(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of texts, and where they and the gaps after them begin."""
    cells = np.maximum(-(-sizes // CELL), 1)
    last = np.cumsum(cells + 1) - 1
    place = np.arange(int(last[-1]) + 1) - np.repeat(last - cells, cells + 1)
    bounds = np.repeat(begin, cells + 1) + place * CELL
    bounds[last] = begin + np.maximum(sizes, 1)
    is_cell = np.ones(len(bounds), bool)
    is_cell[last] = False
    return cells, bounds, is_cell


def convolve(net: Network, symbols: np.ndarray) -> np.ndarray:
    """What each filter says at each place."""
    n = len(symbols) - WIDTH + 1
    out = np.take(net.tables[0], symbols[:n], axis=0)
    for k in range(1, WIDTH):
        out += np.take(net.tables[k], symbols[k : k + n], axis=0)
    return out


def spans(net: Network, batch: Batch) -> Iterator[tuple[slice, int, np.ndarray]]:
    """What each filter says, some ``PIECE`` bytes of a batch at a time: bounds, begin, output."""
    ends = np.append(batch.bounds[1:], len(batch.symbols) - WIDTH + 1)
    at = 0
    while at < len(batch.bounds):
        begin = int(batch.bounds[at])
        until = max(int(np.searchsorted(ends, begin + PIECE, "right")), at + 1)
        yield slice(at, until), begin, convolve(net, batch.symbols[begin : int(ends[until - 1]) + WIDTH - 1])
        at = until


def peaks(batch: Batch, parts: Iterable[tuple[slice, int, np.ndarray]]) -> np.ndarray:
    """The most each filter says in each cell."""
    found = [np.maximum.reduceat(out, batch.bounds[own] - begin, axis=0) for own, begin, out in parts]
    return np.concatenate(found)[batch.is_cell]


def pooled(net: Network, batch: Batch, peak: np.ndarray):
    """Greatest activation by cell, by chunk; their mean and greatest by text."""
    cell = peak + net.bias
    np.maximum(cell, 0, out=cell)
    last = np.cumsum(batch.cells) - 1
    chunk = cell.copy()
    chunk[:-1] = np.maximum(cell[:-1], cell[1:])
    # The chunk that would begin with a text's last cell is part of the one before it.
    own = np.ones(len(cell), bool)
    own[last] = batch.cells == 1
    chunk[last] = cell[last]
    count = np.maximum(batch.cells - 1, 1)
    ends = np.concatenate(([0], np.cumsum(count)[:-1]))
    kept = chunk[own]
    mean = np.add.reduceat(kept, ends, axis=0) / count[:, None]
    most = np.maximum.reduceat(kept, ends, axis=0)
    return cell, own, count, np.concatenate([mean, most], axis=1).astype(np.float64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_batch(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    batch = lay_out(texts)
    _, _, _, features = pooled(net, batch, peaks(batch, spans(net, batch)))
    return sigmoid(features @ net.head + net.head_bias)


def score_long(net: Network, text: np.ndarray) -> float:
    """The score of one text of any length, piece by piece.

    Pieces begin at a cell and reach one cell and the lags into the next, so each chunk
    lies in a piece as it lies in the text.
    """
    total, most, count = np.zeros(FILTERS), np.zeros(FILTERS), 0
    n_cells = max(-(-len(text) // CELL), 1)
    step = PIECE // CELL
    for at in range(0, n_cells, step):
        until = min(at + step + 1, n_cells)
        if at and until - at == 1:
            break
        before = max(at * CELL - GAP, 0)
        after = min(until * CELL + WIDTH, len(text))
        line = text[before:after]
        batch = lay_out([line])
        own_begin = np.array([GAP + at * CELL - before])
        part = Batch(batch.symbols, *_bounds(own_begin, np.array([min(until * CELL, len(text)) - at * CELL])))
        _, _, number, features = pooled(net, part, peaks(part, spans(net, part)))
        total += features[0, :FILTERS] * number[0]
        most = np.maximum(most, features[0, FILTERS:])
        count += int(number[0])
    return float(sigmoid(np.concatenate([total / count, most]) @ net.head + net.head_bias))


def fit_network(texts: list[np.ndarray], labels: np.ndarray, *, epochs: int = 10, batch_size: int = 32, seed: int = 8) -> Network:
    """Fit all weights by Adam on the mean logistic loss; gradients pass through the maxima.

    Texts are read whole; what filters say is held for ``PIECE`` bytes at a time if a batch
    is longer.
    """
    draw = np.random.Generator(np.random.PCG64(seed))
    letters = draw.standard_normal((513, 8))
    tables = np.einsum("se,kef->ksf", letters, draw.standard_normal((WIDTH, 8, FILTERS))) * 0.05
    net = Network(tables.astype(np.float32), np.zeros(FILTERS, np.float32), draw.standard_normal(2 * FILTERS) * 0.1, 0.0)
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 1 - 1e-3
    net.head_bias = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        net.head[:] = 0
        return net
    held = [net.tables, net.bias, net.head, np.array([net.head_bias])]
    moments = [(np.zeros_like(x, np.float32), np.zeros_like(x, np.float32)) for x in held]
    step, total = 0, max(epochs * -(-len(texts) // batch_size), 200)
    while step < total:
        order = draw.permutation(len(texts))
        for at in range(0, len(order), batch_size):
            rows = order[at : at + batch_size]
            batch = lay_out([texts[r] for r in rows])
            short = len(batch.symbols) <= 2 * PIECE
            held_parts = list(spans(net, batch)) if short else None
            peak = peaks(batch, held_parts or spans(net, batch))
            cell, own, count, features = pooled(net, batch, peak)
            error = (sigmoid(features @ net.head + held[3][0]) - labels[rows]) / len(rows)
            grads = [np.zeros_like(net.tables), None, features.T @ error + 1e-4 * net.head, np.array([error.sum()])]
            back = np.outer(error, net.head)
            # To chunks, from the mean and from the greatest; then to the greater cell.
            text_of = np.repeat(np.arange(len(rows)), batch.cells)
            following = np.minimum(np.arange(len(cell)) + 1, len(cell) - 1)
            single = (batch.cells == 1)[text_of]
            right = np.where(single[:, None], -1, cell[following])
            value = np.maximum(cell, right)
            down = (back[:, :FILTERS] / count[:, None])[text_of]
            down = down + np.where(value == features[:, FILTERS:].astype(np.float32)[text_of], back[text_of, FILTERS:], 0)
            down[~own] = 0
            to_left = cell >= right
            to_cell = np.where(to_left, down, 0)
            np.add.at(to_cell, following, np.where(to_left, 0, down))
            to_cell[cell <= 0] = 0
            grads[1] = to_cell.sum(axis=0)
            # To the place in the cell where the filter said most.
            number = np.where(batch.is_cell, np.cumsum(batch.is_cell) - 1, -1)
            for bounds, begin, out in held_parts or spans(net, batch):
                part_of = np.zeros(len(out), np.int64)
                part_of[batch.bounds[bounds] - begin] = 1
                cell_of = number[bounds][np.cumsum(part_of) - 1]
                place, which = np.nonzero((out == peak[cell_of]) & (to_cell != 0)[cell_of] & (cell_of >= 0)[:, None])
                first = np.unique(cell_of[place] * FILTERS + which, return_index=True)[1]
                place, which = place[first], which[first]
                amount = to_cell[cell_of[place], which]
                for k in range(WIDTH):
                    np.add.at(grads[0][k], (batch.symbols[begin + place + k], which), amount)
            step += 1
            rate = 0.01 * (1 - step / (total + 1)) + 1e-4
            for x, g, (m, v) in zip(held, grads, moments, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                x -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(x.dtype)
            net.tables *= 1 - 1e-4
            if step >= total:
                break
    net.head_bias = float(held[3][0])
    return net


def held_out(doc_id: str = "doc_id"):
    """Whether a row's label is kept from fitting: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Network:
    """Fit on at most ``fit_rows`` labelled documents that are not held out.

    They are those of the least hashes of doc_id, each with its whole text; the first of them
    if together they hold more than ``fit_bytes``. Nothing else reaches the driver. Rows that repeat a doc_id are one label, the lower.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").alias("quality"))
    chosen = known.filter(~held_out("label_id")).orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows)
    sample = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "quality", F.coalesce("text", F.lit("")).cast("binary").alias("part"), F.monotonically_increasing_id().alias("nth")),
        "sample",
    )
    # Only lengths meet in one task, not texts.
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "hash", "nth").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sample.select("doc_id", "nth", F.xxhash64("part").alias("hash"), F.octet_length("part").alias("size"))
    first = sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).filter(F.col("before") < fit_bytes)
    rows = sample.join(F.broadcast(first.select("nth")), "nth").orderBy("doc_id", "part").select("quality", "part").toArrow()
    texts = [np.frombuffer(part.as_buffer(), np.uint8) for part in rows.column("part")]
    return fit_network(texts, rows.column("quality").to_numpy().astype(float))


def scorer(docs: DataFrame, net: Network):
    """Arrow function: the probability of quality 1 of each text, read to its end."""
    shared = docs.sparkSession.sparkContext.broadcast((net.tables, net.bias, net.head, net.head_bias))

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Network(*shared.value)
        for column in columns:
            data, offsets = texts_of(column)
            said = [np.zeros(0)]
            for a, b in pieces(offsets, PIECE):
                texts = [data[i:j] for i, j in zip(offsets[a:b].tolist(), offsets[a + 1 : b + 1].tolist(), strict=True)]
                if len(texts) == 1 and len(texts[0]) > 2 * PIECE:
                    said.append(np.array([score_long(own, texts[0])]))
                else:
                    said.append(score_batch(own, texts))
            yield pa.array(np.concatenate(said))

    score.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")


def score_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The network reads the bytes of the whole text. Each byte is a symbol with a mark of
    whether its four bytes stood shortly before. Learned filters of ``WIDTH`` symbols run
    over overlapping chunks; of each chunk the greatest activation counts, and mean and
    greatest over all chunks make one probability. Nothing but the text is read for a
    score.

    ``held_out`` rows (:func:`held_out`) take no part in fitting; a row without doc_id is
    not held out. A null or empty text is a gap and has the score of one. Rows keep their
    number, also when doc_ids repeat. Without labels, all texts score as good.
    """
    net = fit_quality(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(docs, net)("text").alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """The documents that :func:`score_quality` predicts to be good, columns as they are."""
    name, columns = spare(docs, "score"), docs.columns
    scored = docs.withColumn(name, scorer(docs, fit_quality(docs, labels))("text"))
    return scored.filter(F.col(name) >= threshold).select(*(F.col(f"`{c}`") for c in columns))
