"""Toxicity by a chain of linear classifiers over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from launchtide.llm.shared import spare, stored
from launchtide.llm.words import LOWER, pieces, texts_of

#: Hash buckets of n-grams, as a power of two.
BITS = 20
GRAMS = (5, 6)
#: Bytes of text that are worked on at a time.
PIECE = 1 << 18
_LETTER = LOWER.copy()
_LETTER[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 32
#: Labelled rows that a model is fitted on, at most: those of the least hash of doc_id.
FIT_ROWS = 12_000
#: Buckets a category may use: those that part its labels best.
FEATURES = 400
FOLDS = 4

# Categories in the order of the chain: a name, and which labelled rows belong to it. The
# last is the verdict itself; it sees what the ones before it say.
CATEGORIES = (
    ("toxic_en", "toxic = 1 and lang = 'en'"),
    ("toxic_other", "toxic = 1 and not (lang <=> 'en')"),
    ("toxic", "toxic = 1"),
)


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length in ``GRAMS``, the buckets of the n-grams of the given rows.

    With them comes where each row's n-grams begin. Letters are bytes, A-Z lower-cased, and
    anything but letters, digits and non-ASCII bytes is one kind of gap, so that a word's
    first and last letters show. A gap as long as the longest n-gram stands before each
    row and after the last, so no n-gram reaches from one row into another.
    """
    reach = max(GRAMS)
    n_rows = len(offsets) - 1
    begin = offsets + np.arange(n_rows + 1) * reach
    line = np.full(int(begin[-1]) + reach, 32, np.uint8)
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        at = a + (row + 1) * reach
        line[at : at + b - a] = data[a:b]
    line = _LETTER[line].astype(np.uint32)
    end = int(begin[-1])
    grams = line[:end].copy()
    for k in range(1, 4):
        grams |= line[k : k + end] << np.uint32(8 * k)
    grams *= np.uint32(0x9E3779B1)
    found = []
    for k in range(4, reach):
        grams ^= line[k : k + end] * np.uint32((0x85EBCA6B * (2 * k + 1)) & 0xFFFFFFFF)
        if k + 1 in GRAMS:
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32((0xC2B2AE35 + 2 * k) & 0xFFFFFFFF)
            found.append((mixed >> np.uint32(32 - BITS), begin))
    return found


def distinct_buckets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The distinct buckets of each text, some rows at a time."""
    data, offsets = texts_of(column)
    for a, b in pieces(offsets, PIECE):
        inner = offsets[a : b + 1] - offsets[a]
        found = gram_buckets(data[offsets[a] : offsets[b]], inner)
        yield [np.unique(np.concatenate([g[x[r] : x[r + 1]] for g, x in found])) for r in range(b - a)]


def with_buckets(docs: DataFrame) -> DataFrame:
    """``docs`` with the distinct buckets of ``text``, an array, in place of it.

    Rows come out a piece at a time, as their buckets are larger than the texts.
    """
    at = docs.columns.index("text")
    schema = T.StructType(docs.schema.fields[:at] + docs.schema.fields[at + 1 :]).add("buckets", T.ArrayType(T.IntegerType()))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.drop_columns(["text"])
            row = 0
            for part in distinct_buckets(batch.column(at)):
                ends = np.cumsum([0, *map(len, part)])
                values = np.concatenate([np.zeros(0, np.uint32), *part]).view(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                yield others.slice(row, len(part)).append_column("buckets", lists)
                row += len(part)

    return docs.mapInArrow(replace, schema)


@dataclass
class Rows:
    """Sparse rows of ones: the features of row i are ``index[ends[i]:ends[i + 1]]``."""

    index: np.ndarray
    ends: np.ndarray

    def __post_init__(self):
        self.row = np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.index], len(self.ends) - 1)

    def total(self, values: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.index, values[self.row], n)

    def pick(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.ends)[rows]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.ends[:-1][rows] - ends[:-1], sizes) + np.arange(ends[-1])
        return Rows(self.index[at], ends)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(rows: Rows, dense: np.ndarray, label: np.ndarray, n: int, steps: int = 300, decay: float = 1e-5):
    """Weights of sparse features, of dense ones and a bias: logistic regression.

    Accelerated gradient steps on the mean loss with squared weights added. Labels of one
    kind give that kind's share as a constant.
    """
    share = (label.sum() + 0.5) / (len(label) + 1)
    w, d, bias = np.zeros(n), np.zeros(dense.shape[1]), float(np.log(share / (1 - share)))
    if not len(label) or label.min() == label.max():
        return w, d, bias
    # The step that the curvature of a mean row allows.
    rate = 4 / (1 + dense.shape[1] + len(rows.index) / len(label))
    before = (w, d, bias)
    for step in range(steps):
        m = step / (step + 3)
        ahead = tuple(x + m * (x - y) for x, y in zip((w, d, bias), before, strict=True))
        error = (sigmoid(rows.dot(ahead[0]) + dense @ ahead[1] + ahead[2]) - label) / len(label)
        before = (w, d, bias)
        w = ahead[0] - rate * (rows.total(error, n) + decay * ahead[0])
        d = ahead[1] - rate * (dense.T @ error + decay * ahead[1])
        bias = ahead[2] - rate * error.sum()
    return w, d, bias


def fit_chain(rows: Rows, labels: np.ndarray, fold: np.ndarray, n: int) -> list[tuple]:
    """A model per column of ``labels``, each fed by what the earlier ones say.

    For fitting a later model the earlier probabilities of a row come from models that
    were not fitted on the row's fold; for use they come from models fitted on all rows.
    """
    models: list[tuple] = []
    held_out = np.zeros((len(labels), 0))
    for k in range(labels.shape[1]):
        label = labels[:, k].astype(float)
        models.append(fit_linear(rows, held_out, label, n))
        said = np.zeros(len(label))
        for each in np.unique(fold):
            rest, own = np.flatnonzero(fold != each), np.flatnonzero(fold == each)
            w, d, bias = fit_linear(rows.pick(rest), held_out[rest], label[rest], n)
            said[own] = sigmoid(rows.pick(own).dot(w) + held_out[own] @ d + bias)
        held_out = np.column_stack([held_out, said])
    return models


def predict_chain(rows: Rows, models: list[tuple]) -> np.ndarray:
    said = np.zeros((len(rows.ends) - 1, 0))
    for w, d, bias in models:
        said = np.column_stack([said, sigmoid(rows.dot(w) + said @ d + bias)])
    return said


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[tuple[str, str]] = CATEGORIES,
    fit_rows: int = FIT_ROWS,
    features: int = FEATURES,
) -> tuple[np.ndarray, list[tuple]]:
    """Feature number of each bucket, -1 for none, and the models of the chain.

    Fitted on at most ``fit_rows`` labelled documents, those of the least hashes of
    doc_id. Spark counts in how many of them each bucket occurs, by category; the buckets
    that part a category's rows best become its features. Only those, of at most that many
    documents, reach the driver. Without usable labels there are no features and every
    document scores 1/2 of a row: next to nothing.
    """
    # Rows that repeat a doc_id are one label: toxic if any of them says so.
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("label_id")
    ).agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    drawn = text.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select(
        "doc_id",
        "text",
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"),
        *(F.coalesce(F.expr(rule).cast("int"), F.lit(0)).alias(f"c{k}") for k, (_, rule) in enumerate(categories)),
    )
    sample = stored(with_buckets(drawn), "sample")
    names = [f"c{k}" for k in range(len(categories))]
    totals = sample.agg(F.count("*"), *(F.sum(c) for c in names)).first()
    table = np.full(1 << BITS, -1, np.int16)
    if not totals[0]:
        return table, [(np.zeros(0), np.zeros(k), -5.0) for k in range(len(names))]
    counts = sample.select(F.explode("buckets").alias("bucket"), *names).groupBy("bucket").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in names))
    counts = stored(counts.filter("n >= 3"), "counts")
    picked: set[int] = set()
    for k, name in enumerate(names):
        yes, all_rows = totals[k + 1], totals[0]
        if not 0 < yes < all_rows:
            continue
        p = F.col("n") / float(all_rows)
        apart = (F.col(name) - p * float(yes)) / F.sqrt(float(yes) * p * (1 - p) + 1e-9)
        best = counts.orderBy(F.abs(apart).desc(), "bucket").limit(features).select("bucket")
        picked |= {row[0] for row in best.collect()}
    order = np.array(sorted(picked), np.int64)
    table[order] = np.arange(len(order))
    wanted = F.array_intersect("buckets", F.lit(order.tolist()).cast("array<int>")) if len(order) else F.array().cast("array<int>")
    rows = sample.select("fold", *names, wanted.alias("own")).orderBy("doc_id").toArrow()
    lists = rows.column("own").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends = lists.offsets.to_numpy().astype(np.int64)
    index = table[lists.values.to_numpy()[ends[0] : ends[-1]]].astype(np.int64)
    label = np.column_stack([rows.column(c).to_numpy() for c in names])
    fitted = fit_chain(Rows(index, ends - ends[0]), label, rows.column("fold").to_numpy(), len(order))
    return table, fitted


def scorer(docs: DataFrame, model: tuple[np.ndarray, list[tuple]], names: Sequence[str]):
    """Arrow function: a struct of the chain's probabilities for each text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, models = held.value
        for column in columns:
            data, offsets = texts_of(column)
            said = [np.zeros((0, len(names)))]
            for a, b in pieces(offsets, PIECE):
                inner = offsets[a : b + 1] - offsets[a]
                pairs = []
                for bucket, begin in gram_buckets(data[offsets[a] : offsets[b]], inner):
                    feature = table[bucket]
                    used = np.flatnonzero(feature >= 0)
                    row = np.searchsorted(begin, used, "right") - 1
                    pairs.append((row << BITS) | feature[used])
                both = np.unique(np.concatenate(pairs))
                ends = np.searchsorted(both, np.arange(b - a + 1) << BITS)
                said.append(predict_chain(Rows(both & ((1 << BITS) - 1), ends), models))
            yield pa.StructArray.from_arrays(list(map(pa.array, np.concatenate(said).T.copy())), list(names))

    score.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "struct<" + ",".join(f"{name}:double" for name in names) + ">")


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, categories: Sequence[tuple[str, str]] = CATEGORIES, threshold: float = 0.5
) -> DataFrame:
    """One row per document: ``doc_id``, a probability per category, ``rejected``.

    A chain of linear models reads the distinct character n-grams of the whole text, with
    the probabilities of the categories before; the last category is the verdict, and a
    document is rejected if its probability is ``threshold`` or more. ``lang`` serves to
    part the labels into categories for fitting, and is not read for scoring.

    A null or empty text has no n-grams but the gap around it and scores the models'
    bias. Rows keep their number, also when doc_ids repeat or are null. Labels without
    doc_id or value are left out; without labels nothing is rejected.
    """
    names = [name for name, _ in categories]
    model = fit_toxicity(docs, labels, categories)
    told = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), scorer(docs, model, names)("text").alias("told")
    )
    return told.select("doc_id", "told.*").withColumn("rejected", F.col(names[-1]) >= threshold)


def drop_toxic(
    docs: DataFrame, labels: DataFrame, *, categories: Sequence[tuple[str, str]] = CATEGORIES, threshold: float = 0.5
) -> DataFrame:
    """The documents that :func:`score_toxicity` does not reject, columns as they are."""
    names = [name for name, _ in categories]
    told, columns = spare(docs, "told"), docs.columns
    scored = docs.withColumn(told, scorer(docs, fit_toxicity(docs, labels, categories), names)("text"))
    return scored.filter(F.col(f"{told}.{names[-1]}") < threshold).select(*(F.col(f"`{c}`") for c in columns))
