"""Toxicity by a classifier chain of linear models (operator 10).

Categories are predicted one after the other; each model sees the document's
words (hashed, present or not) and the probabilities of the categories before
it. Those are out-of-fold in training: the rows are split into ``FOLDS`` by a
hash of the id, and a row's probability comes from a model fitted on the other
folds, so later models learn from predictions as good as those they will meet.
For use, each category's model is fitted once more on all training rows.

A model is a logistic regression over word features scaled by their log ratio
of class frequencies, which keeps the many words that tell nothing near zero.
The fits of a category run as parallel tasks.

Training takes for each category at most ``TRAIN_ROWS`` documents that have its
label, those with the smallest hashes of their ids, whatever the corpus holds,
and each model is fitted on all of the taken ones that have its label; every
document is scored, in whole.

Defined cases: a null or empty text has no features and gets the intercept's
probability; documents without labels are scored like others and never trained
on; a label that is null, or without a document, is ignored, the document's other
labels are not, and of labels or
documents that repeat an id the largest label and one text count; a category
with one class in training predicts that class; without any labelled document
its probability is 0; an empty table gives no rows. Columns other than the
id, text and labels are not read.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import temporary_tables, written
from ferry.llm.wordhash import NO_LETTER, WordHasher, blocks

FEATURE_BITS = 18
FOLDS = 3
#: The bound of the training sample.
TRAIN_ROWS = 16_000
MIN_DOCUMENTS = 2
STEPS, RATE, REGULARISATION = 120, 0.1, 1e-4
THRESHOLD = 0.3
_ROWS = 512


class Model(NamedTuple):
    words: np.ndarray  # a weight per hashed word
    earlier: np.ndarray  # a weight per earlier category
    bias: float

    def logits(self, flat: np.ndarray, bounds: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(self.words[flat], dtype=np.float64)))
        return sums[bounds[1:]] - sums[bounds[:-1]] + earlier @ self.earlier + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def features(texts: Sequence[str | None], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """``(words, bounds)``: the distinct hashed words of text i are ``words[bounds[i]:bounds[i + 1]]``."""
    data = [(t or "").encode() for t in texts]
    found, ends, done = [np.empty(0, np.int64)], [0], 0
    for lo, hi in blocks(data):
        hashes, bounds = hasher.words(data[lo:hi])
        row = np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(bounds))
        keys = np.unique(row << FEATURE_BITS | (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
        found.append(keys & ((1 << FEATURE_BITS) - 1))
        ends += (done + np.searchsorted(keys, np.arange(1, hi - lo + 1, dtype=np.int64) << FEATURE_BITS)).tolist()
        done += len(keys)
    return np.concatenate(found), np.array(ends)


def fit(flat: np.ndarray, bounds: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> Model:
    """Logistic regression on the scaled words and the earlier probabilities, by Adam on all rows."""
    size, n = 1 << FEATURE_BITS, len(y)
    none = Model(np.zeros(size), np.zeros(earlier.shape[1]), 0.0)
    if n == 0 or y.min() == y.max():
        return none._replace(bias=-1e9 if n == 0 or y[0] == 0 else 1e9)
    row = np.repeat(np.arange(n), np.diff(bounds))
    count = np.bincount(flat, minlength=size)
    positive = np.bincount(flat, weights=y[row], minlength=size)
    ratio = np.log((positive + 1) / (y.sum() + 2)) - np.log((count - positive + 1) / ((1 - y).sum() + 2))
    ratio[count < MIN_DOCUMENTS] = 0
    used = np.flatnonzero(ratio)
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    keep = place[flat] >= 0
    row, column = row[keep], place[flat[keep]]
    value = ratio[used][column]
    params = [np.zeros(len(used)), np.zeros(earlier.shape[1]), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        z = np.bincount(row, weights=params[0][column] * value, minlength=n) + earlier @ params[1] + params[2]
        error = (_sigmoid(z) - y) / n
        slopes = [
            np.bincount(column, weights=error[row] * value, minlength=len(used)) + REGULARISATION * params[0],
            earlier.T @ error + REGULARISATION * params[1],
            np.array([error.sum()]),
        ]
        for p, m, v, s in zip(params, first, second, slopes):
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    words = np.zeros(size)
    words[used] = params[0] * ratio[used]
    return Model(words, params[1], float(params[2][0]))


# ------------------------------------------------------------------ training

def training_rows(docs: DataFrame, labels: DataFrame, categories: Sequence[str], limit: int = TRAIN_ROWS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fold, words`` and the 0/1 categories, or null, of at most ``limit`` labelled documents a category, written."""
    label = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    per_doc = labels.select("doc_id", *[label(c).alias(c) for c in categories]).na.drop(subset=["doc_id"])
    per_doc = per_doc.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    known = written(docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id")).distinct().join(per_doc, "doc_id"), "chain-labels")
    # ids only are ordered; texts are read for the chosen few, which are at most ``limit`` rows a category
    order = (F.xxhash64(F.lit("train"), F.col("doc_id")), "doc_id")
    ids = [known.filter(F.col(c).isNotNull()).select("doc_id").orderBy(*order).limit(limit) for c in categories]
    chosen = written(known.join(reduce(DataFrame.union, ids).distinct(), "doc_id"), "chain-sample")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(separator=NO_LETTER)
        for whole in batches:
            for lo in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(lo, _ROWS)
                flat, bounds = features(batch.column(1).to_pylist(), hasher)
                words = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), words, *batch.columns[2:]], names=["doc_id", "words", *categories])

    columns = ", ".join(f"`{c}` double" for c in categories)
    parts = rows.select("doc_id", "text", *categories).mapInArrow(run, f"doc_id bigint, words array<int>, {columns}")
    return written(parts.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")), "chain-rows")


_FIT = pa.schema([("fit", pa.int32()), ("words", pa.binary()), ("earlier", pa.list_(pa.float64())), ("bias", pa.float64()),
                  ("ids", pa.list_(pa.int64())), ("p", pa.list_(pa.float64()))])


def _fit_task(category: str, earlier: Sequence[str]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id").combine_chunks()
        words = table.column("words").combine_chunks()
        lengths = np.diff(words.offsets.to_numpy())
        flat, bounds = words.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lengths)))
        before = np.stack([table.column(f"p_{c}").to_numpy() for c in earlier], axis=1) if earlier else np.zeros((table.num_rows, 0))
        y, train = table.column(category).to_numpy(), table.column("train").to_numpy()

        def some(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return flat[np.repeat(mask, lengths)], np.concatenate(([0], np.cumsum(lengths[mask]))), before[mask]

        used = train & ~np.isnan(y)
        model = fit(*some(used), y[used])
        held = some(~train)
        row = {"fit": table.column("fit")[0].as_py(), "words": model.words.astype(np.float32).tobytes(), "earlier": model.earlier.tolist(),
               "bias": model.bias, "ids": table.column("doc_id").to_numpy()[~train].tolist(), "p": _sigmoid(model.logits(*held)).tolist()}
        return pa.Table.from_pylist([row], schema=_FIT)

    return run


def fit_chain(rows: DataFrame, categories: Sequence[str]) -> list[Model]:
    """One model per category, in order, from ``training_rows``; later ones are fitted on out-of-fold probabilities."""
    models = []
    for k, category in enumerate(categories):
        earlier, last = list(categories[:k]), k + 1 == len(categories)
        fits = F.array(*[F.lit(f) for f in ([FOLDS] if last else range(FOLDS + 1))])  # fit FOLDS leaves no fold out
        tasks = rows.select("doc_id", "words", "fold", category, *[f"p_{c}" for c in earlier], F.explode(fits).alias("fit"))
        tasks = tasks.withColumn("train", F.col("fold") != F.col("fit"))
        fitted = written(
            tasks.groupBy("fit").applyInArrow(
                _fit_task(category, earlier), "fit int, words binary, earlier array<double>, bias double, ids array<bigint>, p array<double>"),
            "chain-fits",
        )
        final = fitted.filter(F.col("fit") == FOLDS).select("words", "earlier", "bias").first()  # one model
        if final is None:
            models.append(Model(np.zeros(1 << FEATURE_BITS), np.zeros(k), -1e9))
        else:
            models.append(Model(np.frombuffer(final["words"], np.float32), np.array(final["earlier"], dtype=np.float64), final["bias"]))
        if not last:
            held = fitted.filter(F.col("fit") != FOLDS).select(F.explode(F.arrays_zip("ids", "p")).alias("r"))
            held = held.select(F.col("r.ids").alias("doc_id"), F.col("r.p").alias(f"p_{category}"))
            rows = written(rows.join(held, "doc_id"), "chain-rows")
    return models


def score(docs: DataFrame, models: Sequence[Model], categories: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, p_<category> ...`` for every document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    names = [f"p_{c}" for c in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(separator=NO_LETTER)
        for whole in batches:
            for lo in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(lo, _ROWS)
                flat, bounds = features(batch.column(1).to_pylist(), hasher)
                p = np.zeros((batch.num_rows, 0))
                for model in models:
                    p = np.column_stack([p, _sigmoid(model.logits(flat, bounds, p))])
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in p.T]], names=["doc_id", *names])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"`{n}` double" for n in names))


def classify(docs: DataFrame, labels: DataFrame, categories: Sequence[str], limit: int = TRAIN_ROWS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train the chain on the labelled documents and score all of them."""
    with temporary_tables(docs.sparkSession):  # the models are on the driver, of bounded size
        models = fit_chain(training_rows(docs, labels, categories, limit, id_col, text_col), categories)
    return score(docs, models, categories, id_col, text_col)
