"""Quality classifier: a byte-level convolutional network in numpy.

A filter of ``width`` bytes is a table of 256 weights per position, so a convolution over raw
UTF-8 is ``width`` table look-ups and adds per byte.  The whole document is read in blocks of
bounded size; responses are max-pooled over chunks of ``chunk`` bytes that overlap by half, so
every byte counts twice (the first and last half chunk once).  A linear layer turns each chunk's
pooled responses into a logit, and the mean of the chunk logits, scaled, is the document's
probability.

Training (on the driver) reads a bounded, documented sample: ``docs_per_label`` labelled rows of
each label with the smallest hash of their id, and of each at most ``chunks_per_doc`` chunks
spread over the whole text.  Rows with crc32(id as text) mod ``folds`` = 0 never take part.
Labels, language, source and id are never inputs of a score.

Defined cases: a null or empty text is one chunk of padding and gets a score like any other; a
null id is not held out; labels that are null or not 0 or 1 are ignored; without labelled rows of
both labels the score is the smoothed share of label 1; repeated rows are scored alike; an empty
table gives no rows; extra columns are ignored or, in ``keep_good``, passed through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import free_names, text_or_empty

BLOCK = 64


@dataclass
class Model:
    """tables[j][byte] adds to every filter; weights and bias make a chunk's logit; scale the document's."""
    tables: np.ndarray      # width x 256 x filters, float32
    offset: np.ndarray      # filters
    weights: np.ndarray     # filters
    bias: float
    scale: tuple[float, float]
    chunk: int
    constant: float | None = None

    def chunk_logits(self, text: bytes) -> np.ndarray:
        """One logit per overlapping chunk, over the whole text."""
        width, half = len(self.tables), self.chunk // 2
        n = max(1, len(text) - width + 1)
        halves = -(-n // half)
        data = np.zeros(halves * half + width - 1, np.uint8)
        data[:len(text)] = np.frombuffer(text, np.uint8)
        pooled = np.empty((halves, self.tables.shape[2]), np.float32)
        for at in range(0, halves, BLOCK):
            to = min(at + BLOCK, halves)
            rows = (to - at) * half
            part = data[at * half:to * half + width - 1]
            got = self.tables[0].take(part[:rows], axis=0)
            for j in range(1, width):
                got += self.tables[j].take(part[j:j + rows], axis=0)
            if to == halves:
                got[n - at * half:] = -np.inf
            pooled[at:to] = got.reshape(to - at, half, -1).max(axis=1)
        if halves > 1:
            pooled = np.maximum(pooled[:-1], pooled[1:])
        return np.maximum(pooled + self.offset, 0) @ self.weights + self.bias

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        a, b = self.scale
        return float(1 / (1 + np.exp(-np.clip(a * self.chunk_logits(text).mean(dtype=np.float64) + b, -30, 30))))


# ---------------------------------------------------------------- training

def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 300) -> tuple[float, float]:
    """Slope (kept positive) and intercept of a one-variable logistic regression."""
    a, b = 1.0, 0.0
    mean, dev = x.mean(), x.std() + 1e-6
    z = (x - mean) / dev
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(a * z + b))) - y
        a, b = max(0.05, a - 0.3 * ((g * z).mean() + 1e-3 * a)), b - 0.3 * g.mean()
    return float(a / dev), float(b - a * mean / dev)


def train(chunks: np.ndarray, sizes: np.ndarray, owner: np.ndarray, label: np.ndarray, chunk: int = 256,
          width: int = 6, filters: int = 24, epochs: int = 10, batch: int = 192, rate: float = 0.01,
          shortened: float = 0.12, seed: int = 7) -> Model:
    """Fit by Adam: chunks (rows x chunk+width-1 bytes), sizes (bytes used), owner (document), label.

    A share of the chunks is shortened at random in each batch, as short texts are judged too.
    """
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 0.3, (width, 256, filters)).astype(np.float32)
    offset, weights, bias = np.zeros(filters, np.float32), rng.normal(0, 0.3, filters).astype(np.float32), np.zeros(1, np.float32)
    params = [tables, offset, weights, bias]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    positions = np.arange(chunk)
    share = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    share = (share * len(label)).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            x, used = chunks[rows], sizes[rows]
            short = rng.random(len(rows)) < shortened
            used = np.where(short, rng.integers(np.minimum(used, 16), used + 1), used)
            got = tables[0].take(x[:, :chunk], axis=0)
            for j in range(1, width):
                got += tables[j].take(x[:, j:j + chunk], axis=0)
            got[positions[None, :] >= np.maximum(1, used - width + 1)[:, None]] = -np.inf
            best = got.argmax(axis=1)                                    # rows x filters
            top = np.take_along_axis(got, best[:, None, :], 1)[:, 0] + offset
            hidden = np.maximum(top, 0)
            error = (1 / (1 + np.exp(-(hidden @ weights + bias[0]))) - label[rows]) * share[rows] / len(rows)
            back = error[:, None] * weights * (top > 0)
            grads = [np.zeros_like(tables), back.sum(0), hidden.T @ error + 1e-4 * weights, error.sum(keepdims=True)]
            r, f = np.nonzero(back)
            for j in range(width):
                np.add.at(grads[0][j], (x[r, best[r, f] + j], f), back[r, f])
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model = Model(tables, offset, weights, float(bias[0]), (1.0, 0.0), chunk)
    logits = np.array([model.chunk_logits(c[:n].tobytes()).mean() for c, n in zip(chunks, sizes)])
    docs, at = np.unique(owner, return_inverse=True)
    mean = np.bincount(at, logits) / np.bincount(at)
    y = np.zeros(len(docs))
    y[at] = label
    model.scale = _logistic(mean, y)
    return model


def held_out(id_col: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int = 5,
        docs_per_label: int = 1500, chunks_per_doc: int = 5, chunk: int = 256, width: int = 6, **how) -> Model:
    """A model from at most 2 * docs_per_label labelled rows outside the held-out fold."""
    named = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter(~held_out(F.col("id"), folds) & F.col("id").isNotNull() & F.col("label").isin(0, 1))
    picked = None
    for value in (0, 1):
        some = named.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(docs_per_label)
        picked = some if picked is None else picked.union(some)
    size = chunk + width - 1

    def cut_chunks(batches):
        for b in batches:
            rows = {"id": [], "label": [], "n": [], "bytes": []}
            for i, label, text in zip(b.column("id").to_pylist(), b.column("label").to_pylist(), b.column("text")):
                text = text.as_py()
                last = max(0, len(text) - size)
                for at in sorted({last * k // max(1, chunks_per_doc - 1) for k in range(chunks_per_doc)}):
                    part = text[at:at + size]
                    for name, value in zip(rows, (i, label, len(part), part)):
                        rows[name].append(value)
            yield pa.RecordBatch.from_pydict({"id": pa.array(rows["id"], pa.int64()), "label": pa.array(rows["label"], pa.int32()),
                                              "n": pa.array(rows["n"], pa.int32()), "bytes": pa.array(rows["bytes"], pa.binary())})

    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(F.col(text_col)).cast("binary").alias("text"))
    # at most 2 * docs_per_label ids
    sample = (texts.join(F.broadcast(picked), "id").select("id", "label", "text")
              .mapInArrow(cut_chunks, "id long, label int, n int, bytes binary")
              .orderBy("id", "bytes").limit(2 * docs_per_label * chunks_per_doc).toArrow())
    label = sample.column("label").to_numpy().astype(np.float32)
    if len(label) == 0 or label.min() == label.max():
        return Model(np.zeros((1, 256, 1), np.float32), np.zeros(1), np.zeros(1), 0.0, (1.0, 0.0), chunk,
                     constant=float((label.sum() + 1) / (len(label) + 2)))
    chunks = np.zeros((len(label), size), np.uint8)
    for row, part in zip(chunks, sample.column("bytes").to_pylist()):
        row[:len(part)] = np.frombuffer(part, np.uint8)
    return train(chunks, sample.column("n").to_numpy(), sample.column("id").to_numpy(), label, chunk, width, **how)


# ---------------------------------------------------------------- scoring

def with_score(docs: DataFrame, text_col: str, model: Model, score_col: str) -> DataFrame:
    """docs with a double column score_col (in place of one of that name) from the whole text."""
    whole, (spare,) = F.col(f"`{text_col}`"), free_names(docs, "bytes")
    docs = docs.withColumn(spare, text_or_empty(whole).cast("binary"))
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != score_col.lower()))
    columns = docs.columns[:-1]
    schema = StructType([*docs.schema.fields[:-1], StructField(score_col, DoubleType())])

    def run(batches):
        for b in batches:
            scores = [model.score(t.as_py()) for t in b.column(len(columns))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], [*columns, score_col])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, text_col: str, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score at least threshold, with their columns as they are."""
    (score,) = free_names(docs, "score")
    return with_score(docs, text_col, model, score).filter(F.col(score) >= threshold).drop(score)
