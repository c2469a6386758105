"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words and character n-grams; a softmax layer gives the class.
Vectors and layer are trained together by stochastic gradient descent in numpy on a bounded sample of labelled rows.
Scoring reads whole texts.  As the softmax of an average is linear in the vectors, each bucket's two logits are
multiplied out once, so scoring gathers two numbers for each feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .sampling import bounded_sample, split_of
from .storage import collected, release

#: Production parameters.  ``per_label`` bounds the training sample: at most about that many rows of either label.
BUCKETS, DIM, NGRAMS, PER_LABEL, EPOCHS, RATE, SEED = 1 << 16, 12, (2, 3), 3000, 4, 1.0, 11
#: Zero vectors that join every average, so that a text of a few words stays near the prior.
SHRINK = 64
STEP = 50
THRESHOLD = 0.7


def features(part: pa.RecordBatch, column: str, hasher: tx.Hasher, ngrams: tuple[int, ...], buckets: int):
    """(row, bucket) of all words and character n-grams of whole texts; n-grams may span words.  A word that repeats the one
    before it also counts in bucket 0, as the word pair "same again", whatever the word is."""
    col = part.column(part.schema.get_field_index(column))
    data, bounds = tx.raw(col)
    starts, ends, first = tx.word_bounds(data, bounds)
    words, row = hasher.segments(data, starts, ends), tx.rows_of(first)
    again = np.flatnonzero((words[1:] == words[:-1]) & (row[1:] == row[:-1])) + 1
    rows, ids = [row, row[again]], [(words & tx.U(buckets - 1)).astype(np.int64), np.zeros(len(again), np.int64)]
    points, at = tx.code_points([t or "" for t in col.to_pylist()])
    for n in ngrams:
        r, b = tx.ngram_buckets(points, at, n, buckets)
        rows.append(r)
        ids.append(b)
    return np.concatenate(rows), np.concatenate(ids)


def bags(docs: DataFrame, text_col: str, keep: list[str], ngrams: tuple[int, ...] = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """The kept columns and each row's distinct buckets with their counts."""
    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        for batch in batches:
            for part in tx.slices(batch, "__text"):
                row, ids = features(part, "__text", hasher, ngrams, buckets)
                key, n = np.unique(row * buckets + ids, return_counts=True)
                bounds = np.searchsorted(key // buckets, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (key % buckets, n)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *lists], [*keep, "bucket", "n"])

    src = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in src.dtypes[:-1])
    return src.mapInArrow(run, f"{kinds}, bucket array<int>, n array<int>")


@dataclass
class Model:
    logits: np.ndarray        # (buckets, 2): each bucket's share of the two logits
    bias: np.ndarray
    ngrams: tuple[int, ...]
    buckets: int


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], shares: tuple[float, float] = (0.5, 0.5), buckets: int = BUCKETS, dim: int = DIM, ngrams=NGRAMS,
        epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Train on (buckets, counts, label) rows.  ``shares`` are the labels' shares among all labelled rows; the bias is moved
    from the sample's to them.  Without samples of both labels the model is that prior alone."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    layer = rng.normal(0, 0.1, (dim, 2)).astype(np.float32)
    seen = np.bincount([s[2] for s in samples], minlength=2) if samples else np.zeros(2)
    bias = np.log((seen + 0.5) / (seen.sum() + 1)).astype(np.float32)
    total = max(1, epochs * len(samples))
    step = 0
    for _ in range(epochs if seen.min() else 0):
        for i in rng.permutation(len(samples)):
            ids, n, label = samples[i]
            lr = np.float32(rate * (1 - step / total))
            step += 1
            if not len(ids):
                continue
            share = (n / (n.sum() + SHRINK)).astype(np.float32)
            vec = table[ids]
            hidden = share @ vec
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= lr * 0.1 * np.outer(hidden, p)
            bias -= lr * 0.01 * p
            # shares are tiny in long texts, so steps grow with the text's number of distinct features, up to a bound
            table[ids] -= (lr * min(len(ids), STEP)) * share[:, None] * back
    bias = bias - np.log((seen + 0.5) / (seen.sum() + 1)) + np.log(np.clip(shares, 1e-3, 1))
    return Model(table @ layer if step else np.zeros((buckets, 2), np.float32), bias, ngrams, buckets)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``out_col``.  Null and empty texts score by the bias."""
    spark = docs.sparkSession
    margin = (model.logits[:, 1] - model.logits[:, 0]).astype(np.float32)
    shared = spark.sparkContext.broadcast((margin, float(model.bias[1] - model.bias[0]), model.ngrams, model.buckets))
    cols = docs.columns
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes] + [f"`{out_col}` double"])

    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin, bias, ngrams, buckets = shared.value
        hasher = tx.Hasher()
        for batch in batches:
            for part in tx.slices(batch, text_col):
                row, ids = features(part, text_col, hasher, ngrams, buckets)
                size = np.bincount(row, minlength=part.num_rows)
                z = np.bincount(row, weights=margin[ids], minlength=part.num_rows) / (size + SHRINK)
                p = 1 / (1 + np.exp(-np.clip(z + bias, -50, 50)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64())], [*cols, out_col])

    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          per_label: int = PER_LABEL, seed: int = SEED) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out quarter.  Rows with a null id, text or label,
    or a label other than 0 and 1, teach nothing; an id that is labelled twice with different labels neither.  Where ids repeat in ``docs``,
    every row of a labelled id is a row to learn from; of so many that the bound is passed, a sample by id and text is."""
    known = (labels.where(f"{label_col} IN (0, 1) AND {id_col} IS NOT NULL").groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("hi"))
             .where("label = hi").where(split_of("id") != 2).select("id", "label"))
    # The sample is drawn from labels alone, so that texts of other rows never move.
    chosen = bounded_sample(known, ["id"], "label", per_label, seed)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    taught = rows.join(F.broadcast(chosen), "id")
    # An id may stand in many rows: then these are sampled too, by id and text.
    if taught.select("id").count() > 2 * per_label * 2:
        taught = bounded_sample(taught, ["id", "text"], "label", per_label, seed)
    got = collected(bags(taught, "text", ["id", "label"]), "bags")
    order = np.lexsort((np.arange(got.num_rows), got.column("id").to_numpy()))
    taught = [(bucket.values.to_numpy(), n.values.to_numpy(), label.as_py()) for bucket, n, label in zip(*map(got.column, ("bucket", "n", "label")))]
    samples = [taught[i] for i in order]
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(n.values()) or 1
    model = fit(samples, (n.get(0, total / 2) / total, n.get(1, total / 2) / total))
    del got, taught, samples
    release()
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 where the score is ``threshold`` or more).  Columns of ``docs`` by these
    names are replaced; an empty table gives an empty result."""
    model = train(docs, labels, id_col, text_col, label_col)
    plain = docs.drop("score", "predicted").withColumn(text_col, F.col(text_col).cast("string"))
    return score(plain, model, text_col).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
