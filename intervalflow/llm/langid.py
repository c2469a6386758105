"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams of lower-cased whole texts, in which every run of other characters than letters is one
space; a text's weights are its n-gram shares times the inverse document frequency.  Document frequencies are counted over all
learnable rows.  The weights are learned by follow-the-regularised-leader with elastic-net penalties (per-coordinate steps, so
rare n-grams stay at zero) on a bounded sample, and a temperature fitted on a part of the sample that training does not see
calibrates the probabilities.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .sampling import bounded_sample, split_of
from .storage import collected, release

#: Production parameters.  ``per_label`` bounds the training sample: about that many rows of each language.
BUCKETS, NGRAMS, PER_LABEL, EPOCHS, SEED = 1 << 15, (1, 2, 3), 1500, 3, 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
SCALE = 20.0            # n-gram shares are small; the penalties are for inputs near one
UND = "und"
_LETTER = regex.compile(r"\p{L}")


def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters or marks."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x10000)])


def ngrams(texts: list[str], table: np.ndarray, sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all n-grams, row by row within each size.  Every row starts with one space, and ends with one."""
    points, bounds = tx.code_points([" " + t.lower() + " " for t in texts])
    other = ~table[np.minimum(points, 0xFFFF)] & (points < 0x10000)
    points = np.where(other, np.uint32(32), points)
    keep = np.ones(len(points), bool)
    keep[1:] = ~(other[1:] & other[:-1])
    keep[bounds[:-1]] = True
    points, bounds = points[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]
    parts = [tx.ngram_buckets(points, bounds, n, buckets) for n in sizes]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def document_frequencies(docs: DataFrame, text_col: str, sizes=NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """In how many rows each bucket occurs, over all rows, and the number of rows; each task sends one row per bucket it saw."""
    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, df, rows = _letters(), np.zeros(buckets, np.int64), 0
        for batch in batches:
            for part in tx.slices(batch, "text"):
                rows += part.num_rows
                row, ids = ngrams([t or "" for t in part.column(0).to_pylist()], table, sizes, buckets)
                seen = np.zeros((part.num_rows, buckets), bool) if part.num_rows * buckets <= 1 << 26 else None
                if seen is not None:
                    seen.ravel()[row * buckets + ids] = True
                    df += seen.sum(axis=0)
                else:
                    df += np.bincount(np.unique(row * buckets + ids) % buckets, minlength=buckets)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, buckets)), pa.array(np.append(df[at], rows))], ["bucket", "n"])

    sums = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())          # buckets + 1 rows at most
    out = np.zeros(buckets + 1, np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out[:buckets], int(out[buckets])


def _bags(docs: DataFrame, keep: list[str], sizes, buckets: int) -> DataFrame:
    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letters()
        for batch in batches:
            for part in tx.slices(batch, "text"):
                row, ids = ngrams(part.column(len(keep)).to_pylist(), table, sizes, buckets)
                key, n = np.unique(row * buckets + ids, return_counts=True)
                bounds = np.searchsorted(key // buckets, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (key % buckets, n)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *lists], [*keep, "bucket", "n"])

    kinds = ", ".join(f"{c} {t}" for c, t in docs.select(*keep).dtypes)
    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, bucket array<int>, n array<int>")


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, buckets: int, epochs: int = EPOCHS, seed: int = SEED,
             alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights (buckets + 1, classes), the last row the bias, of (buckets, values, class) rows."""
    z, n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))
    rng = np.random.default_rng(seed)

    def weights(at) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, label = rows[i]
            at, x = np.append(at, buckets), np.append(x, 1.0)
            w = weights(at)
            p = x @ w
            p = np.exp(p - p.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    if not len(label):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(label)), label]).mean())

    lo, hi, ratio = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_label: int = PER_LABEL, sizes=NGRAMS, buckets: int = BUCKETS) -> tuple:
    """``(languages, weights with the idf multiplied in, bias, temperature, sizes, buckets)``, learned from rows outside the
    held-out quarter with a language and a text.  A fifth of the sample fits the temperature.  Without such rows there are no languages.  Rows that repeat an
    id, or have none, are rows like others: the sample is drawn by id and text, and a row that is repeated as a whole teaches once."""
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).where(split_of(id_col) != 2)
            .select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))
    df, n_rows = document_frequencies(rows, "text", sizes, buckets)
    idf = np.log((1 + n_rows) / (1 + df)) + 1
    got = collected(_bags(bounded_sample(rows, ["id", "text"], "lang", per_label, SEED), ["id", "lang"], sizes, buckets), "bags")
    langs = sorted(set(got.column("lang").to_pylist()))
    index = {lang: i for i, lang in enumerate(langs)}
    order = np.lexsort((got.column("lang").to_numpy(zero_copy_only=False), got.column("id").to_numpy())) if got.num_rows else []
    lang, bucket, n = (got.column(c).combine_chunks() for c in ("lang", "bucket", "n"))

    def row(i: int) -> tuple[np.ndarray, np.ndarray, int]:
        at, k = bucket[i].values.to_numpy(), n[i].values.to_numpy()
        return at, SCALE * k / k.sum() * idf[at], index[lang[i].as_py()]

    data = [row(int(i)) for i in order]
    fitted = [d for i, d in enumerate(data) if i % 5]
    held = [d for i, d in enumerate(data) if not i % 5]
    w = fit_ftrl(fitted, max(1, len(langs)), buckets)
    logits = np.array([x @ w[at] + w[buckets] for at, x, _ in held]).reshape(len(held), w.shape[1])
    temperature = fit_temperature(logits, np.array([c for *_, c in held], int))
    del got, lang, bucket, n, data, fitted, held
    release()
    return langs, (SCALE * idf[:, None] * w[:buckets]).astype(np.float32), w[buckets], temperature, sizes, buckets


def predict(docs: DataFrame, model: tuple, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the calibrated probability of that language).  Null texts and texts without a letter
    are ``und`` with score 0; so is everything if nothing was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.drop("lang_pred", "score").withColumn(text_col, F.col(text_col).cast("string"))
    cols = src.columns
    schema = ", ".join([f"`{c}` {t}" for c, t in src.dtypes] + ["lang_pred string", "score double"])

    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weights, bias, temperature, sizes, buckets = shared.value
        table = _letters()
        for batch in batches:
            for part in tx.slices(batch, text_col):
                texts = [t or "" for t in part.column(cols.index(text_col)).to_pylist()]
                known = np.array([bool(langs) and _LETTER.search(t) is not None for t in texts], bool)
                row, ids = ngrams(texts, table, sizes, buckets)
                total = np.maximum(np.bincount(row, minlength=len(texts)), 1)
                z = np.stack([np.bincount(row, weights=weights[:, c][ids], minlength=len(texts)) / total
                              for c in range(weights.shape[1])], axis=1) + bias
                z = z / temperature
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                name = [langs[b] if k else UND for b, k in zip(best, known)]
                score = np.where(known, p[np.arange(len(best)), best], 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(name, pa.string()), pa.array(score)],
                                                 [*cols, "lang_pred", "score"])

    return src.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows of ``docs`` that have a language and predict every row."""
    return predict(docs, train(docs, id_col, text_col, lang_col), text_col)
