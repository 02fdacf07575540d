"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

A document becomes a short vector of transformed statistics of its whole text. Each class is a
normal distribution whose covariance is shrunk towards the pooled one and then towards its own
mean variance. A score is the posterior from the difference of the Mahalanobis log densities, with
the Cholesky factors of both classes computed once and shipped to the tasks.

Fitting needs counts, sums and products of the vectors per class, which Spark adds up over every labelled
row: what reaches the driver has the same size for any corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb
from demandloom.llm.labels import held_out, training_labels
from demandloom.llm.scratch import Scratch

_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:'\"?-()"]] = True
_SYMBOL = ~(_LETTER | _DIGIT | _STOP | tb.SPACES)

#: What the vector holds, in order.
STATISTICS = (
    "log_words",
    "log_bytes_per_word",
    "upper_share",
    "symbol_share",
    "symbol_word_share",
    "digit_share",
    "stop_share",
    "newline_rate",
    "repeat_share",
    "distinct_share",
    "long_line_share",
    "worst_upper",
    "worst_symbol",
    "worst_repeat",
)


def _logit(part: np.ndarray, whole: np.ndarray, prior: float) -> np.ndarray:
    """Log-odds of a share, smoothed by one observation of the usual share."""
    return np.log((part + prior) / (np.maximum(whole - part, 0) + 1 - prior))


def statistics(texts: list[bytes], block_words: int = 40) -> np.ndarray:
    """One vector a text, ``len(STATISTICS)`` wide. An empty text has the vector of zero counts.

    The last three look at the worst block of ``block_words`` words, so that a long document with
    a broken part does not hide it.
    """
    words = tb.find_words(texts)
    n = len(texts)
    bounds = words.offsets
    size = np.diff(bounds).astype(float) - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (total[bounds[1:] - 1] - total[bounds[:-1]]).astype(float)

    data = words.data
    is_upper, is_symbol = _UPPER[data], _SYMBOL[data]
    letters, upper, symbols = per_text(_LETTER[data]), per_text(is_upper), per_text(is_symbol)
    digits, stops, lines = per_text(_DIGIT[data]), per_text(_STOP[data]), per_text(data == 10)
    count = words.counts.astype(float)

    hashes = tb.Hasher(data)(words.starts, words.ends)
    repeated = np.zeros(len(hashes), dtype=bool)
    repeated[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    ends_symbol = is_symbol[words.ends - 1] if len(hashes) else np.zeros(0, dtype=bool)
    long_upper = is_upper[words.starts] & is_upper[np.minimum(words.starts + 1, words.ends - 1)] & (words.ends - words.starts > 1) if len(hashes) else np.zeros(0, dtype=bool)
    tally = lambda flags: np.bincount(words.doc[flags], minlength=n).astype(float)
    order = np.lexsort((hashes, words.doc))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    distinct = np.bincount(words.doc[order][fresh], minlength=n).astype(float)

    first = np.cumsum(words.counts) - words.counts
    place = np.arange(len(hashes)) - first[words.doc]
    blocks_of = (words.counts + block_words - 1) // block_words
    block_start = np.cumsum(blocks_of) - blocks_of
    block = block_start[words.doc] + place // block_words
    total_blocks = int(blocks_of.sum())
    filled = np.bincount(block, minlength=total_blocks).astype(float)
    owner = np.repeat(np.arange(n), blocks_of)

    def worst(flags: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        np.maximum.at(out, owner, np.bincount(block[flags], minlength=total_blocks) / (filled + 4))
        return out

    # a line of a table or list has many separators: words that are a symbol alone
    alone = ends_symbol & (words.ends - words.starts == 1)
    return np.column_stack(
        [
            np.log1p(count),
            np.log((size + 6) / (count + 1)),
            _logit(upper, letters, 0.03),
            _logit(symbols, size, 0.002),
            _logit(tally(ends_symbol), count, 0.01),
            _logit(digits, size, 0.005),
            _logit(stops, size, 0.02),
            _logit(lines, count, 0.01),
            _logit(tally(repeated), count, 0.01),
            np.log((distinct + 1) / np.sqrt(count + 1)),
            _logit(tally(alone), count, 0.005),
            np.sqrt(worst(long_upper)),
            np.sqrt(worst(ends_symbol)),
            np.sqrt(worst(repeated)),
        ]
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the vector ``x`` of each row of ``docs``; the only pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            x = statistics(texts)
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), vectors], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<double>")


class Model(NamedTuple):
    """Means, Cholesky factors of the covariances and log priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    log_priors: np.ndarray
    temperature: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        density = []
        for mean, factor, prior in zip(self.means, self.factors, self.log_priors):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(prior - 0.5 * (z * z).sum(axis=0) - np.log(np.diag(factor)).sum())
        gap = np.clip((density[1] - density[0]) / self.temperature, -50, 50)
        return 1 / (1 + np.exp(-gap))


def fit(labelled: DataFrame, shrink_pooled: float = 0.2, shrink_identity: float = 0.05, temperature: float = 4.0) -> Model:
    """Model from rows of ``(label, x)``.

    ``shrink_pooled`` moves each covariance towards the pooled one, ``shrink_identity`` towards a
    multiple of the identity. ``temperature`` divides the log-odds: statistics of one text are
    not independent, so the plain posterior is too sure of itself. A class without rows gets the
    pooled mean and covariance; with no rows at all the score is the prior, one half.
    """
    d = len(STATISTICS)
    moments = (
        labelled.select("label", F.posexplode(_products("x")).alias("i", "v"))
        .groupBy("label", "i")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    table = np.zeros((2, 1 + d + d * d))
    for r in moments:
        table[r["label"], r["i"]] = r["v"]
    counts, sums, squares = table[:, 0], table[:, 1 : 1 + d], table[:, 1 + d :].reshape(2, d, d)
    total = max(counts.sum(), 1.0)
    overall = sums.sum(axis=0) / total
    means = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], overall)
    scatter = squares - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / total
    factors = []
    for k in (0, 1):
        own = scatter[k] / counts[k] if counts[k] > 1 else pooled
        cov = (1 - shrink_pooled) * own + shrink_pooled * pooled
        scale = np.trace(cov) / d
        cov = (1 - shrink_identity) * cov + (shrink_identity * scale + 1e-6) * np.eye(d)
        factors.append(np.linalg.cholesky((cov + cov.T) / 2))
    priors = np.log((counts + 1) / (counts.sum() + 2))
    return Model(means, np.array(factors), priors, temperature)


def _products(x: str):
    """1, the vector, and all products of two entries, as one array."""
    products = F.flatten(F.transform(F.col(x), lambda a: F.transform(F.col(x), lambda b: a * b)))
    return F.concat(F.array(F.lit(1.0)), F.col(x), products)


def score_statistics(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of each vector."""
    shipped = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                scores = pa.array(shipped.value.score(x))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 4,
    fold: int = 2,
    threshold: float = 0.7,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``.

    Only labels outside the held-out fold are learnt from. NULL texts are scored as empty ones. Rows
    that repeat an id are scored one by one, and all count if their id is labelled. Rows with a NULL
    id are scored and are not held out. Extra columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.keep("statistics", document_statistics(docs))
    model = fit(stats.join(training_labels(labels, label, folds, fold), "doc_id"))
    return score_statistics(stats, model).select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
