"""Toxicity classifier with a counterfactual penalty.

A document is the set of its lower-case words and of their first letters. The features are those
that a screening of the training sample finds to differ between the classes, and those of identity
terms; a logistic regression on them is fitted by Newton steps. Each labelled text that mentions an
identity term is paired with copies in which the terms are swapped for others of their kind and for
neutral words. A text that mentions none is paired with copies that mention one more, each of all terms in
turn, so every term is in pairs whatever the corpus says. The squared change of the score over these pairs is
part of the loss: what a mention adds by itself costs, so neutral mentions of groups are not flagged.

The fit is on a bounded sample of labelled rows; scoring reads every text once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb
from demandloom.llm.labels import held_out, training_labels

#: Identity terms by kind; the first of each kind is the neutral word.
IDENTITY_TERMS = {
    "people": ("people", "women", "men", "girls", "boys", "gays", "lesbians", "immigrants", "refugees", "foreigners"),
    "person": ("person", "woman", "man", "girl", "boy", "immigrant", "refugee", "foreigner"),
    "faith": ("religious", "christian", "muslim", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    "origin": ("local", "african", "asian", "european", "american", "arab", "mexican", "chinese", "indian", "turkish"),
    "leute": ("leute", "frauen", "männer", "mädchen", "schwule", "lesben", "muslime", "juden", "christen", "ausländer", "flüchtlinge", "türken"),
    "gens": ("gens", "femmes", "hommes", "filles", "garçons", "homosexuels", "lesbiennes", "musulmans", "juifs", "chrétiens", "étrangers", "réfugiés", "arabes"),
    "gente": ("gente", "mujeres", "hombres", "niñas", "homosexuales", "lesbianas", "musulmanes", "judíos", "cristianos", "extranjeros", "refugiados", "gitanos"),
    "trait": ("other", "black", "white", "gay", "straight", "lesbian", "transgender", "disabled", "deaf", "blind", "old", "young"),
}

#: Lengths in bytes of the word beginnings that are features beside the whole word.
PREFIXES = (4, 5, 6)
_SALTS = tuple(np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x2127599BF4325C37))

_KIND = {term: kind for kind, terms in IDENTITY_TERMS.items() for term in terms}
_MENTION = re.compile(r"(?i)\b(" + "|".join(sorted(_KIND, key=len, reverse=True)) + r")\b")


def swapped(text: str, shift: int) -> str | None:
    """``text`` with each identity term replaced; None if it has none.

    Shift 0 puts the neutral word of the kind, other shifts the term so many places on.
    """

    def other(m: re.Match) -> str:
        terms = IDENTITY_TERMS[_KIND[m[0].lower()]]
        at = terms.index(m[0].lower())
        return terms[0] if shift == 0 else terms[(at + shift) % len(terms)]

    return _MENTION.sub(other, text) if _MENTION.search(text) else None


#: All terms but the neutral ones, as they are put into texts that have none.
TERMS = tuple(t for terms in IDENTITY_TERMS.values() for t in terms[1:])
#: Copies of a text without a mention, each with a term of its own.
MENTIONS = 2


def with_mentions(text: str, number: int) -> list[str]:
    """Copies of a text that say one identity term more, at a word boundary; ``number`` chooses terms and places."""
    words = text.split(" ")
    out = []
    for k in range(MENTIONS):
        place = (number * 7919 + k) % (len(words) + 1)
        term = TERMS[(number * MENTIONS + k) % len(TERMS)]
        out.append(" ".join([*words[:place], term, *words[place:]]))
    return out


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of each feature occurrence, repeats included."""
    words = tb.find_words(texts, tb.NOT_TERM)
    hasher = tb.Hasher(words.data, lower=True)
    docs, hashes = [words.doc], [hasher(words.starts, words.ends) ^ _SALTS[0]]
    for length, salt in zip(PREFIXES, _SALTS[1:]):
        long = words.ends - words.starts > length
        docs.append(words.doc[long])
        hashes.append(hasher(words.starts[long], words.starts[long] + length) ^ salt)
    return np.concatenate(docs), np.concatenate(hashes)


def _distinct(docs: np.ndarray, hashes: np.ndarray, n: int) -> list[np.ndarray]:
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    fresh = np.ones(len(docs), dtype=bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    docs, hashes = docs[fresh], hashes[fresh]
    return np.split(hashes, np.searchsorted(docs, np.arange(1, n)))


class Model(NamedTuple):
    """Sorted feature hashes with their weights, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability that each text is toxic."""
        margin = np.full(len(texts), self.bias)
        if len(self.keys):
            docs, hashes = features(texts)
            # few features have a weight: a table of their high bits rules out nearly all others
            near = np.zeros(1 << 16, dtype=bool)
            near[self.keys >> np.uint64(48)] = True
            maybe = np.flatnonzero(near[hashes >> np.uint64(48)])
            place = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
            hit = self.keys[place] == hashes[maybe]
            pairs = np.unique(docs[maybe][hit].astype(np.int64) * len(self.keys) + place[hit])
            np.add.at(margin, pairs // len(self.keys), self.weights[pairs % len(self.keys)])
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


SAMPLE = "pair long, label int, features array<long>, gone array<long>"


def sample_batch(ids: list[int], labels: list[int], texts: list[bytes]) -> pa.RecordBatch:
    """``SAMPLE`` rows of labelled texts and of their copies.

    A text has its label and its features. A copy has the label NULL, the features that it has and its original
    lacks, and those that are ``gone``.
    """
    of, copies = [], []
    for i, text in enumerate(texts):
        plain = text.decode("utf-8", "replace")
        own = [c for c in (swapped(plain, shift) for shift in (0, 1, 3)) if c is not None]
        for copy in own or with_mentions(plain, ids[i]):
            of.append(i)
            copies.append(copy.encode())
    found = _distinct(*features(texts + copies), len(texts) + len(copies))
    base, made = found[: len(texts)], found[len(texts) :]
    held = base + [np.setdiff1d(c, base[i], assume_unique=True) for i, c in zip(of, made)]
    gone = [np.zeros(0, np.uint64)] * len(texts) + [np.setdiff1d(base[i], c, assume_unique=True) for i, c in zip(of, made)]

    def lists(parts: list[np.ndarray]) -> pa.ListArray:
        sizes = np.cumsum([0] + [len(x) for x in parts])
        values = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int64()))

    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids + [ids[i] for i in of], pa.int64()),
            pa.array(labels + [None] * len(of), pa.int32()),
            lists(held),
            lists(gone),
        ],
        ["pair", "label", "features", "gone"],
    )


def training_sample(docs: DataFrame, labels: DataFrame, rows_per_class: tuple[int, int]) -> pa.Table:
    """``SAMPLE`` rows of a sample of labelled texts and their copies.

    At most ``rows_per_class`` labelled rows of class 0 and of class 1, the first by a hash of the
    id. Terms are dealt to texts without a mention by their ids.
    """
    ranked = labels.withColumn("__rank", F.xxhash64("doc_id"))
    chosen = None
    for value, most in enumerate(rows_per_class):
        part = ranked.filter(F.col("label") == value).orderBy("__rank", "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most sum(rows_per_class) ids: the bound of the sample is the bound of this broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in tb.slices(batches):
            yield sample_batch(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), texts)

    return rows.select("doc_id", "text", F.col("label").cast("int").alias("label")).mapInArrow(run, SAMPLE).toArrow()


def fit(
    sample: pa.Table,
    most_features: int = 800,
    least_z: float = 2.5,
    ridge: float = 0.0002,
    fairness: float = 1.0,
    steps: int = 12,
) -> Model:
    """Newton steps on log loss + ``ridge`` * |w|^2 + ``fairness`` * mean squared change over swaps.

    The features are the ``most_features`` with the largest z value of the difference in document
    frequency, ``least_z`` or more, and those of identity terms. With one class only, or no rows, the
    score is the smoothed share of class 1 everywhere.
    """
    order = np.argsort(sample.column("pair").to_numpy(), kind="stable")  # sums come in one order
    marks = np.array([-1 if x is None else x for x in sample.column("label").to_pylist()], dtype=int)
    known = marks >= 0
    counts = np.bincount(marks[known], minlength=2) if known.any() else np.zeros(2, int)
    if counts.min() == 0:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((counts[1] + 1) / (counts[0] + 1))))

    def lists(column: str) -> tuple[np.ndarray, np.ndarray]:
        """All features of a column, and the row of each."""
        held = sample.column(column).combine_chunks()
        sizes = np.diff(held.offsets.to_numpy())
        return held.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(marks), dtype=np.int32), sizes)

    every, rows_of = lists("features")
    gone, gone_of = lists("gone")
    labelled = known[rows_of]
    added, added_of = every[~labelled], rows_of[~labelled]
    flat, owner = every[labelled], rows_of[labelled]
    del every, rows_of, labelled
    values, inverse = np.unique(flat, return_inverse=True)
    of = marks[owner]
    df1 = np.bincount(inverse[of == 1], minlength=len(values))
    df0 = np.bincount(inverse[of == 0], minlength=len(values))
    p1, p0 = (df1 + 0.5) / (counts[1] + 1), (df0 + 0.5) / (counts[0] + 1)
    spread = np.sqrt(p1 * (1 - p1) / counts[1] + p0 * (1 - p0) / counts[0])
    z = np.abs(p1 - p0) / spread
    best = np.argsort(-z, kind="stable")[:most_features]
    # Neutral words get no weight of their own: they are what mentions are pulled towards.
    _, own = features([t.encode() for t in TERMS])
    keys = np.union1d(values[best[z[best] >= least_z]], own[np.isin(own, added) | np.isin(own, values)])
    if not len(keys):
        return Model(keys, np.zeros(0), float(np.log((counts[1] + 1) / (counts[0] + 1))))

    def fill(chosen: np.ndarray, hashes: np.ndarray, of: np.ndarray, sign: float, out: np.ndarray) -> None:
        """Set the features of the chosen rows of the sample in the rows of ``out``."""
        number = np.full(len(marks), -1)
        number[chosen] = np.arange(len(chosen))
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = (keys[place] == hashes) & (number[of] >= 0)
        out[number[of[hit]], place[hit]] = sign

    originals, copies = order[known[order]], order[~known[order]]
    rows = np.zeros((len(originals), len(keys) + 1), dtype=np.float32)
    rows[:, -1] = 1
    fill(originals, flat, owner, 1, rows)
    y = marks[originals].astype(float)
    gram = np.zeros((len(keys) + 1, len(keys) + 1))
    for a in range(0, len(copies), 2048):  # what the copies changed
        part = copies[a : a + 2048]
        delta = np.zeros((len(part), len(keys) + 1), dtype=np.float32)
        fill(part, added, added_of, 1, delta)
        fill(part, gone, gone_of, -1, delta)
        gram += (delta.T @ delta).astype(float) / len(copies)
    penalty = ridge * np.eye(len(keys) + 1) + fairness * gram
    penalty[-1, -1] = 1e-6
    w = np.zeros(len(keys) + 1)
    w[-1] = np.log(counts[1] / counts[0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-4)
        gradient = rows.T @ (p - y) / len(y) + penalty @ w
        hessian = ((rows * curve[:, None].astype(np.float32)).T @ rows).astype(float) / len(y) + penalty
        w -= np.linalg.solve(hessian + 1e-8 * np.eye(len(w)), gradient)
    return Model(keys, w[:-1], float(w[-1]))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of each row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            scores = pa.array(shipped.value.score(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), scores], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 5,
    fold: int = 0,
    threshold: float = 0.5,
    rows_per_class: tuple[int, int] = (6000, 3000),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``.

    Learns from at most ``rows_per_class`` labelled rows of class 0 and of class 1 outside the held-out
    fold. NULL texts are scored as empty ones, which have the bias alone. Rows that repeat an id are
    scored one by one; a NULL id is scored and not held out. Extra columns are ignored; an empty
    table gives no rows; without labels the score is one half.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(training_sample(own, training_labels(labels, label, folds, fold), rows_per_class))
    return score_documents(own, model).select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
