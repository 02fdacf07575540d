"""Language identification with interpolated Kneser-Ney character models.

A text is read as letters in lower case with single blanks between runs of them. Spark counts its
n-grams by language and derives from them the continuation counts, discounts and the weights with
which a longer context hands over to a shorter one. The models are kept as arrays sorted by the hash of an
n-gram, one column a language, and looked up by binary search. A document gets the language with the
lowest cross-entropy a letter.

One fold of the training documents is left out of the counts. It tells how sharply cross-entropies are
to be turned into probabilities, and how high the cross-entropy of a language gets on its own
texts: what lies far above is marked as rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb
from demandloom.llm.labels import held_out
from demandloom.llm.scratch import Scratch

#: Letters of an n-gram; n-grams are packed into 60 bits.
ORDER = 4
#: N-grams that all models together hold at most; see ``keep_share``.
MODEL_ENTRIES = 1 << 22
#: N-grams of one language that a task holds before it hands them on.
TASK_GRAMS = 1 << 20
#: Steps of the sharpness that calibration chooses from.
SHARPNESS = tuple(2.0 ** (i / 2) for i in range(-4, 17))
#: Standard deviations above its own texts from which a language is rejected.
REJECT_AT = 6.0

UNKNOWN = "und"


_LETTERS: dict[int, np.ndarray] = {}


def letter_codes(bits: int) -> np.ndarray:
    """For each code point 0 if it is no letter, else a number of ``bits`` bits: its lower case, folded."""
    if bits not in _LETTERS:
        out = np.zeros(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                out[i] = ord(low[0]) if low[0].isalpha() else i
        wide = out >= (1 << bits)
        out[wide] = 1 + tb.mix(out[wide].astype(np.uint64)) % np.uint64((1 << bits) - 1)
        _LETTERS[bits] = out.astype(np.int64)
    return _LETTERS[bits]


class Grams(NamedTuple):
    """Packed n-grams of some texts in order, the text of each, and each text's number of letters."""

    packed: np.ndarray
    doc: np.ndarray
    letters: np.ndarray


def read_grams(texts: list[bytes], order: int = ORDER) -> Grams:
    """One n-gram for each letter and for the blank behind each run of letters, with what comes before it.

    A text starts as behind a blank.
    """
    bits = 60 // order
    strings = [x.decode("utf-8", "replace") for x in texts]
    points = np.frombuffer("".join(x + "\0" for x in strings).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code = letter_codes(bits)[points]
    doc = np.repeat(np.arange(len(texts)), np.fromiter((len(x) + 1 for x in strings), dtype=np.int64, count=len(texts)))
    letters = np.bincount(doc[code > 0], minlength=len(texts))
    # of what is no letter only the first after a letter stays, and never at the start of a text
    keep = code > 0
    keep[1:] |= (code[:-1] > 0) & (doc[1:] == doc[:-1])
    code, doc = code[keep], doc[keep]
    sizes = np.bincount(doc, minlength=len(texts))
    place = np.arange(len(code)) - (np.cumsum(sizes) - sizes)[doc]
    packed = code.copy()
    for back in range(1, order):
        earlier = np.zeros(len(code), dtype=np.int64)
        earlier[back:] = code[:-back]
        earlier[place < back] = 0
        packed |= earlier << (bits * back)
    return Grams(packed, doc, letters)


def training_documents(docs: DataFrame, folds: int, fold: int, calibration: int) -> DataFrame:
    """``lang, text, calibrate`` of the rows that may be learnt from."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", folds, fold)).select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        held_out("doc_id", folds, calibration).alias("calibrate"),
    )


def count_grams(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, gram, n``: occurrences of each n-gram in all texts of a language.

    A task adds up what it reads and hands on at most ``TASK_GRAMS`` n-grams of a language at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows(lang: str) -> pa.RecordBatch:
            gram, n = held.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])

        for part, texts in tb.slices(batches):
            langs = part.column("lang").to_pylist()
            read = read_grams(texts, order)
            kinds = sorted(set(langs))
            place = {lang: i for i, lang in enumerate(kinds)}
            of = np.array([place[x] for x in langs])[read.doc] if len(read.doc) else np.zeros(0, dtype=np.int64)
            for i, lang in enumerate(kinds):
                gram, n = np.unique(read.packed[of == i], return_counts=True)
                if lang in held:
                    gram = np.concatenate((held[lang][0], gram))
                    gram, at = np.unique(gram, return_inverse=True)
                    n = np.bincount(at, np.concatenate((held[lang][1], n)), len(gram)).astype(np.int64)
                held[lang] = (gram, n)
                if len(gram) > TASK_GRAMS or len(held) > 256:
                    yield rows(lang)
        for lang in list(held):
            yield rows(lang)

    found = labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def keep_share(total: Column, languages: int, order: int) -> Column:
    """Least count of an n-gram that is kept.

    No more n-grams than one divided by a share can have that share of all occurrences, so all languages
    and lengths together keep at most ``MODEL_ENTRIES``, whatever the corpus holds.
    """
    return total * languages * order / MODEL_ENTRIES


def kneser_ney(counts: DataFrame, scratch: Scratch, languages: int, order: int = ORDER) -> DataFrame:
    """``lang, size, gram, p, weight`` for n-grams of 1 to ``order`` letters.

    ``p`` is the discounted share of the n-gram after its context, ``weight`` what the n-gram as a
    context hands over to shorter ones: one less its shares that are kept. Counts of the longest n-grams are
    occurrences, of shorter ones the number of different letters before them.
    """
    bits = 60 // order
    level, out = counts, []
    for size in range(order, 0, -1):
        level = scratch.keep(f"count-{size}", level)
        marks = level.groupBy("lang").agg(
            F.sum("n").alias("all"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")
        )
        discount = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))
        context = F.shiftright("gram", bits)
        totals = level.groupBy("lang", context.alias("context")).agg(F.sum("n").alias("total"))
        kept = (
            level.join(F.broadcast(marks) if languages < 10_000 else marks, "lang")
            .filter(F.col("n") >= keep_share(F.col("all"), languages, order))
            .select("lang", "gram", context.alias("context"), (F.col("n") - discount).alias("rest"))
            .join(totals, ["lang", "context"])
            .select("lang", F.lit(size).alias("size"), "gram", "context", (F.col("rest") / F.col("total")).alias("p"))
        )
        out.append(scratch.keep(f"share-{size}", kept))
        if size > 1:
            shorter = F.col("gram").bitwiseAND((1 << (bits * (size - 1))) - 1)
            level = level.groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n"))
    shares = out[0]
    for more in out[1:]:
        shares = shares.unionByName(more)
    handed = shares.groupBy("lang", "size", F.col("context").alias("gram")).agg((1 - F.sum("p")).alias("weight"))
    # what is known of an n-gram as a whole and as a context comes together at its hash
    return shares.select("lang", "size", "gram", "p", F.lit(None).cast("double").alias("weight")).unionByName(
        handed.select("lang", "size", "gram", F.lit(None).cast("double").alias("p"), "weight")
    )


class Level(NamedTuple):
    """N-grams of one length: sorted hashes, and a column a language of shares or weights."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, grams: np.ndarray, missing: float) -> np.ndarray:
        out = np.full((len(grams), self.values.shape[1]), missing, dtype=np.float32)
        if len(self.keys):
            keys = tb.mix(grams.astype(np.uint64))
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.values[at[hit]]
        return out


class Models(NamedTuple):
    """Models of all languages; ``shares`` and ``weights`` from one letter upwards."""

    languages: list[str]
    order: int
    letters: int
    shares: list[Level]
    weights: list[Level]

    def surprise(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each n-gram's last letter after the others, one column a language."""
        bits = 60 // self.order
        p = np.full((len(grams), len(self.languages)), 1.0 / self.letters, dtype=np.float32)
        for size in range(1, self.order + 1):
            own = grams & ((1 << (bits * size)) - 1)
            p = self.shares[size - 1].find(own, 0.0) + self.weights[size - 1].find(own >> bits, 1.0) * p
        return -np.log2(np.maximum(p, 1e-12))


def collect_models(rows: DataFrame, languages: list[str], order: int = ORDER) -> Models:
    """Fetch at most ``MODEL_ENTRIES`` n-grams, and no more contexts, as sorted arrays."""
    table = rows.join(
        F.broadcast(rows.sparkSession.createDataFrame(list(enumerate(languages)), "column int, lang string")), "lang"
    ).select("column", "size", "gram", "p", "weight").toArrow()
    column, size, gram = (table.column(c).to_numpy() for c in ("column", "size", "gram"))
    shares, weights = [], []
    for k in range(1, order + 1):
        for name, levels, missing in (("p", shares, 0.0), ("weight", weights, 1.0)):
            value = table.column(name).to_numpy()
            own = (size == k) & ~np.isnan(value)
            keys, at = np.unique(tb.mix(gram[own].astype(np.uint64)), return_inverse=True)
            values = np.full((len(keys), len(languages)), missing, dtype=np.float32)
            values[at, column[own]] = value[own]
            levels.append(Level(keys, values))
    letters = max(len(shares[0].keys), 1) + 1
    return Models(languages, order, letters, shares, weights)


def measure(docs: DataFrame, models: Models, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``letters``, the count of letters, and ``bits``, the cross-entropy a language.

    ``bits`` is a mean over letters and the blanks behind words, NULL for a text without a letter.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(models)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in keep], "letters long", "bits array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shipped.value
        width = len(models.languages)
        for rows, texts in tb.slices(batches):
            read = read_grams(texts, models.order)
            grams, at = np.unique(read.packed, return_inverse=True)
            surprise = models.surprise(grams)
            size = np.bincount(read.doc, minlength=len(texts))
            total = np.column_stack([np.bincount(read.doc, surprise[at, k], len(texts)) for k in range(width)])
            mean = total / np.maximum(size, 1)[:, None]
            lists = [m if n else None for m, n in zip(mean.tolist(), read.letters)]
            columns = [rows.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(read.letters.astype(np.int64)), pa.array(lists, pa.list_(pa.float64()))], [*keep, "letters", "bits"]
            )

    return docs.select(*keep, "text").mapInArrow(run, schema)


class Calibration(NamedTuple):
    """Sharpness of the probabilities, and per language and band of length the highest usual cross-entropy."""

    sharpness: float
    limits: dict[tuple[int, int], float]


def _band(letters: Column) -> Column:
    """Length in powers of four, 0 to 12."""
    return F.least(F.floor(F.log2(F.greatest(letters, F.lit(1)).cast("double")) / 2), F.lit(12)).cast("int")


def posterior(bits: Column, sharpness: float) -> Column:
    """Probability of the language with the lowest cross-entropy."""
    lowest = F.array_min(bits)
    return 1 / F.aggregate(bits, F.lit(0.0), lambda total, b: total + F.exp(-sharpness * (b - lowest)))


def calibrate(measured: DataFrame, languages: list[str]) -> Calibration:
    """From documents with their true language, ``lang, letters, bits``, that the models did not read.

    The sharpness is the one with the highest likelihood. Limits are means plus ``REJECT_AT`` standard
    deviations of the cross-entropy under the true language. Some totals a language reach the driver.
    """
    names = F.array(*[F.lit(x) for x in languages])
    known = measured.filter(F.col("bits").isNotNull()).withColumn("true", F.array_position(names, F.col("lang")).cast("int")).filter(F.col("true") > 0)
    own = F.element_at("bits", F.col("true"))
    chances = [
        F.sum(-F.log(F.aggregate("bits", F.lit(0.0), lambda total, b: total + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -s * (b - own))))))).alias(f"s{i}")
        for i, s in enumerate(SHARPNESS)
    ]
    likelihood = known.agg(*chances).first()
    best = max(range(len(SHARPNESS)), key=lambda i: likelihood[i] if likelihood[i] is not None else -math.inf)
    rows = known.groupBy((F.col("true") - 1).alias("column"), _band(F.col("letters")).alias("band")).agg(
        F.avg(own).alias("mean"), F.stddev_pop(own).alias("spread"), F.count("*").alias("n")
    ).collect()
    limits = {(r["column"], r["band"]): r["mean"] + REJECT_AT * max(r["spread"], 0.05) for r in rows if r["n"] >= 8}
    return Calibration(SHARPNESS[best] if rows else 1.0, limits)


def identify(
    docs: DataFrame, folds: int = 5, fold: int = 0, calibration: int = 1, order: int = ORDER
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected, letters`` of each row of ``docs``.

    Learns from texts with a language outside the held-out fold; fold ``calibration`` of them sets the
    probabilities and limits, the others are counted. ``score`` is the probability of ``lang_pred``. ``rejected`` marks
    a text whose cross-entropy is far above that of its language's own texts of such length, and any text
    without a letter. A NULL text, or one without a letter, is ``und`` with score 0; so is every text if no
    language was learnt. Ties go to the first language in code point order. Repeated rows are judged one by one
    and all count in training; a NULL id is in no fold. Texts are read whole, in slices of rows; a long text needs
    about a hundred bytes of memory a letter. Extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "languages")
    labelled = training_documents(docs, folds, fold, calibration)
    counts = scratch.keep("grams", count_grams(labelled.filter("NOT calibrate"), order))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", folds, fold).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    if not languages:
        return rows.select(
            "doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"), F.lit(0).cast("long").alias("letters")
        )
    models = collect_models(kneser_ney(counts, scratch, len(languages), order), languages, order)
    known = scratch.keep("calibration", measure(labelled.filter("calibrate"), models, ["lang"]))
    level = calibrate(known, languages)
    measured = measure(rows, models, ["doc_id", "held_out"])
    column = F.array_position("bits", F.array_min("bits")).cast("int")
    names = F.array(*[F.lit(x) for x in languages])
    found = F.col("bits").isNotNull()
    if level.limits:
        limits = F.create_map(*[x for (k, band), v in sorted(level.limits.items()) for x in (F.lit(k * 100 + band), F.lit(v))])
        limit = F.try_element_at(limits, (column - 1) * 100 + _band(F.col("letters")))
        high = F.coalesce(F.array_min("bits") > limit, F.lit(False))
    else:
        high = F.lit(False)
    return measured.select(
        "doc_id",
        "held_out",
        F.when(found, F.element_at(names, column)).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(found, posterior(F.col("bits"), level.sharpness)).otherwise(F.lit(0.0)).alias("score"),
        F.when(found, high).otherwise(F.lit(True)).alias("rejected"),
        "letters",
    )
