"""Document fingerprints by I-Match with randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band. Each of many random
subsets of it gives one part of the fingerprint: the sorted distinct terms of the document that
are in the subset, hashed together. Subsets are small, of several sizes, so that some of them hold one
or two terms of a short document and others of a long one. Likeness is the share of equal parts
among those in which either document has a term; a part counts the less the more terms it depends on.
Each term of the lexicon is in one subset at least. The fingerprint of a document without any such term
has a hash of its whole set of terms instead.

Document frequencies are counted over all documents. The band is a share of the number of
documents, so the lexicon has at most (distinct terms per document) / ``lowest_share`` terms however
many documents there are: that bounds its broadcast.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb
from demandloom.llm.scratch import Scratch

#: Random subsets, and so parts of a fingerprint.
PARTS = 64
#: Chances of a term to be in a subset, taken in turn.
CHANCES = tuple(2.0**-i for i in range(4, 12))
#: Ranges of ids for each shuffle partition, so that hashing them to tasks comes out even.
RANGES_PER_PARTITION = 4
#: Rows of one id, at least, before they are spread.
LEAST_REPEATS = 256
#: A part is the number of its terms, as one digit of these, and four characters of its hash.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"
EMPTY = "0----"
#: Parts that the hash of a whole set of terms fills: 96 bits.
WHOLE_PARTS = 4


def document_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each distinct lower-case term, sorted by both."""
    words = tb.find_words(texts, tb.NOT_TERM)
    hashes = tb.Hasher(words.data, lower=True)(words.starts, words.ends)
    order = np.lexsort((hashes, words.doc))
    doc, hashes = words.doc[order], hashes[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[fresh], hashes[fresh]


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``term, df`` over all documents, summed up per slice of texts before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in tb.slices(batches, limit=4 * tb.SLICE_BYTES):
            terms, counts = np.unique(document_terms(texts)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.astype(np.int64)), pa.array(counts.astype(np.int64))], ["term", "df"]
            )

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term long, df long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"))


class Lexicon:
    """Terms of the band, sorted, and the subsets each of them is in."""

    def __init__(self, terms: np.ndarray, seed: int = 1) -> None:
        self.terms = np.sort(terms.astype(np.uint64))
        self.member = np.zeros((len(self.terms), PARTS), dtype=bool)
        for j in range(PARTS):
            drawn = tb.mix(self.terms ^ tb.mix(np.array([seed * 1000 + j], dtype=np.uint64))[0])
            self.member[:, j] = drawn < np.uint64(int(CHANCES[j % len(CHANCES)] * 2**64))
        # The draws leave about a third of the terms out of all subsets. Each of those gets one, by the
        # chances of the subsets, so that large subsets stay large against small ones.
        out = np.flatnonzero(~self.member.any(axis=1))
        shares = np.cumsum(np.resize(CHANCES, PARTS))
        drawn = tb.mix(self.terms[out] ^ tb.mix(np.array([seed * 1000 + PARTS], dtype=np.uint64))[0])
        home = np.searchsorted(shares, drawn / 2.0**64 * shares[-1], side="right")
        self.member[out, np.minimum(home, PARTS - 1)] = True

    def fingerprints(self, texts: list[bytes]) -> list[str]:
        """One string a text: the hashes of its parts, ``EMPTY`` where it has no term.

        The first parts of a text with terms, but none of the lexicon, hold a hash of all its terms,
        marked as parts without a term.
        """
        doc, terms = all_docs, all_terms = document_terms(texts)
        out = np.full((len(texts), PARTS), EMPTY, dtype=object)
        if len(self.terms):
            place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
            hit = self.terms[place] == terms
            doc, place = doc[hit], place[hit]
            for j in range(PARTS):
                own = self.member[place, j]
                of, held = doc[own], self.terms[place[own]]
                if len(of):
                    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                    for i, part in zip(of[starts].tolist(), np.split(held, starts[1:])):
                        digest = hashlib.blake2b(part.tobytes(), digest_size=3).digest()
                        out[i, j] = DIGITS[min(len(part), 63)] + base64.b64encode(digest).decode()
        bounds = np.searchsorted(all_docs, np.arange(len(texts) + 1))
        for i in np.flatnonzero((out == EMPTY).all(axis=1) & (np.diff(bounds) > 0)).tolist():
            digest = hashlib.blake2b(all_terms[bounds[i] : bounds[i + 1]].tobytes(), digest_size=3 * WHOLE_PARTS).digest()
            out[i, :WHOLE_PARTS] = ["0" + base64.b64encode(digest[3 * k : 3 * k + 3]).decode() for k in range(WHOLE_PARTS)]
        return ["".join(row) for row in out.tolist()]


def likeness(a: str, b: str) -> float:
    """Weighted share of equal parts; equal fingerprints give 1.

    A part weighs the inverse square of the larger number of its terms (63 at most); parts without a term in
    both weigh nothing. Two different fingerprints without any term of the lexicon give 0.
    """
    if a == b:
        return 1.0
    width, same, total = len(EMPTY), 0.0, 0.0
    for i in range(0, len(a), width):
        most = max(DIGITS.index(a[i]), DIGITS.index(b[i]))
        if most:
            total += _WEIGHTS[most]
            if a[i : i + width] == b[i : i + width]:
                same += _WEIGHTS[most]
    return same / total if total else 0.0


_WEIGHTS = [0.0] + [1 / n**2 for n in range(1, 64)]


def build_lexicon(docs: DataFrame, lowest_share: float = 0.0005, highest_share: float = 0.05) -> Lexicon:
    """Lexicon of the terms that a share of documents between the two has."""
    count = docs.count()
    band = document_frequencies(docs).filter(
        F.col("df").between(lowest_share * count, max(highest_share * count, 1))
    )
    return Lexicon(band.select("term").toArrow().column("term").to_numpy())


def fingerprint_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, fingerprint`` of each row; a NULL text has the fingerprint of an empty one."""
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(shipped.value.fingerprints(texts), pa.string())],
                ["doc_id", "fingerprint"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the next document's beginning."""
    cut = len(text) // 4
    return (text[: len(text) - cut] + following[:cut]) if cut else text


def range_starts(docs: DataFrame) -> list[int]:
    """First ids of ranges of about equally many ids: one number a range reaches the driver."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    # named, because ids alone are so small that they would be put into one partition
    ranged = ids.repartitionByRange(_ranges(docs), "doc_id").groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("first"))
    return sorted(r["first"] for r in ranged.collect())


def _ranges(docs: DataFrame) -> int:
    return RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Repeated(NamedTuple):
    """An id of many rows: how many tasks' worth of them there is, and the id that follows."""

    doc_id: int
    salts: int
    following: int


def repeated_ids(docs: DataFrame, most_rows: int | None = None) -> list[Repeated]:
    """Ids with more than ``most_rows`` rows, in order: without a number, those that outweigh an average range.

    By that there are no more of them than ranges.
    """
    counted = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    if most_rows is None:
        total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        most_rows = max(LEAST_REPEATS, -(-total // _ranges(docs)))
    hot = sorted((r["doc_id"], r["n"]) for r in counted.filter(F.col("n") > most_rows).collect())
    if not hot:
        return []
    ids = F.array(*[F.lit(d) for d, _ in hot])
    # the smallest id above so many of the repeated ones
    above = F.size(F.filter(ids, lambda c: c < F.col("doc_id")))
    least = {r["above"]: r["first"] for r in counted.groupBy(above.alias("above")).agg(F.min("doc_id").alias("first")).collect()}
    return [Repeated(d, -(-n // most_rows), least.get(i + 1, least[0])) for i, (d, n) in enumerate(hot)]


def in_ranges(docs: DataFrame, starts: list[int], repeated: list[Repeated] = (), step: int = 64) -> DataFrame:
    """Rows with ``part``, the range of their id, and ``copy``: the rows of a range's first id go to the
    range before it too, as copies that close it; those of the smallest id close the last range.

    Rows with a NULL id are spread over parts of their own, and so are those of a ``repeated`` id: in its
    range one row with its smallest text stands for them, which is not ``shown``, and each of their parts
    is closed by the smallest text of the id that follows.
    """
    if not starts:
        starts = [0]
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").withColumn("shown", F.lit(True))
    if repeated:
        wanted = sorted({r.doc_id for r in repeated} | {r.following for r in repeated})
        least = docs.filter(F.col("doc_id").isin(wanted)).groupBy("doc_id").agg(F.min("text").alias("text"))
        firsts = np.cumsum([len(starts)] + [r.salts for r in repeated]).tolist()
        # one row a repeated id, of which there are no more than ranges; one row a part of theirs
        hot = F.broadcast(spark.createDataFrame([(r.doc_id, a, r.salts) for r, a in zip(repeated, firsts)], "doc_id long, first int, salts int"))
        ends = F.broadcast(
            spark.createDataFrame([(r.following, r.doc_id, a + k) for r, a in zip(repeated, firsts) for k in range(r.salts)], "doc_id long, own long, part int")
        )
        salt = F.floor(F.rand(1) * F.col("salts")).cast("int")
        apart = rows.join(hot, "doc_id").select("doc_id", "text", (F.col("first") + salt).alias("part"), F.lit(0).alias("copy"), "shown")
        closing = least.join(ends, "doc_id").select("doc_id", "text", "part", F.lit(1).alias("copy"), F.lit(False).alias("shown"))
        apart = apart.unionByName(closing)
        stand_in = least.join(hot, "doc_id", "left_semi").select("doc_id", "text", F.lit(False).alias("shown"))
        rows = rows.join(hot, "doc_id", "left_anti").unionByName(stand_in)
    cuts, coarse = (F.array(*map(F.lit, x)) for x in (starts, starts[::step]))
    below = lambda values: F.size(F.filter(values, lambda c: c <= F.col("doc_id")))
    major = F.greatest(below(coarse) - 1, F.lit(0)) * step
    part = major + below(F.slice(cuts, major + 1, F.lit(step))) - 1
    alone = -1 - F.pmod(F.xxhash64("text"), F.lit(1024)).cast("int")
    placed = rows.withColumn("part", F.when(F.col("doc_id").isNull(), alone).otherwise(part.cast("int")))
    own = F.struct(F.col("part"), F.lit(0).alias("copy"), F.col("shown"))
    before = F.when(F.col("part") == 0, len(starts) - 1).otherwise(F.col("part") - 1).cast("int")
    extra = F.struct(before.alias("part"), F.lit(1).alias("copy"), F.lit(False).alias("shown"))
    first = (F.col("part") >= 0) & (F.col("doc_id") == F.get(cuts, F.greatest("part", F.lit(0))))
    places = F.when(first, F.array(own, extra)).otherwise(F.array(own))
    found = placed.select("doc_id", "text", F.inline(places))
    return found.unionByName(apart) if repeated else found


#: The order in which ``with_next`` reads rows: columns, and whether they ascend.
READING = {"part": True, "copy": False, "doc_id": False, "text": True}


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes, bytes]]:
    """Id, text and next text of each row that is shown; rows come by part and from the last id to the first.

    So the next text is known when a row comes, and none waits: two texts are held. The texts of an id
    come in order, the first of them is the next one of the id before.
    """
    current = part = None
    smallest = following = b""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for i, (own, copy, doc_id, shown) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("part", "copy", "doc_id", "shown")))):
            text = texts[i].as_py()
            if own != part:
                part, current, smallest = own, None, b""
            if doc_id is None:
                yield None, text, b""
                continue
            if (copy, doc_id) != current:
                current, following, smallest = (copy, doc_id), smallest, text
            if shown:
                yield doc_id, text, following


def compare_with_edits(docs: DataFrame, lowest_share: float = 0.0005, highest_share: float = 0.05) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and how alike they are.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each
    row. A NULL text is an empty one: its fingerprint has empty parts only. The next document is that of
    the next larger id; if an id has several texts, the smallest of them by code point follows. A row with
    a NULL id has no next document: its last quarter is cut off and ``near_next`` is 0. One document is
    its own next. Extra columns are ignored, an empty table gives no rows.

    Texts move once, to ranges of ids in which each row meets the one after it. The rows of an id that has
    more of them than an average range are spread over tasks.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    lexicon = docs.sparkSession.sparkContext.broadcast(build_lexicon(own, lowest_share, highest_share))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def judge(rows: list[tuple[int | None, bytes, bytes]]) -> pa.RecordBatch:
        plain = [t.decode() for _, t, _ in rows]
        edited = [edited_text(t, n.decode()).encode() for t, (_, _, n) in zip(plain, rows)]
        different = {t: None for _, t, n in rows for t in (t, n)}
        prints = dict(zip(different, lexicon.value.fingerprints(list(different))))
        before, after = [prints[t] for _, t, _ in rows], lexicon.value.fingerprints(edited)
        near_edited = [likeness(f, g) for f, g in zip(before, after)]
        near_next = [0.0 if d is None else likeness(f, prints[n]) for (d, _, n), f in zip(rows, before)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in rows], pa.int64()),
                pa.array([len(t) for t in plain], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
                pa.array(before, pa.string()),
                pa.array(after, pa.string()),
                pa.array(near_edited, pa.float64()),
                pa.array(near_next, pa.float64()),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in with_next(batches):
            held.append(row)
            size += len(row[1]) + 1
            if size >= tb.SLICE_BYTES:
                yield judge(held)
                held, size = [], 0
        if held:
            yield judge(held)

    Scratch(docs.sparkSession, "imatch").drop()
    placed = in_ranges(own, range_starts(own), repeated_ids(own))
    ranged = placed.repartition("part").sortWithinPartitions(*READING, ascending=list(READING.values()))
    return ranged.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
