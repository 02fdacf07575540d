"""Substring dedup by level-wise doubling of repeated word windows.

Level one looks at short windows, half the wanted length, and only at one of several: of each
run of neighbouring short windows the one with the smallest hash stands for all wanted windows that cover
the run. Equal windows choose equal representatives, so a wanted window can be repeated only if its
representative is. Those that occur in one document alone end here, which is most of the corpus.

Level two extends the survivors to the wanted length, about twice theirs, in the texts, and keeps the windows
that are repeated in other documents. From then on lengths double without the texts (``extend``):
a window of length 2n at a place is the pair of the windows of length n there and n words on, so each level
joins the survivors of the last with themselves, until no candidate survives.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb
from demandloom.llm.scratch import Scratch

MIN_WORDS = 13


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def word_hashes(texts: list[bytes]) -> tuple[tb.Words, np.ndarray]:
    words = tb.find_words(texts)
    return words, tb.Hasher(words.data)(words.starts, words.ends)


def representatives(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``size`` words of one text: its first word and the place of its representative.

    The representative is the leftmost smallest of the short windows of (``size`` + 1) // 2 words in it.
    """
    short = (size + 1) // 2
    inside = size - short + 1
    starts = np.flatnonzero(doc[: len(doc) - size + 1] == doc[size - 1 :]) if len(doc) >= size else np.zeros(0, np.int64)
    values = tb.window_hashes(hashes, short)
    if not len(starts):
        return starts, starts
    best, place = values[starts].copy(), starts.copy()
    for step in range(1, inside):
        other = values[starts + step]
        less = other < best
        best[less] = other[less]
        place[less] = starts[less] + step
    return starts, place


def short_windows(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, short``: the distinct representatives of each row's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            words, hashes = word_hashes(texts)
            _, place = representatives(hashes, words.doc, size)
            place = np.unique(place)
            values = tb.window_hashes(hashes, (size + 1) // 2)[place] if len(place) else np.zeros(0, np.uint64)
            ids = rows.column("doc_id").take(pa.array(words.doc[place])) if len(place) else rows.column("doc_id").slice(0, 0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(values.astype(np.int64))], ["doc_id", "short"])

    return _texts(docs).mapInArrow(run, "doc_id long, short long")


def candidate_windows(docs: DataFrame, repeated: DataFrame, size: int) -> DataFrame:
    """``doc_id, place, window``: the windows whose representative is in ``repeated`` ``(doc_id, shorts)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            words, hashes = word_hashes(texts)
            starts, place = representatives(hashes, words.doc, size)
            lists = rows.column("shorts")
            known = np.sort(_tagged(lists.flatten().to_numpy().astype(np.uint64), np.repeat(np.arange(len(texts)), np.diff(_bounds(lists)))))
            out = np.zeros(0, dtype=np.int64)
            if len(starts) and len(known):
                values = _tagged(tb.window_hashes(hashes, (size + 1) // 2)[place], words.doc[starts])
                at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                out = starts[known[at] == values]
            first = np.cumsum(words.counts) - words.counts
            full = tb.window_hashes(hashes, size)[out] if len(out) else np.zeros(0, np.uint64)
            of = words.doc[out]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(of, pa.int64())),
                    pa.array((out - first[of]).astype(np.int32)),
                    pa.array(full.astype(np.int64)),
                ],
                ["doc_id", "place", "window"],
            )

    joined = _texts(docs).join(repeated, "doc_id")
    return joined.mapInArrow(run, "doc_id long, place int, window long")


def _bounds(lists: pa.ListArray) -> np.ndarray:
    """List offsets from 0."""
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0]


def _tagged(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return tb.mix(values + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def repeated_windows(docs: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """``doc_id, place, window, first_id``: windows of ``size`` words that other documents have too.

    ``first_id`` is the smallest id with the window. ``docs`` has no NULL ids.
    """
    # Level one. Partial minima and maxima reduce a passage of very many documents to a few rows.
    short = short_windows(docs, size)
    shared = scratch.keep(
        "short",
        short.groupBy("short").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("short"),
    )
    scratch.drop()
    repeated = scratch.keep(
        "repeated",
        short_windows(docs, size).join(shared, "short").groupBy("doc_id").agg(F.collect_list("short").alias("shorts")),
    )
    scratch.drop("short")
    # Level two.
    candidates = scratch.keep("candidates", candidate_windows(docs, repeated, size))
    scratch.drop("repeated")
    # A written table on this side lets a window of very many documents be split in the join.
    first = scratch.keep(
        "first",
        candidates.groupBy("window")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .filter("first_id < last_id")
        .select("window", "first_id"),
    )
    scratch.drop()
    return candidates.join(first, "window").select("doc_id", "place", "window", "first_id")


def extend(windows: DataFrame, size: int, scratch: Scratch, longest: int | None = None) -> DataFrame:
    """``length, doc_id, place, window``: repeated windows of ``size`` words and of all doubled lengths.

    ``windows`` has ``doc_id, place, window``. Doubling ends when no candidate survives, or with the last
    length up to ``longest``.
    """
    length, level = size, scratch.keep(f"length-{size}", windows.select("doc_id", "place", "window"))
    out = level.select(F.lit(length).alias("length"), "*")
    while longest is None or 2 * length <= longest:
        later = level.select("doc_id", (F.col("place") - length).alias("place"), F.col("window").alias("later"))
        pairs = level.join(later, ["doc_id", "place"]).select(
            "doc_id", "place", F.xxhash64("window", "later").alias("window")
        )
        pairs = scratch.keep(f"pairs-{2 * length}", pairs)
        shared = pairs.groupBy("window").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b")
        level = scratch.keep(f"length-{2 * length}", pairs.join(shared.select("window"), "window").select(*level.columns))
        scratch.drop(f"pairs-{2 * length}")
        if level.isEmpty():
            break
        length *= 2
        out = out.unionByName(level.select(F.lit(length).alias("length"), "*"))
    return out


def covered_words(words: tb.Words, hashes: np.ndarray, size: int, flagged: pa.ListArray) -> np.ndarray:
    """For each word whether a window of ``size`` words covers it whose hash is in its text's list."""
    out = np.zeros(len(hashes) + 1, dtype=np.int64)
    values = flagged.flatten().to_numpy().astype(np.uint64)
    if len(values) and len(hashes) >= size:
        starts = np.flatnonzero(words.doc[: len(hashes) - size + 1] == words.doc[size - 1 :])
        known = np.sort(_tagged(values, np.repeat(np.arange(len(flagged)), np.diff(_bounds(flagged)))))
        own = _tagged(tb.window_hashes(hashes, size)[starts], words.doc[starts])
        hit = starts[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own]
        np.add.at(out, hit, 1)
        np.add.at(out, hit + size, -1)
    return np.cumsum(out[:-1]) > 0


def _lists(column: pa.Array) -> pa.ListArray:
    """The column with empty lists for NULL."""
    return pa.array([x if x is not None else [] for x in column.to_pylist()], pa.list_(pa.int64())) if column.null_count else column


def _later_windows(own: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """``doc_id, windows``: hashes of a document's windows that also start in a smaller id."""
    repeats = repeated_windows(own.filter("doc_id IS NOT NULL"), size, scratch)
    later = scratch.keep(
        "later",
        repeats.filter("first_id < doc_id").groupBy("doc_id").agg(F.collect_set("window").alias("windows")),
    )
    scratch.drop("candidates", "first")
    return later


def _kept_texts(rows: pa.RecordBatch, texts: list[bytes], size: int) -> tuple[np.ndarray, list[int], list[bytes]]:
    """Words, removed words, and the kept words joined by one space, of each text."""
    words, hashes = word_hashes(texts)
    gone = covered_words(words, hashes, size, _lists(rows.column("windows")))
    ends = np.cumsum(words.counts)
    removed, kept = [], []
    for i, (n, end) in enumerate(zip(words.counts.tolist(), ends.tolist())):
        keep = np.flatnonzero(~gone[end - n : end]) + end - n
        text, shift = texts[i], int(words.offsets[i])
        spans = zip((words.starts[keep] - shift).tolist(), (words.ends[keep] - shift).tolist())
        kept.append(b" ".join([text[a:b] for a, b in spans]))
        removed.append(n - len(keep))
    return words.counts, removed, kept


def without_repeats(docs: DataFrame, size: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of each row of ``docs``.

    A word goes if a window of ``size`` words that covers it also starts in a document with a smaller id;
    windows are judged on the input. The digest is of the kept words joined by one space. NULL and empty
    texts have no words. Rows with a NULL id take no part: they lose nothing and nothing is lost to them.
    Rows that repeat an id are one document: a window is no repeat within it, though each row loses
    what its own text has from smaller ids. Extra columns are ignored; an empty table gives no rows.
    """
    own = _texts(docs)
    later = _later_windows(own, size, Scratch(docs.sparkSession, "substrings"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            counts, removed, kept = _kept_texts(rows, texts, size)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(counts.astype(np.int64)),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return own.join(later, "doc_id", "left").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def strip_repeats(docs: DataFrame, size: int = MIN_WORDS) -> DataFrame:
    """``docs`` with all its rows and columns, and texts without repeated words.

    A text that loses nothing is left as it is. ``n_chars``, where there is one, is set to the new
    length in code points.
    """
    later = _later_windows(_texts(docs), size, Scratch(docs.sparkSession, "substrings"))
    columns = docs.columns
    packed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.struct(*[c for c in columns if c != "text"]).alias("row"),
    )
    joined = packed.join(later, "doc_id", "left").select("row", "text", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            _, removed, kept = _kept_texts(rows, texts, size)
            before = rows.column("text").to_pylist()
            after = [x.decode() if gone else old for old, gone, x in zip(before, removed, kept)]
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(after, pa.string())], ["row", "text"])

    schema = joined.drop("windows").schema
    out = joined.mapInArrow(run, schema)
    picked = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns]
    out = out.select(*picked)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind)).select(*columns)
    return out
