"""Product codes of vectors by ball k-means.

Vectors are scaled to whole numbers and cut into parts. Every part position has a codebook, whose
entries move to the means of their parts round by round. An entry with its parts is a ball: its
centre, and as radius the distance of its farthest part. Parts that lie within half the way to the
nearest other entry (the stable core) keep their entry without any comparison. The others lie in rings
around the centre: a part is compared only with entries at most twice as far from its own entry as it
is itself, and the radius says which entries are neighbours at all. Nothing else can be nearer, so
the assignment is the exact one.

Spark holds the vectors with their codes as a written table, one for each round. A round adds up counts
and sums by part and entry where the rows are; only those few totals reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.scratch import Scratch

#: Largest size of a scaled component; squared distances stay within 64 bits.
LARGEST = 1 << 26
#: Neighbours that a ring is compared with at once.
RING = 16
#: Parts that are worked on at once.
BLOCK = 16_384


def usable(vector: str) -> Column:
    """True for a vector that is not NULL or empty and has finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def scaled(vector: str, scale: int) -> Column:
    """Components as floor(scale * x); one beyond ``LARGEST`` stops the job."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double") * scale) <= LARGEST)
    return F.when(fits, whole).otherwise(F.raise_error(F.lit("a scaled component is beyond 2 ** 26")))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``, exact."""
    largest = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * largest * largest * a.shape[1] < 1 << 52:  # every term is a whole number that a double holds
        x, y = a.astype(float), b.astype(float)
        found = (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)
        return np.rint(found).astype(np.int64)
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for i in range(a.shape[1]):
        gap = a[:, i][:, None] - b[:, i]
        out += gap * gap
    return out


def own_distance(x: np.ndarray, entries: np.ndarray, code: np.ndarray) -> np.ndarray:
    gap = x - entries[code]
    return (gap * gap).sum(axis=1)


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Index of each row's nearest entry, ties to the lower index, by comparing with all."""
    out = [squared(x[a : a + BLOCK], entries).argmin(axis=1) for a in range(0, len(x), BLOCK)]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


class Balls:
    """A codebook with what its entries know of each other."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        between = squared(entries, entries)
        np.fill_diagonal(between, -1)  # the entry itself comes first
        self.order = np.argsort(between, axis=1, kind="stable")
        self.apart = np.take_along_axis(between, self.order, axis=1)

    def assign(self, x: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Nearest entries of the parts ``x``, given entries that were nearest a round ago."""
        out = code.astype(np.int64)
        if len(self.entries) < 2 or not len(x):
            return out
        own = own_distance(x, self.entries, out)
        radius = np.zeros(len(self.entries), dtype=np.int64)
        np.maximum.at(radius, out, own)
        # neighbours of a ball: entries at most two radii away; one as near as that can tie
        neighbours = (self.apart[:, 1:] <= 4 * radius[:, None]).sum(axis=1)
        moving = np.flatnonzero(self.apart[out, 1] <= 4 * own)
        moving = moving[np.argsort(out[moving], kind="stable")]
        held, first = np.unique(out[moving], return_index=True)
        for entry, rows in zip(held, np.split(moving, first[1:])):
            others = self.order[entry, 1 : 1 + neighbours[entry]]
            rings = np.searchsorted(self.apart[entry, 1 : 1 + neighbours[entry]], 4 * own[rows], side="right")
            # the outermost first: each further ring concerns fewer parts
            by_ring = np.argsort(-rings, kind="stable")
            rows, rings = rows[by_ring], rings[by_ring]
            best, index = own[rows], np.full(len(rows), entry)
            for a in range(0, int(rings[0]), RING):
                n = int(np.searchsorted(-rings, -a, side="left"))
                ring = np.sort(others[a : a + RING])
                gaps = squared(x[rows[:n]], self.entries[ring])
                at = gaps.argmin(axis=1)
                gap, found = gaps[np.arange(n), at], ring[at]
                nearer = (gap < best[:n]) | ((gap == best[:n]) & (found < index[:n]))
                best[:n][nearer], index[:n][nearer] = gap[nearer], found[nearer]
            out[rows] = index
        return out


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


STATE = "vec_id long, label string, q array<int>, codes array<short>"


def assign_all(state: DataFrame, books: np.ndarray, known: bool) -> DataFrame:
    """``STATE`` with the codes for ``books`` (parts x entries x width); ``known``: it has codes of a round ago."""
    shipped = state.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(shipped.value)
        balls = [Balls(b) for b in shipped.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch, "q").astype(np.int64).reshape(batch.num_rows, parts, -1)
            old = _matrix(batch, "codes") if known else None
            codes = [b.assign(q[:, p], old[:, p]) if known else nearest(q[:, p], b.entries) for p, b in enumerate(balls)]
            found = np.column_stack(codes).astype(np.int16)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), parts).cast(pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["vec_id", "label", "q", "codes"])

    return state.mapInArrow(run, STATE)


def entry_totals(state: DataFrame, parts: int, entries: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts (parts x entries) and sums (parts x entries x width); one row an entry reaches the driver."""
    names = [f"s{i}" for i in range(width)]
    schema = ", ".join(["part int", "entry int", "n long", *[f"{c} long" for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(parts * entries, dtype=np.int64)
        sums = np.zeros((parts * entries, width), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                place = (_matrix(batch, "codes").astype(np.int64) + np.arange(parts) * entries).ravel()
                q = _matrix(batch, "q").astype(np.int64).reshape(-1, width)
                counts += np.bincount(place, minlength=len(counts))
                np.add.at(sums, place, q)
        used = np.flatnonzero(counts)
        columns = [used // entries, used % entries, counts[used], *sums[used].T]
        kinds = [pa.int32(), pa.int32()] + [pa.int64()] * (width + 1)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", *names])

    rows = (
        state.select("q", "codes")
        .mapInArrow(run, schema)
        .groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
        .collect()
    )
    counts = np.zeros((parts, entries), dtype=np.int64)
    sums = np.zeros((parts, entries, width), dtype=np.int64)
    for r in rows:
        counts[r["part"], r["entry"]] = r["n"]
        sums[r["part"], r["entry"]] = [r[c] for c in names]
    return counts, sums


def first_books(state: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the rows with the smallest ids, ascending; NULL ids come last, ties go by the vector."""
    rows = state.select("vec_id", "q").orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).collect()
    start = np.array([r["q"] for r in rows], dtype=np.int64)
    return start.reshape(len(rows), parts, -1).transpose(1, 0, 2) if len(rows) else np.zeros((parts, 0, 0), dtype=np.int64)


def move(books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Entries at floor(sum / count) of their parts; one without parts stays."""
    used = counts > 0
    out = books.copy()
    out[used] = sums[used] // counts[used][:, None]
    return out


def books_digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, joined by commas, as lowercase hex."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> tuple[DataFrame, np.ndarray]:
    """Rows ``vec_id, label, q, codes, error`` of the vectors, and the final codebooks (parts x entries x width).

    Left out are vectors that are NULL, empty or hold NULL or non-finite components, and those whose length is
    not that of the first kept one or is no multiple of ``parts``. Fewer rows than ``entries`` give as many entries
    as there are rows. Equal entries serve by the first of them. Rows that repeat an id are coded one by one
    and all count; those with a NULL id too, but they start a codebook only when ids run out. A component beyond
    2 ** 26 after scaling stops the job with a message. An empty table gives no rows and empty codebooks.
    """
    scratch = Scratch(vectors.sparkSession, "ball-codes")
    good = vectors.filter(usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        scaled("embedding", scale).alias("q"),
        F.array().cast("array<short>").alias("codes"),
    )
    state = scratch.keep("whole-numbers", good)
    first = state.select("q").orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(1).collect()
    length = len(first[0]["q"]) if first else 0
    fitting = state.filter((F.size("q") == length) & F.lit(length % parts == 0))
    books = first_books(fitting, parts, entries)
    size, width = books.shape[1:]
    if not size:
        return state.limit(0).withColumn("error", F.lit(0).cast("long")), books
    current, last = fitting, "whole-numbers"
    for i in range(rounds + 1):
        current = scratch.keep(f"round-{i}", assign_all(current, books, known=i > 0))
        scratch.drop(last)
        last = f"round-{i}"
        if i < rounds:
            books = move(books, *entry_totals(current, parts, size, width))
    return with_errors(current, books), books


def with_errors(state: DataFrame, books: np.ndarray) -> DataFrame:
    """``state`` with ``error``, the squared distances to the coded entries, summed over the parts."""
    shipped = state.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(shipped.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch, "q").astype(np.int64).reshape(batch.num_rows, parts, -1)
            codes = _matrix(batch, "codes")
            errors = sum(own_distance(q[:, p], shipped.value[p], codes[:, p]) for p in range(parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(errors, pa.int64())], [*batch.schema.names, "error"])

    return state.mapInArrow(run, f"{STATE}, error long")


def vector_codes(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each vector that ``compress`` keeps.

    A code has two hex digits a part (more, if there are more than 256 entries). ``label_error`` adds up the errors of equal labels, NULL labels together.
    """
    scratch = Scratch(vectors.sparkSession, "vector-codes")
    coded, books = compress(vectors, parts, entries, rounds, scale)
    width = max(2, len(f"{entries - 1:x}"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), width, "0")))
    rows = scratch.keep("codes", coded.select("vec_id", "label", F.array_join(digits, "").alias("code"), "error"))
    # written, so that its size decides how it is joined
    totals = scratch.keep("labels", rows.groupBy(F.col("label").alias("known")).agg(F.sum("error").alias("label_error")))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("known"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
