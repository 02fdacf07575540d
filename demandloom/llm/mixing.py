"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled and read up to ``max_repeats`` times. A document's virtual finish time
is what its source has sent up to and with it, divided by the source's target. The mix is all
documents in the order of finish times, cut where the total budget (the size of all
sources) is used up.

No step holds a source, or the whole order, in one task. A source is cut into buckets of its
shuffle order, whose sums give each bucket's offset; the cut is found from the sums of buckets
of finish time, and only the one bucket in which the budget ends is put in order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source that one bucket of its shuffle order should hold.
BUCKET_ROWS = 20_000
#: Buckets for the rows of a source with a NULL id and one size.
SPREAD = 64


def word_count(text: str | Column = "text") -> Column:
    """Words of a text; a NULL text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: str = "doc_id", seed: str = "mix") -> Column:
    """Place of a document in its source's shuffled order: the same on every run."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def with_buckets(sized: DataFrame, digits: int, seed: str = "mix") -> DataFrame:
    """Add ``bucket``, in the shuffle order ``key, doc_id, size`` of a source: the first digits of the key.

    Rows with a NULL id have one key. They are cut again by size, and those of one size by ``spread``: as
    they differ in nothing that the order or the result shows, any order of them is the same.
    """
    alone = F.md5(F.lit(f"{seed}-"))
    unnamed = F.col("doc_id").isNull()
    place = F.when(unnamed, 1).when(F.col("key") < alone, 0).otherwise(2)
    return sized.withColumn(
        "bucket",
        F.struct(
            F.substring("key", 1, digits).alias("digits"),
            # the rows before, of and after the key of NULL ids; elsewhere the digits are enough
            F.when(F.substring("key", 1, digits) == F.substring(alone, 1, digits), place).otherwise(0).alias("place"),
            F.when(unnamed, F.col("size")).otherwise(F.lit(0)).alias("of_size"),
            F.when(unnamed, F.col("spread")).otherwise(F.lit(0)).alias("spread"),
        ),
    ).drop("spread")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """Targets of sources from their sizes ``(source, source_size)``.

    Sources take the weights in turn, by code point with NULL last, and share the size of all.
    A target stops at ``max_repeats`` times its source; the excess is shared again by weight.
    That is a common level per unit of weight: with sources ordered by cap per weight, the
    level that is left after the first i caps is highest at the right i. One row a source.
    """
    ranked = sizes.withColumn(
        "turn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight.cast("long")).withColumn(
        "cap", F.col("source_size") * max_repeats
    )
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "turn").rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return capped.withColumn("level", level).select(
        "source",
        "turn",
        "source_size",
        F.round(
            F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight")), 6
        ).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = 3,
    seed: str = "mix",
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """How much of each document the mix takes.

    Returns one row a row of ``docs``: ``doc_id, size, source_size, target, taken, repeats``,
    ``finish``, the virtual time of the first reading (NULL for empty documents), ``sent``, the words of
    the source up to the row, ``turn``, the place of its source, and the ``carried`` columns of the row.
    Documents without words take no part (``taken`` 0); so do all where nothing has words. A
    NULL source is a source; a NULL ``doc_id`` is shuffled as an empty one. Repeated rows are
    rows of their own. Extra columns are ignored. No row is taken more than ``max_repeats`` times.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    # written with its number, so that rows with a NULL id keep their place among equals
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int").alias("spread")
    sized = scratch.keep(
        "sized",
        docs.select(
            "doc_id", "source", word_count().alias("size"), shuffle_key(seed=seed).alias("key"), spread,
            *[column.alias(name) for name, column in (carried or {}).items()],
        ),
    )
    rows = sized.count()
    digits = max(2, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS + 1, 16)))
    sized = with_buckets(sized, digits, seed)

    # One row for each source and bucket: offsets within the source, and the source's target.
    counted = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    counted = counted.withColumn("source_size", F.sum("bucket_size").over(Window.partitionBy("source")))
    targets = source_targets(
        counted.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_repeats
    )
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.drop("source_size")
        .withColumn("offset", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
        .alias("o")
        .join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source")))
        .select("o.source", "o.bucket", "offset", "turn", "source_size", "target")
    )
    within = (
        Window.partitionBy("s.source", "s.bucket")
        .orderBy("key", "doc_id", "size", *(carried or {}))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = scratch.keep(
        "placed",
        sized.alias("s")
        .join(
            offsets.alias("o"),
            F.col("s.source").eqNullSafe(F.col("o.source")) & (F.col("s.bucket") == F.col("o.bucket")),
        )
        .withColumn("sent", F.col("offset") + F.sum("size").over(within))
        .select("doc_id", "size", "turn", "source_size", "target", "sent", *(carried or {})),
    )
    scratch.drop("sized")
    end = _cut(placed, max_repeats, rows)

    # A reading is taken if it comes no later than the last one within the budget.
    finish = lambda e: (F.col("sent") + F.col("source_size") * e) / F.col("target")
    repeats = F.lit(0)
    if end is not None:
        for e in range(max_repeats):
            early = (finish(e) < end[0]) | ((finish(e) == end[0]) & (F.col("turn") <= end[1]))
            repeats = repeats + F.when((F.col("size") > 0) & (F.col("target") > 0) & early, 1).otherwise(0)
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * repeats).cast("long").alias("taken"),
        repeats.cast("int").alias("repeats"),
        F.when((F.col("size") > 0) & (F.col("target") > 0), finish(0)).alias("finish"),
        "sent",
        "turn",
        *(carried or {}),
    )


def _cut(placed: DataFrame, max_repeats: int, rows: int) -> tuple[float, int] | None:
    """Finish time and source of the last reading within the budget; None if there is none."""
    parts = max(64, rows // BUCKET_ROWS)
    readings = (
        placed.filter((F.col("size") > 0) & (F.col("target") > 0))
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
        .withColumn("finish", (F.col("sent") + F.col("source_size") * F.col("pass")) / F.col("target"))
        # what ends after twice the time of the targets is far beyond the budget
        .withColumn("range", F.least(F.floor(F.col("finish") * parts), F.lit(2 * parts)).cast("long"))
    )
    budget = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    sums = readings.groupBy("range").agg(F.sum("size").alias("range_size"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        sums.withColumn("before", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
        .filter(F.col("before") < budget)
        .agg(F.max_by(F.struct("range", "before"), "range"))
        .first()[0]
    )
    if last is None:
        return None
    order = Window.partitionBy("range").orderBy("finish", "turn")
    inside = readings.filter(F.col("range") == last["range"]).withColumn(
        "total", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    end = (
        inside.filter(F.col("total") + last["before"] <= budget)
        .agg(F.max(F.struct("finish", "turn")))
        .first()[0]
    )
    if end is None:  # its first reading goes beyond the budget: all before this range, nothing of it
        earlier = readings.filter(F.col("range") < last["range"]).agg(F.max(F.struct("finish", "turn"))).first()[0]
        end = earlier
    return None if end is None else (end["finish"], end["turn"])


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: documents as often as they are taken, each reading at its finish time.

    Returns the columns of ``docs`` (none of them a map), range-partitioned and sorted in the order of a fair queue over
    the sources; equal times go by source. Documents that are not taken are left out. A row is found again by its id and two
    hashes of all its columns, so rows that agree in all columns stand for each other and any number of rows may lack an
    id. Texts move twice: to meet what is taken of them, and to their place in the mix.
    """
    columns = docs.columns
    key = ["__id", "__first", "__second"]
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    marks = dict(zip(key, (name, F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))))
    # rows that agree in everything are met once, and given out as often as all of them are taken
    whole = docs.select(*[c.alias(k) for k, c in marks.items()], F.struct(*columns).alias("__row"))
    once = whole.groupBy(*key).agg(F.first("__row").alias("__row"))
    taken = (
        mix_sources(docs, **parameters, carried=marks)
        .filter(F.col("repeats") > 0)
        .select(*key, "sent", "source_size", "target", "turn", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)).alias("pass"))
    )
    finish = (F.col("sent") + F.col("source_size") * F.col("pass")) / F.col("target")
    return (
        taken.join(once, key)
        .select("__row", finish.alias("__finish"), F.col("turn").alias("__turn"))
        .repartitionByRange("__finish", "__turn")
        .sortWithinPartitions("__finish", "__turn")
        .select("__row.*")
    )
