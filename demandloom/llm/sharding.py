"""Sharding by histogram sort.

Rows are ordered by a 60-bit hash of the text, among equal texts by one of the id, and among rows that
repeat both by one of the row's number. Splitters are found without moving rows: each round counts the exact bytes in the cells below the candidate
boundaries, and only the cells in which a splitter falls are cut finer, until each splitter is
within tolerance of its goal. Then the rows are exchanged once.

Equal texts are neighbours. A splitter settles on a boundary between texts wherever one is within
tolerance, so a group of equal texts is cut only if it is too large to stay whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.scratch import Scratch

#: Bits of the order that a round resolves: at most 4096 counts a splitter reach the driver.
DIGIT_BITS = 12
#: The order, and the bits of each of its keys.
ORDER = ("text_order", "id_order", "row_order")
KEY_BITS = 60
#: Rows that are numbered in one task.
SLOT_ROWS = 100_000

Splitter = tuple[int, int, int]


def row_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (NULL: none) plus 8."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long")


def _order_key(value: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value), 64 - KEY_BITS)


def with_order(docs: DataFrame) -> DataFrame:
    """``docs`` with the keys of the order; NULL texts are ordered as empty ones.

    Rows are numbered as they are read, so the result has to be written before it is read twice, unless
    ``docs`` is a table that gives its rows in the same order each time.
    """
    return docs.withColumns(
        {
            "text_order": _order_key(F.coalesce(F.col("text"), F.lit(""))),
            "id_order": _order_key(F.col("doc_id")),
            "row_order": _order_key(F.monotonically_increasing_id()),
        }
    )


def find_splitters(ordered: DataFrame, shards: int, tolerance: float = 0.01) -> list[Splitter]:
    """Lower bounds, one value for each key of ``ORDER``, of shards 1 to ``shards`` - 1.

    ``ordered`` has the keys and ``size``. ``tolerance`` is the allowed distance of a splitter from
    its goal, as a share of one shard's bytes. Without rows all splitters are the highest key.
    """
    end = 1 << KEY_BITS
    total = ordered.agg(F.sum("size")).first()[0] or 0
    found: dict[int, Splitter] = {i: (end, 0, 0) for i in range(1, shards)} if not total else {}
    near = tolerance * total / shards
    rounds = KEY_BITS // DIGIT_BITS
    # Cells that are open, by their first key, with the bytes below them and the goals inside.
    open_cells: dict[Splitter, tuple[int, list[int]]] = {}
    if total:
        open_cells[(0, 0, 0)] = (0, list(range(1, shards)))
    for step in range(len(ORDER) * rounds):
        if not open_cells:
            break
        depth = step // rounds
        fixed, own = ORDER[:depth], ORDER[depth]
        shift = KEY_BITS - DIGIT_BITS * (step % rounds + 1)
        # a key is refined among the rows that agree with an open cell in the keys before it
        rows = ordered
        for place, name in enumerate(fixed):
            rows = rows.filter(F.col(name).isin(sorted({k[place] for k in open_cells})))
        cell = F.shiftright(F.col(own), shift)
        parent = F.shiftright(cell, DIGIT_BITS)
        parents = sorted({k[depth] >> (shift + DIGIT_BITS) for k in open_cells})
        counts: dict[tuple[int, ...], dict[int, int]] = {}
        for r in (
            rows.filter(parent.isin(parents))
            .groupBy(*fixed, parent.alias("parent"), cell.alias("cell"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        ):
            counts.setdefault((*[r[name] for name in fixed], r["parent"]), {})[r["cell"]] = r["bytes"]
        following: dict[Splitter, tuple[int, list[int]]] = {}
        for key, (below, goals) in open_cells.items():
            cells = sorted(counts[(*key[:depth], key[depth] >> (shift + DIGIT_BITS))].items())
            for goal in goals:
                want, low = goal * total / shards, below
                for place, size in cells:
                    if low + size >= want or place == cells[-1][0]:
                        break
                    low += size
                edge = lambda c: (*key[:depth], c << shift, 0, 0)[: len(ORDER)]
                last = step == len(ORDER) * rounds - 1
                if min(abs(want - low), abs(low + size - want)) <= near or last:
                    found[goal] = edge(place if abs(want - low) <= abs(low + size - want) else place + 1)
                else:
                    following.setdefault(edge(place), (low, []))[1].append(goal)
        open_cells = following
    return [found[i] for i in range(1, shards)]


def shard_of(splitters: list[Splitter]) -> Column:
    """Shard of an ordered row: the number of splitters at or below it."""
    key = F.struct(*ORDER)
    out = F.lit(0)
    for splitter in splitters:
        edge = F.struct(*[F.lit(x).cast("long").alias(name) for x, name in zip(splitter, ORDER)])
        out = out + (key >= edge).cast("int")
    return out.cast("int")


def shard_documents(docs: DataFrame, shards: int = 24, tolerance: float = 0.01) -> DataFrame:
    """Shard and slot of each row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``law`` is ``bytes``: shards hold nearly equal bytes. Slots count from 0 in each shard,
    without gaps. NULL texts count as empty; NULL ids are ids like others, and rows that repeat an id and
    a text are told apart by their number, so any group can be cut. A long text is never taken apart. Only ids, sizes and hashes move. Extra columns are ignored, an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    ordered = scratch.keep(
        "ordered",
        with_order(docs.select("doc_id", "text")).select(
            "doc_id",
            row_bytes().alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
            *ORDER,
        ),
    )
    parts = max(1, math.ceil(ordered.count() / (shards * SLOT_ROWS)))
    placed = ordered.withColumn("shard", shard_of(find_splitters(ordered, shards, tolerance))).withColumn(
        "part", F.pmod(F.xxhash64("row_order"), F.lit(max(parts, 8))).cast("int")
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "part")
        .agg(F.count("*").alias("rows"))
        .withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .drop("rows")
    )
    within = Window.partitionBy("shard", "part").orderBy(*ORDER)
    return placed.join(offsets, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, tolerance: float = 0.01, tasks_per_shard: int = 4) -> None:
    """Write whole rows by shard, in order, with a single exchange of the texts.

    ``docs`` has to give its rows in the same order each time, as a table of files does.
    """
    ordered = with_order(docs).withColumn("__size", row_bytes())
    splitters = find_splitters(ordered.select(*ORDER, F.col("__size").alias("size")), shards, tolerance)
    (
        ordered.withColumn("shard", shard_of(splitters))
        .withColumn("__part", F.pmod("row_order", F.lit(tasks_per_shard)))
        .repartition("shard", "__part")
        .sortWithinPartitions("shard", *ORDER)
        .drop(*ORDER, "__size", "__part")
        .write.partitionBy("shard")
        .parquet(path)
    )
