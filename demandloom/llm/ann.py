"""Approximate nearest neighbours with learned partitions.

A bounded sample of the vectors gives a graph of nearest neighbours, which is cut into parts of equal
size with few edges between them. A small classifier learns, for a vector, in which parts its neighbours are. Every
row is indexed in its most probable part; a query is sent to as many of its most probable parts as
the sample needs for the wanted recall, and is ranked there against the original vectors.

Parts and queries meet in blocks of bounded size, so a part with a third of all rows is many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.scratch import Scratch

#: Vectors that the partition is learnt from, at most.
SAMPLE_ROWS = 8192
#: Rows of a part, and queries, that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
#: Rows that an index part should hold, until there are ``MOST_PARTS``.
PART_ROWS, MOST_PARTS = 128, 64


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` rows with the largest inner product of each row, itself excluded."""
    degree = min(degree, len(x) - 1)
    out = np.zeros((len(x), degree), dtype=np.int64)
    for a in range(0, len(x), 1024):
        scores = x[a : a + 1024] @ x.T
        scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        out[a : a + 1024] = np.argpartition(-scores, degree - 1, axis=1)[:, :degree] if degree else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, passes: int = 20) -> np.ndarray:
    """Part of each row: halves of halves, ``parts`` a power of two, differing by one row at most.

    A half starts as the upper half along the direction of largest spread. Then rows that have more
    neighbours across than on their own side change places in pairs, the most gaining first.
    """
    label = np.zeros(len(x), dtype=np.int64)
    source = np.repeat(np.arange(len(x)), graph.shape[1])
    target = graph.ravel()
    for level in range(int(math.log2(parts))):
        following = label * 2
        for part in range(2**level):
            rows = np.flatnonzero(label == part)
            if len(rows) < 2:
                continue
            centred = x[rows] - x[rows].mean(axis=0)
            _, vectors = np.linalg.eigh(centred.T @ centred)
            side = np.zeros(len(rows), dtype=np.int64)
            side[np.argsort(centred @ vectors[:, -1], kind="stable")[len(rows) // 2 :]] = 1
            local = np.full(len(x), -1)
            local[rows] = np.arange(len(rows))
            inside = (local[source] >= 0) & (local[target] >= 0)
            a, b = local[source[inside]], local[target[inside]]
            for _ in range(passes):
                cross = np.where(side[a] != side[b], 1.0, -1.0)
                gain = np.bincount(a, cross, len(rows)) + np.bincount(b, cross, len(rows))
                zero, one = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
                n = min(len(zero), len(one))
                # half of the gaining pairs: neighbours that move together gain less than counted
                swap = int(np.sum(gain[zero[:n]] + gain[one[:n]] > 0)) // 2
                if not swap:
                    break
                side[zero[:swap]], side[one[:swap]] = 1, 0
            following[rows] += side
        label = following
    return label


class Router(NamedTuple):
    """A classifier with one hidden layer: log-probabilities of parts."""

    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.inner + self.inner_bias, 0) @ self.outer + self.outer_bias


def train_router(x: np.ndarray, wanted: np.ndarray, hidden: int = 128, steps: int = 300, rate: float = 0.01, seed: int = 1) -> Router:
    """Adam on the cross entropy to ``wanted``, the shares of each row's neighbours in the parts."""
    rng = np.random.default_rng(seed)
    d, m = x.shape[1], wanted.shape[1]
    scale = max(float(np.sqrt((x * x).sum(axis=1).mean())), 1e-12)
    weights = [rng.normal(0, 1 / scale, (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), (hidden, m)), np.zeros(m)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    batch = min(len(x), 1024)
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), batch)
        own, goal = x[rows], wanted[rows]
        middle = np.maximum(own @ weights[0] + weights[1], 0)
        out = middle @ weights[2] + weights[3]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        gap = (out / out.sum(axis=1, keepdims=True) - goal) / batch
        back = (gap @ weights[2].T) * (middle > 0)
        for i, g in enumerate((own.T @ back, back.sum(axis=0), middle.T @ gap, gap.sum(axis=0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            pace = rate * (1 - step / (steps + 1))
            weights[i] -= pace * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*weights)


class Index(NamedTuple):
    """A trained router, how many parts a query visits, and the recall that this had on the sample."""

    router: Router
    probes: int
    recall: float


def learn_index(x: np.ndarray, parts: int, neighbours: int, recall: float, degree: int = 10) -> Index:
    """Partition, router and the number of probes from a sample of vectors."""
    graph = neighbour_graph(x, degree)
    label = balanced_parts(x, graph, parts)
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.arange(len(x)), label), 1.0)
    for j in range(graph.shape[1]):
        np.add.at(wanted, (np.arange(len(x)), label[graph[:, j]]), 1.0)
    router = train_router(x, wanted / wanted.sum(axis=1, keepdims=True))
    logits = router.logits(x)
    placed = logits.argmax(axis=1)
    asked = np.arange(0, len(x), max(1, len(x) // 1024))
    truth = neighbour_graph(x, neighbours)[asked]
    rank = np.argsort(np.argsort(-logits[asked], axis=1, kind="stable"), axis=1)
    needed = rank[np.arange(len(asked))[:, None], placed[truth]]
    for probes in range(1, parts + 1):
        reached = float((needed < probes).mean()) if needed.size else 1.0
        if reached >= recall:
            return Index(router, probes, reached)
    return Index(router, parts, 1.0)


def usable(vector: str, dimension: int) -> Column:
    """True for vectors of the dimension with finite components that are not all zero."""
    column = F.col(vector)
    finite = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(column) == dimension) & finite & F.exists(column, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    neighbours: int = 20,
    recall: float = 0.94,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found rows of each query, by inner product.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``. Rows with the query's own id are no
    candidates. Equal scores are ranked by the smaller id. Vectors that are NULL, zero, of another dimension
    than most, or that hold NULL or non-finite components take no part, nor do rows with a NULL id.
    Candidates that repeat an id are rows of their own; a query id is asked once, with its smallest
    vector. Extra columns are ignored. With an empty side there are no rows.

    ``recall`` is what the number of probed parts must reach on the sample of at most ``sample_rows``.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    rows = vectors.filter("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = queries.filter("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    common = (
        rows.filter(F.size("embedding") > 0).groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    )
    dimension = common["d"] if common else 0
    rows, asked = rows.filter(usable("embedding", dimension)), asked.filter(usable("embedding", dimension))
    asked = asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(sample_rows).select("embedding").toArrow()
    if not sample.num_rows:
        return asked.limit(0).select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    x = _matrix(sample.column("embedding").combine_chunks(), sample.num_rows)
    parts = 2 ** int(math.log2(min(MOST_PARTS, max(1, rows.count() // PART_ROWS, 1), sample.num_rows)))
    index = learn_index(x, parts, neighbours, recall)
    shipped = spark.sparkContext.broadcast(index)

    def route(probes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                logits = shipped.value.router.logits(_matrix(batch.column("embedding"), batch.num_rows))
                best = np.argsort(-logits, axis=1, kind="stable")[:, :probes]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(best.ravel().astype(np.int32)), probes).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("embedding"), lists], ["vec_id", "embedding", "parts"]
                )

        return run

    routed = "vec_id long, embedding array<double>, parts array<int>"
    indexed = scratch.keep("indexed", rows.mapInArrow(route(1), routed).withColumn("part", F.element_at("parts", 1)).drop("parts"))
    sent = scratch.keep(
        "sent", asked.mapInArrow(route(index.probes), routed).withColumn("part", F.explode("parts")).drop("parts")
    )
    blocks = lambda df, size, name: df.groupBy("part").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    # one row a part, of which there are at most MOST_PARTS
    sizes = F.broadcast(blocks(indexed, BLOCK_ROWS, "row_blocks").join(blocks(sent, BLOCK_QUERIES, "query_blocks"), "part"))
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    own = lambda count: F.pmod(F.xxhash64("vec_id"), F.col(count)).cast("int")
    left = indexed.join(sizes, "part").select(
        "part", own("row_blocks").alias("row_block"), spread("query_blocks").alias("query_block"), F.lit(0).alias("side"), "vec_id", "embedding"
    )
    right = sent.join(sizes, "part").select(
        "part", spread("row_blocks").alias("row_block"), own("query_blocks").alias("query_block"), F.lit(1).alias("side"), "vec_id", "embedding"
    )
    key = ["part", "row_block", "query_block"]
    met = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "side", "vec_id")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, ids, matrix = None, [], [], None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in key] + [batch.column("side").to_numpy()])
            edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1 if len(keys) else []
            for a, b in zip([0, *edges], [*edges, len(keys)]):
                if a == b:
                    continue
                block, side = tuple(keys[a][:3]), keys[a][3]
                x = _matrix(batch.column("embedding").slice(a, b - a), b - a)
                own_ids = batch.column("vec_id").slice(a, b - a).to_numpy()
                if block != current:
                    current, held, ids, matrix = block, [], [], None
                if side == 0:
                    held.append(x)
                    ids.append(own_ids)
                elif held:
                    if matrix is None:
                        matrix, all_ids = np.concatenate(held), np.concatenate(ids)
                    yield nearest(own_ids, x, all_ids, matrix, neighbours)

    found = met.mapInArrow(rank, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, neighbours: int) -> pa.RecordBatch:
    """The nearest rows of each query, as ``query_id, vec_id, score``.

    A matrix product picks the rows, with a margin for its rounding; their scores are summed up anew,
    each in the same order, so that equal vectors have equal scores.
    """
    out_q, out_v, out_s = [], [], []
    for a in range(0, len(queries), 256):
        rough = queries[a : a + 256] @ rows.T
        rough[query_ids[a : a + 256, None] == ids[None, :]] = -np.inf
        for i, scores in enumerate(rough):
            if len(scores) > neighbours:
                edge = np.partition(scores, len(scores) - neighbours)[len(scores) - neighbours]
                near = np.flatnonzero(scores >= edge - 1e-9 * max(1.0, abs(edge))) if np.isfinite(edge) else np.flatnonzero(np.isfinite(scores))
            else:
                near = np.flatnonzero(np.isfinite(scores))
            exact = (rows[near] * queries[a + i]).sum(axis=1)
            order = np.lexsort((ids[near], -exact))[:neighbours]
            out_q.append(np.full(len(order), query_ids[a + i]))
            out_v.append(ids[near][order])
            out_s.append(exact[order])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x)) for x in (out_q, out_v, out_s)], ["query_id", "vec_id", "score"]
    )
