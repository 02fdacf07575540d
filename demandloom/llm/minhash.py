"""Near-duplicate groups by bottom-k sketches of one hash function.

A document is the set of hashes of its word shingles; its sketch is the ``k`` smallest of
them. Documents with equal sets form a class at once, and one row stands for a class from then on.

*Candidates* come from inverted lists of sketch values. Two sets with the wanted similarity
share at least ``required_overlap`` values of their sketches, so it is enough to list each class under
its rarest values: all but ``required - 1`` of them. Values of passages that many documents share
are then listed only for documents that consist of little else.

*Stars before pairs.* What is wanted are groups, so a list does not have to be paired off: first each list
links its members to the most central of them, the one that shares most of its sketch, and the links found
join groups. After that, members outside the largest group of their lists are compared with all others, block
by block, on the full sets: a block pair is one product of two small matrices, and only links that join groups
leave the task. So no two members that could be linked stay untried, and no table of pairs is made.

*Filter and proof.* The k smallest values of the union of two sketches are a sketch of the union of the sets:
the share of them in both estimates the similarity, and star pairs below ``required_overlap`` are let go. The
rest is decided on the full sets, streamed in blocks of partners past one set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb
from demandloom.llm.graph import components, few_tasks
from demandloom.llm.scratch import Scratch

#: Partners that stream past one full set in one block.
BLOCK_PARTNERS = 256
#: Rounds of stars before the comparison in blocks.
STAR_ROUNDS = 1


@lru_cache
def required_overlap(k: int, percent: int, miss: float = 1e-9) -> int:
    """Smallest number of common sketch values that a pair with the similarity has, but for a chance of ``miss``.

    The values common to both among the k smallest of the union are binomial with the similarity.
    """
    p, tail = percent / 100, 0.0
    for x in range(k + 1):
        tail += comb(k, x) * p**x * (1 - p) ** (k - x)
        if tail > miss:
            return x
    return k


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a shorter text is one shingle."""
    words = tb.find_words(texts)
    hashes = tb.Hasher(words.data, lower=True)(words.starts, words.ends)
    windows = tb.window_hashes(hashes, size)
    out, at = [], 0
    for n in words.counts.tolist():
        if n >= size:
            out.append(np.unique(windows[at : at + n - size + 1]))
        elif n:
            out.append(tb.window_hashes(hashes[at : at + n], n))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out


def _fingerprint(values: np.ndarray) -> bytes:
    """128 bits of a set, from two sums of mixed members."""
    first = np.add.reduce(tb.mix(values), dtype=np.uint64)
    second = np.add.reduce(tb.mix(values ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)
    return np.array([first, second], dtype=">u8").tobytes()


def sketch_documents(docs: DataFrame, k: int, size: int) -> DataFrame:
    """``doc_id, n_shingles, node, sketch`` of each row: node names the set, sketch holds its k smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            sets = shingle_sets(texts, size)
            counts = [len(x) for x in sets]
            nodes = [_fingerprint(x) + len(x).to_bytes(4, "big") if len(x) else None for x in sets]
            sketches = pa.array([x[:k].astype(np.int64) for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), sketches],
                ["doc_id", "n_shingles", "node", "sketch"],
            )

    return _texts(docs).mapInArrow(run, "doc_id long, n_shingles long, node binary, sketch array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _required(values: Column, k: int, percent: int) -> Column:
    """Overlap that a class's sketch must have with any partner's."""
    whole = F.ceil(values * percent / 100)
    return F.when(values < k, F.least(whole, F.lit(required_overlap(k, percent)))).otherwise(required_overlap(k, percent))


def inverted_lists(classes: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """``value, node, n_shingles, shared``: each class under its rarest sketch values that others have too.

    ``shared`` is how many values of its sketch others have.
    """
    entries = classes.select("node", "n_shingles", F.size("sketch").alias("held"), F.explode("sketch").alias("value"))
    # written, so that the values of common passages can be split in the join
    shared = scratch.keep("shared", entries.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"))
    # Values that no other class has are the rarest: they fill the first places of the order.
    kept = (
        entries.join(shared, "value")
        .groupBy("node", "n_shingles", "held")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("common"))
        .withColumn("room", F.col("held") - _required(F.col("held"), k, percent) + 1 - (F.col("held") - F.size("common")))
        .filter("room > 0")
    )
    listed = kept.select(
        "node",
        "n_shingles",
        F.size("common").alias("shared"),
        F.explode(F.slice("common", F.lit(1), F.col("room").cast("int"))).alias("entry"),
    )
    return listed.select(F.col("entry.value").alias("value"), "node", "n_shingles", "shared")


def _sized(a: str, b: str, percent: int) -> Column:
    """Sets of very different sizes can't be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def plausible(pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose union sketch leaves the similarity possible."""
    left = classes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = classes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    united = F.slice(F.array_sort(F.array_union(F.transform("sketch_a", _unsigned), F.transform("sketch_b", _unsigned))), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect(united, F.transform("sketch_a", _unsigned)), F.transform("sketch_b", _unsigned)))
    least = F.least(
        _required(F.size(united), k, percent), F.ceil(F.size(united) * percent / 100)
    )
    return pairs.join(left, "a").join(right, "b").filter(shared >= least).select("a", "b")


def _unsigned(value: Column) -> Column:
    """Signed order for hashes that are sorted as unsigned ones."""
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough. ``sets`` has ``node`` and the hashes as bytes.

    The partners of ``a`` come past its set in blocks, so a class with very many partners is spread.
    """
    # the class with more partners is the one that stays
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    with_degree = (
        pairs.join(degree.select(F.col("node").alias("a"), F.col("degree").alias("da")), "a")
        .join(degree.select(F.col("node").alias("b"), F.col("degree").alias("db")), "b")
    )
    turned = with_degree.select(
        F.when(F.col("da") >= F.col("db"), F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(F.col("da") >= F.col("db"), F.col("b")).otherwise(F.col("a")).alias("node"),
        F.greatest("da", "db").alias("degree"),
    ).withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("degree") / BLOCK_PARTNERS)))
    partners = turned.join(sets, "node").select("hub", "block", F.lit(1).alias("side"), "node", "hashes")
    hubs = turned.select("hub", "block").distinct().join(sets.withColumnRenamed("node", "hub"), "hub")
    rows = partners.unionByName(hubs.select("hub", "block", F.lit(0).alias("side"), F.col("hub").alias("node"), "hashes"))
    rows = rows.repartition("hub", "block").sortWithinPartitions("hub", "block", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            a, b = [], []
            for hub, side, node, data in zip(*(batch.column(c).to_pylist() for c in ("hub", "side", "node", "hashes"))):
                values = np.frombuffer(data, dtype=np.uint64)
                if side == 0:
                    own = values
                    continue
                small, large = (own, values) if len(own) < len(values) else (values, own)
                if len(small) * 100 < len(large) * percent:
                    continue
                place = np.minimum(np.searchsorted(large, small), max(len(large) - 1, 0))
                common = int((large[place] == small).sum())
                if common * 100 >= percent * (len(own) + len(values) - common):
                    a.append(hub)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return _ordered(rows.mapInArrow(run, "a binary, b binary"))


def full_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """``node, hashes`` of the classes in ``members`` ``(doc_id, node)``, from the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            sets = shingle_sets(texts, size)
            own = [_fingerprint(x) + len(x).to_bytes(4, "big") if len(x) else b"" for x in sets]
            wanted = rows.column("node").to_pylist()
            keep = [i for i, node in enumerate(own) if node == wanted[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own[i] for i in keep], pa.binary()), pa.array([sets[i].tobytes() for i in keep], pa.binary())],
                ["node", "hashes"],
            )

    rows = _texts(docs).join(members, "doc_id").mapInArrow(run, "node binary, hashes binary")
    return rows.groupBy("node").agg(F.first("hashes").alias("hashes"))


def link_classes(docs: DataFrame, classes: DataFrame, scratch: Scratch, k: int, percent: int, size: int) -> DataFrame:
    """``(node, root)`` of the classes that are linked to others."""
    lists = scratch.keep("lists", inverted_lists(classes, k, percent, scratch))
    involved = lists.select("node").distinct()
    members = classes.select("doc_id", "node").join(involved, "node")
    sets = scratch.keep("sets", full_sets(docs, members, size))
    sketches = scratch.keep("sketches", classes.select("node", "sketch").join(involved, "node"))
    roots = None
    for step in range(STAR_ROUNDS + 1):
        placed = lists.withColumn("root", F.col("node"))
        if roots is not None:
            placed = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        open_lists = scratch.keep(
            f"open-{step}",
            placed.groupBy("value")
            .agg(
                F.min("root").alias("least"),
                F.max("root").alias("most"),
                F.max_by(F.struct("node", "root", "n_shingles"), F.struct("shared", "node")).alias("pivot"),
            )
            .filter("least <> most"),
        )
        if open_lists.isEmpty():
            break
        if step < STAR_ROUNDS:
            pairs = placed.join(open_lists, "value").filter(
                (F.col("root") != F.col("pivot.root")) & _sized("n_shingles", "pivot.n_shingles", percent)
            )
            pairs = scratch.keep(f"pairs-{step}", _ordered(pairs.select(F.col("pivot.node").alias("a"), F.col("node").alias("b"))))
            likely = scratch.keep(f"likely-{step}", plausible(few_tasks(pairs, pairs.count()), sketches, k, percent))
            found = verified(few_tasks(likely, likely.count()), sets, percent)
        else:
            members = placed.join(open_lists, "value").select(F.col("pivot.node").alias("hub"), "node", "root").distinct()
            found = left_over(scratch.keep("members", members), sets, percent)
        found = scratch.keep(f"links-{step}", found)
        if not found.isEmpty():
            # groups so far are stars already: only they and the new links are joined
            links = found if roots is None else found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = components(links, scratch, f"roots-{step}")
    if roots is None:
        roots = lists.limit(0).select("node", F.col("node").alias("root"))
    return roots


def left_over(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members ``(hub, node, root)`` of one hub's lists that are in different groups.

    Members outside the hub's largest group meet all members, in pairs of blocks. A task gives one
    link at most for a member and each group that it joins.
    """
    groups = members.groupBy("hub", "root").agg(F.count("*").alias("size"))
    blocks = groups.groupBy("hub").agg(
        F.max_by("root", F.struct("size", "root")).alias("main"),
        F.ceil(F.sum("size") / BLOCK_PARTNERS).cast("int").alias("blocks"),
        F.ceil((F.sum("size") - F.max("size")) / BLOCK_PARTNERS).cast("int").alias("outer_blocks"),
    )
    placed = members.join(blocks.filter("outer_blocks > 0"), "hub")
    own = lambda count: F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    outer = placed.filter("root <> main").select(
        "hub", own("outer_blocks").alias("one"), every("blocks").alias("two"), F.lit(0).alias("side"), "node", "root"
    )
    inner = placed.select(
        "hub", every("outer_blocks").alias("one"), own("blocks").alias("two"), F.lit(1).alias("side"), "node", "root"
    )
    key = ["hub", "one", "two"]
    rows = outer.unionByName(inner).join(sets, "node").repartition(*key).sortWithinPartitions(*key, "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, ([], [])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "side", "node", "root", "hashes")]
            for hub, one, two, side, node, root, data in zip(*columns):
                if (hub, one, two) != current:
                    yield joining_links(*block, percent)
                    current, block = (hub, one, two), ([], [])
                block[side].append((node, root, np.frombuffer(data, dtype=np.uint64)))
        yield joining_links(*block, percent)

    return _ordered(rows.mapInArrow(run, "a binary, b binary"))


def joining_links(left: list, right: list, percent: int) -> pa.RecordBatch:
    """Links ``a, b`` between two blocks of ``(node, root, set)``: for each left row and right root one at most."""
    found: list[tuple[bytes, bytes]] = []
    if left and right:
        common = common_members([x[2] for x in left], [x[2] for x in right])
        a, b = np.array([len(x[2]) for x in left]), np.array([len(x[2]) for x in right])
        near = 100 * common >= percent * (a[:, None] + b[None, :] - common)
        for i, j in zip(*np.nonzero(near)):
            if left[i][1] != right[j][1]:
                found.append((i, j))
        found = list({(i, right[j][1]): (left[i][0], right[j][0]) for i, j in found}.values())
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], ["a", "b"]
    )


def common_members(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, ``width`` values at a time."""
    flat_left, flat_right = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(flat_left, flat_right)
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    place = []
    for sets, flat in ((left, flat_left), (right, flat_right)):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        place.append((owner[hit][order], at[hit][order]))
    for start in range(0, len(shared), width):
        tables = []
        for (owner, at), sets in zip(place, (left, right)):
            a, b = np.searchsorted(at, [start, start + width])
            table = np.zeros((len(sets), min(width, len(shared) - start)), dtype=np.float32)
            table[owner[a:b], at[a:b] - start] = 1
            tables.append(table)
        out += (tables[0] @ tables[1].T).astype(np.int64)
    return out


def near_duplicates(docs: DataFrame, k: int = 48, percent: int = 75, shingle: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs``.

    Two documents are linked if 100 * |A and B| >= ``percent`` * |A or B| for their sets of
    ``shingle``-word shingles; a component is all that links reach, and its smallest id stays. NULL
    texts and texts without words have empty sets and are linked with nothing. Rows with a NULL id
    are no partners: their ``component_id`` is NULL and they stay. Rows that repeat an id and a
    text get the same answer; an id with several texts joins the groups of all of them by text. Extra
    columns are ignored, an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    sketched = scratch.keep("sketched", sketch_documents(docs, k, shingle))
    known = sketched.filter("doc_id IS NOT NULL AND node IS NOT NULL")
    classes = scratch.keep(
        "classes",
        known.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
        ),
    )
    roots = link_classes(docs.filter("doc_id IS NOT NULL"), classes, scratch, k, percent, shingle)
    placed = classes.select("node", F.col("doc_id").alias("first_id")).join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = scratch.keep("groups", placed.join(smallest, "root").select("node", "component_id"))
    scratch.drop("lists", "sets", "sketches", "classes")
    # rows without a set are spread by their ids instead of meeting under NULL
    spread = F.coalesce("node", F.xxhash64("doc_id").cast("string").cast("binary")).alias("node")
    answer = (
        sketched.select("doc_id", "n_shingles", spread)
        .join(groups, "node", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    )
    return answer.select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
