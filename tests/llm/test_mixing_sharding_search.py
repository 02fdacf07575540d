import heapq
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import ann, mixing, sharding


def brute_targets(sizes, weights=(1, 2, 3), repeats=3):
    """Reshare the excess by weight, again and again, until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > repeats * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **share}
        fixed |= {s: repeats * sizes[s] for s in over}


def test_targets_stop_at_the_cap(spark):
    sizes = {"a": 1000, "b": 10, "c": 20, "d": 500, "ä": 3, None: 7, "z": 0}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    expected = brute_targets(sizes)
    assert got.keys() == expected.keys()
    assert all(abs(got[s] - expected[s]) < 1e-5 for s in sizes)
    assert abs(sum(got.values()) - sum(sizes.values())) < 1e-3


def test_mix_comes_near_its_targets(make_docs):
    rows = [(i, "w " * (i % 50), "abc"[i % 3] if i % 10 else None) for i in range(900)] + [(5000 + i, "w " * 20, "small") for i in range(9)]
    docs = make_docs(rows)
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(rows)
    by_target = {}
    for r in out:
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        by_target.setdefault(r["target"], []).append(r["taken"])
    total = sum(r["size"] for r in out)
    assert total - 50 <= sum(r["taken"] for r in out) <= total
    for target, taken in by_target.items():
        assert abs(sum(taken) - target) <= 100
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix_sources(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in out}


def test_mix_of_odd_rows(odd_docs, make_docs):
    out = mixing.mix_sources(odd_docs).collect()
    assert len(out) == 11
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert mixing.mix_sources(make_docs([])).count() == 0
    assert {r["taken"] for r in mixing.mix_sources(make_docs([(1, ""), (2, None)])).collect()} == {0}


def test_rows_without_an_id_are_cut_into_buckets_in_the_same_order(spark, make_docs):
    rows = [(None, "w " * (i % 5 + 1), "a") for i in range(2000)] + [(i, "w " * (i % 7), "a") for i in range(500)]
    docs = make_docs(rows)
    sized = docs.select(
        "doc_id", "source", mixing.word_count().alias("size"), mixing.shuffle_key().alias("key"),
        F.pmod(F.monotonically_increasing_id(), F.lit(mixing.SPREAD)).cast("int").alias("spread"),
    )
    found = mixing.with_buckets(sized, 2).collect()
    held = {}
    for r in found:
        held[r["bucket"]] = held.get(r["bucket"], 0) + 1
    assert max(held.values()) <= 40
    shown = lambda r: (r["key"], r["doc_id"] is not None, r["doc_id"] or 0, r["size"])
    in_buckets = sorted(found, key=lambda r: (tuple(r["bucket"]), shown(r)))
    assert [shown(r) for r in in_buckets] == sorted(map(shown, found))
    # finish times are running sums in that order
    got = sorted((r["finish"], r["size"]) for r in mixing.mix_sources(docs).filter("size > 0").collect())
    sent, target = 0, mixing.mix_sources(docs).first()["target"]
    for (finish, size), row in zip(got, [r for r in in_buckets if r["size"]]):
        sent += row["size"]
        assert size == row["size"] and abs(finish * target - sent) < 1e-6


def test_mixed_documents_repeat_rows(make_docs, odd_docs):
    docs = make_docs([(i, "w " * 30, "a") for i in range(60)] + [(100 + i, "v " * 5, "b") for i in range(4)])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    expected = {r["doc_id"]: r["repeats"] for r in mixing.mix_sources(docs).collect() if r["repeats"]}
    assert counts == expected and max(counts.values()) == 3
    odd = mixing.mix_sources(odd_docs).agg(F.sum("repeats")).first()[0]
    assert mixing.mixed_documents(odd_docs).count() == odd


def fair_queue(docs, **parameters):
    """Ids in the order of a heap-based weighted fair queue, from shuffled sources and their targets."""
    sources = {}
    for r in mixing.mix_sources(docs, **parameters).filter("size > 0 AND target > 0").collect():
        sources.setdefault(r["turn"], []).append(r)
    heap, queues = [], {}
    for turn, rows in sources.items():
        rows.sort(key=lambda r: r["sent"])
        queues[turn] = [((r["sent"] + r["source_size"] * e) / r["target"], r) for e in range(3) for r in rows]
        heapq.heappush(heap, (queues[turn][0][0], turn, 0))
    budget = sum(r["size"] for rows in sources.values() for r in rows)
    out = []
    while heap:
        finish, turn, at = heapq.heappop(heap)
        row = queues[turn][at][1]
        if row["size"] > budget:
            break
        budget -= row["size"]
        out.append(row["doc_id"])
        if at + 1 < len(queues[turn]):
            heapq.heappush(heap, (queues[turn][at + 1][0], turn, at + 1))
    return out


def test_mixed_documents_come_in_the_order_of_a_fair_queue(make_docs):
    sizes = {"a": (600, 30), "b": (30, 5), "c": (250, 12), None: (20, 1)}
    rows = [(i, "w " * (size + i % 3), source) for source, (n, size) in sizes.items() for i in range(n)]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    docs = make_docs(rows)
    found = [r["doc_id"] for r in mixing.mixed_documents(docs).collect()]
    assert found == fair_queue(docs) and len(found) > 900 and len(set(found)) < len(found)


def test_rows_without_ids_and_equal_rows_are_given_out_as_taken(make_docs):
    docs = make_docs([(None, f"w{i} " * 4, "a") for i in range(300)] + [(None, "same text", "b")] * 40 + [(7, "x y z", "c")] * 3)
    # which of the equally large rows without an id are taken is open, how many of a source is not
    mixed = {r["source"]: r["count"] for r in mixing.mixed_documents(docs).groupBy("source").count().collect()}
    marks = {"of": F.col("source")}
    taken = mixing.mix_sources(docs, carried=marks).groupBy("of").agg(F.sum("repeats").alias("n")).collect()
    assert mixed == {r["of"]: r["n"] for r in taken}
    texts = mixing.mixed_documents(docs).groupBy("text").count().collect()
    assert all(r["count"] <= 3 for r in texts if r["text"].startswith("w")) and max(r["count"] for r in texts) > 40


def test_mixing_and_sharding_run_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (mixing.mix_sources(docs), mixing.mixed_documents(docs), sharding.shard_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def check_shards(rows, docs, shards, tolerance):
    total = sum(r["size"] for r in rows)
    sizes, slots, of_text = [0] * shards, {}, {}
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        of_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(abs(s - total / shards) <= 2 * tolerance * total / shards + 1 for s in sizes), sizes
    return of_text


def test_shards_are_even_and_keep_groups(make_docs):
    rows = [(i, f"text {i} " + "x" * (i % 90)) for i in range(6000)] + [(10_000 + i, "a copy") for i in range(40)]
    docs = make_docs(rows)
    out = sharding.shard_documents(docs, 8, 0.05).collect()
    assert len(out) == len(rows)
    of_text = check_shards(out, rows, 8, 0.05)
    assert max(map(len, of_text.values())) == 1
    texts = dict(rows)
    for r in out:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 8
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None


def test_a_group_larger_than_a_shard_is_split(make_docs):
    rows = [(i, "the same text") for i in range(3000)] + [(5000 + i, f"t{i}") for i in range(3000)]
    out = sharding.shard_documents(make_docs(rows), 8, 0.01).collect()
    of_text = check_shards(out, rows, 8, 0.02)
    assert len(of_text[zlib.crc32(b"the same text")]) > 1


@pytest.mark.parametrize("shards", [8, 24])
def test_repeated_rows_are_cut_between_shards(make_docs, shards):
    """Thousands of rows that agree in id and text, and thousands without an id."""
    rows = [(5, "one text for all of them")] * 3000 + [(None, "no id at all")] * 3000 + [(100 + i, f"text {i} " * 2) for i in range(3000)]
    out = sharding.shard_documents(make_docs(rows), shards, 0.01).collect()
    sizes, slots = {}, {}
    for r in out:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    fair = sum(sizes.values()) / shards
    assert len(out) == 9000 and len(sizes) == shards
    assert all(abs(s - fair) <= 0.02 * fair + 50 for s in sizes.values()), sizes
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_of_odd_rows(odd_docs, make_docs):
    out = sharding.shard_documents(odd_docs).collect()
    assert len(out) == 11
    assert {r["size"] for r in out if r["doc_id"] in (2, 3)} == {8}
    assert sharding.shard_documents(make_docs([])).count() == 0


def test_written_shards_hold_the_rows(make_docs, spark, tmp_path):
    docs = make_docs([(i, f"text {i}") for i in range(500)]).drop("shard")
    sharding.write_shards(docs, str(tmp_path / "out"), 4, 0.1)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and back.select("shard").distinct().count() == 4


VECTORS = "vec_id long, embedding array<float>, score int, part int"


def make_vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1) for i, v in rows], VECTORS)


def test_search_by_brute_force(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 16)) * 2
    x = (centres[rng.integers(0, 6, 3000)] + rng.normal(size=(3000, 16))).astype(np.float32)
    x[10] = x[11] = x[12]
    vectors = make_vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    got = {}
    for r in ann.search(vectors, vectors.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    exact = x.astype(float) @ x.astype(float).T
    found = 0
    for q in range(0, 3000, 20):
        own = got[q]
        assert sorted(own) == list(range(1, 21)) and all(v != q for v, _ in own.values())
        assert all(abs(s - exact[q, v]) < 1e-9 for v, s in own.values())
        order = [(-s, v) for _, (v, s) in sorted(own.items())]
        assert order == sorted(order)
        scores = exact[q].copy()
        scores[q] = -np.inf
        found += len({v for v, _ in own.values()} & set(np.argsort(-scores)[:20].tolist()))
    assert found / (150 * 20) >= 0.9


def test_search_leaves_out_what_is_no_vector(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (10, [1.0, 1.0]), (11, [1.0, 1.0])]
    vectors = make_vectors(spark, rows)
    got = sorted(tuple(r) for r in ann.search(vectors, vectors.filter("vec_id % 20 = 0"), 20).collect())
    assert got == [(0, 1, 10, 1.0), (0, 2, 11, 1.0), (0, 3, 20, 0.0), (20, 1, 10, 1.0), (20, 2, 11, 1.0), (20, 3, 0, 0.0)]
    assert ann.search(vectors.limit(0), vectors.limit(0), 20).count() == 0
    assert ann.search(vectors, vectors.filter("vec_id = 3"), 20).count() == 0


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 8)) + 4 * rng.normal(size=(4, 8))[rng.integers(0, 4, 800)]
    graph = ann.neighbour_graph(x, 10)
    label = ann.balanced_parts(x, graph, 4)
    assert np.bincount(label).max() - np.bincount(label).min() <= 2
    inside = (label[graph] == label[:, None]).mean()
    assert inside > 0.45
