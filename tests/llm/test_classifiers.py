import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandloom.llm import quality, toxicity, url_filter
from demandloom.llm.labels import training_labels

LABELS = "doc_id long, quality int, toxic int"


def test_statistics_see_a_broken_part_of_a_long_text():
    fine = " ".join(f"word{i}" for i in range(2000)).encode()
    broken = fine + b" " + b" ".join([b"SAME!!"] * 60)
    a, b = quality.statistics([fine, broken])
    names = list(quality.STATISTICS)
    for name in ("worst_upper", "worst_symbol", "worst_repeat"):
        assert b[names.index(name)] > a[names.index(name)] + 0.5


def test_statistics_of_empty_texts_are_finite():
    assert np.isfinite(quality.statistics([b"", b"   ", b"x"])).all()


def test_discriminant_equals_plain_formula():
    rng = np.random.default_rng(3)
    d = len(quality.STATISTICS)
    means = rng.normal(size=(2, d))
    factors = np.array([np.linalg.cholesky(np.eye(d) * (k + 1) + 0.1) for k in (0, 1)])
    model = quality.Model(means, factors, np.log([0.3, 0.7]), 1.0)
    x = rng.normal(size=(5, d))
    logs = []
    for k in (0, 1):
        cov = factors[k] @ factors[k].T
        diff = x - means[k]
        logs.append(
            np.log([0.3, 0.7][k])
            - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
            - 0.5 * np.linalg.slogdet(cov)[1]
        )
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


@pytest.mark.parametrize("which", [quality, toxicity])
def test_odd_rows_are_scored(spark, odd_docs, by_id, which):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (None, 1, 1), (9, None, None), (8, 0, 1), (8, 1, 0)], LABELS)
    rows = by_id(which.classify(odd_docs, labels))
    assert len(rows) == 11
    assert all(0 <= r["score"] <= 1 for r in rows)
    folds, fold = (4, 2) if which is quality else (5, 0)
    for r in rows:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % folds == fold
        assert r["held_out"] == held
    assert rows[0]["score"] == rows[1]["score"]


@pytest.mark.parametrize("which", [quality, toxicity])
def test_no_labels_and_no_rows(spark, odd_docs, which):
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in which.classify(odd_docs, none).collect()} == {0.5}
    assert which.classify(odd_docs.limit(0), none).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    for which, label, least in ((quality, "quality", 0.95), (toxicity, "toxic", 0.85)):
        judged = which.classify(docs, labels).join(labels, "doc_id").filter("held_out")
        right = judged.groupBy(label).agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).collect()
        assert len(right) == 2
        assert all(r[1] > least for r in right), (label, right)


def test_swaps_stay_in_their_kind():
    assert toxicity.swapped("the Muslim women", 0) == "the religious people"
    assert toxicity.swapped("nobody here", 1) is None
    assert toxicity.swapped("a gay man", 1).split()[1] in toxicity.IDENTITY_TERMS["trait"]


def test_texts_without_a_mention_get_every_term_in_turn(spark, make_docs):
    docs = make_docs([(i, f"a text number {i} of no one") for i in range(200)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], LABELS)
    sample = toxicity.training_sample(docs, labels.selectExpr("doc_id", "toxic AS label"), (200, 200))
    marks = sample.column("label").to_pylist()
    assert marks.count(None) == 200 * toxicity.MENTIONS
    assert all(not g for m, g in zip(marks, sample.column("gone").to_pylist()) if m is None)
    seen = {x for m, xs in zip(marks, sample.column("features").to_pylist()) if m is None for x in xs}
    for term in toxicity.TERMS:
        _, own = toxicity.features([term.encode()])
        assert set(own.astype(np.int64).tolist()) <= seen
    assert toxicity.with_mentions("", 3) and all(t.strip() for t in toxicity.with_mentions("", 3))


def test_mentions_move_no_score_at_the_operators_own_settings(spark):
    """On the given tables, whose texts mention nobody: each term in each of a hundred clean texts."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    sample = toxicity.training_sample(docs.select("doc_id", "text"), training_labels(labels, "toxic", 5, 0), (6000, 3000))
    model = toxicity.fit(sample)
    clean = docs.join(labels.filter("toxic = 0 AND quality = 1"), "doc_id").orderBy("doc_id").limit(100).select("text").collect()
    for i, term in enumerate(toxicity.TERMS):
        text = clean[i % 100]["text"]
        before, after = model.score([text.encode(), f"{text} {term}".encode()])
        assert abs(after - before) < 0.02 and (after < 0.5 or before >= 0.5)


def _sample(rows):
    return pa.Table.from_batches(
        [toxicity.sample_batch(list(range(len(rows))), [label for _, label in rows], [t.encode() for t, _ in rows])]
    )


def test_counterfactual_penalty_keeps_neutral_mentions_clean():
    # in the labels, a group is mentioned mostly in toxic texts
    rows = [(f"those muslim idiots said{i}", 1) for i in range(60)] + [(f"a quiet day of walking{i}", 0) for i in range(100)]
    rows += [(f"what idiots they were{i}", 1) for i in range(20)]
    plain = toxicity.fit(_sample(rows), fairness=0.0)
    fair = toxicity.fit(_sample(rows), fairness=5.0)
    mention, without = b"my muslim neighbour bakes bread", b"my neighbour bakes bread"

    def change(model):
        with_it, without_it = model.score([mention, without])
        return with_it - without_it

    assert change(plain) > 0.1
    assert abs(change(fair)) < 0.03
    assert fair.score([b"they are idiots"])[0] > 0.5


def test_url_parts_and_rules(spark):
    rows = [
        (1, "http://A.B.ORG/es/x?q#f"), (2, "https://x.example.org/es/1"), (3, "https://example.org/en/12"),
        (4, "https://org/"), (5, "http://net.com/de/"), (6, "no scheme"), (7, None), (8, "http://Xorg?y=/fr/"),
        (9, "ftp://h.com/fr/a://b"), (10, "x://"), (11, ""), (1, "http://A.B.ORG/es/x?q#f"),
    ]
    pages = spark.createDataFrame([(i, u, "h", "v", 1.0) for i, u in rows], "page_id long, url string, host string, verdict string, label double")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.b.org", "/es/x", "org/", "allow")
    assert (got[2]["rule"], got[2]["verdict"]) == ("example.org/es/", "block")
    assert (got[3]["rule"], got[3]["verdict"]) == ("example.org/en/1", "block")
    assert got[4]["rule"] == "org/"
    assert (got[5]["rule"], got[5]["verdict"]) == ("com/de/", "block")
    for i in (6, 7, 10, 11):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == ("", "", None)
        assert got[i]["verdict"] in ("allow", "block")
    assert (got[8]["host"], got[8]["path"], got[8]["rule"]) == ("xorg", "", None)
    assert (got[9]["host"], got[9]["path"], got[9]["rule"]) == ("h.com", "/fr/a://b", "com/fr/")


def test_url_model_learns_and_takes_no_rows(spark):
    pages = spark.createDataFrame(
        [(1, "http://super-casino.test/win"), (2, "http://village-library.test/books"), (3, "http://mega-pills.test/order")],
        "page_id long, url string",
    )
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "block"}
    none = spark.createDataFrame([], "url string, label int")
    assert set(url_filter.train(none)) == {0.0}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_url_filter_runs_no_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = url_filter.judge_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
