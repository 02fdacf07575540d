import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from demandloom.llm import queries
from .test_duplicates import WORD, brute_groups
from .test_mixing_sharding_search import fair_queue

FOLDER = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each, written as ``run`` does, and the last result."""
    from demandloom.llm.scratch import Scratch

    scratch = Scratch(spark, "pipeline-test")
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs.append(scratch.keep(f"stage-{i}", stage(spark, docs[-1], FOLDER)))
    return [*docs, corpus_pipeline.STAGES[-1][1](spark, docs[-1], FOLDER)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_keep_the_columns_of_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_quality_stage_keeps_good_documents_whole_and_rejects_bad_ones(spark, stages):
    """Rows stay as they are; the labels, most of which it did not learn from in this order, tell who goes."""
    before, after = rows_of(stages[0]), rows_of(stages[1])
    assert not Counter(after) - Counter(before)
    kept = {r[0] for r in after}
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good, bad = ([d for d, q in marks.items() if q == value] for value in (1, 0))
    assert sum(d in kept for d in good) >= 0.97 * len(good) and sum(d in kept for d in bad) <= 0.1 * len(bad)


def test_near_duplicate_stage_keeps_the_smallest_of_each_brute_force_group(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    groups = brute_groups(rows)
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(d for d, (_, root) in groups.items() if d == root)
    assert not Counter(rows_of(stages[2])) - Counter(rows_of(stages[1]))


def test_substring_stage_removes_what_plain_python_removes(stages):
    seen, expected = {}, {}
    for d, text in sorted((r["doc_id"], r["text"]) for r in stages[2].collect()):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - 12):
            if seen.setdefault(tuple(words[i : i + 13]), d) < d:
                gone.update(range(i, i + 13))
        expected[d] = text if not gone else " ".join(w for i, w in enumerate(words) if i not in gone)
    found = {r["doc_id"]: r for r in stages[3].collect()}
    assert {d: r["text"] for d, r in found.items()} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_mixing_stage_is_a_fair_queue_over_the_sources(stages):
    found = [r["doc_id"] for r in stages[4].collect()]
    assert found == fair_queue(stages[3])
    texts = {r["doc_id"]: tuple(r) for r in stages[3].collect()}
    assert all(tuple(r) == texts[r["doc_id"]] for r in stages[4].collect())


def test_token_stage_equals_the_library(stages):
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for r in stages[4].collect():
        ids = library.encode_ordinary(r["text"] or "")
        digest = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (r["text"] or "").encode())]
        expected[(r["doc_id"], len(ids), *digest)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in stages[5].collect()) == expected


def test_run_is_the_stages_in_their_order(spark, stages):
    names = ["quality", "near-dedup", "substring", "mixing", "BPE"]
    assert all(re.search(n, name) for n, (name, _) in zip(names, corpus_pipeline.STAGES))
    assert rows_of(corpus_pipeline.run(spark, FOLDER)) == rows_of(stages[5])


@pytest.fixture
def odd(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    words = " ".join(f"w{i}" for i in range(40))
    rows = [
        (None, words + " no id", "en", "a", 5), (None, words + " no id", "en", "a", 5), (None, None, None, None, None),
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \n ", None, "b", 3), (4, words, "en", "b", 9),
        (4, words, "en", "b", 9), (5, words + " x", "de", "c", 9), (6, "long " * 50_000, "en", "c", 250_000), (7, "É 🙂", "en", "c", 3),
    ]
    return spark.createDataFrame(rows, schema)


def test_odd_rows_go_through_all_stages(spark, odd):
    docs, counts = odd, [odd.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        counts.append(docs.count())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == counts[-1]
    assert counts[2] <= counts[1] <= counts[0] and counts[3] == counts[2]


def test_an_empty_table_goes_through_all_stages(spark, odd):
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.registered())
    assert numbers == list(range(1, 14))
