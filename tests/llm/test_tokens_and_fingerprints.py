import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from demandloom.llm import bpe, imatch
from demandloom.llm.queries import public_tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return public_tokenizer()


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact(coder):
    ranks = bpe.read_ranks(VOCABULARY)
    assert coder.table.size == len(ranks) == len([t for t in coder.table.tokens if t is not None])
    assert all(coder.table.get(t) == r for t, r in ranks.items())
    assert coder.table.get(b"no such token at all") == -1


def test_encoding_equals_the_library(coder, library):
    rng = random.Random(5)
    alphabets = ["abcdefgh ", "Tt'sre llve ", " \t\n\r\x0b\x0c\x85\u00a0\u2028\u3000x", "äöüßéñ東京🙂ـעब 1२½", "".join(map(chr, range(1, 128)))]
    texts = ["", " ", "a" * 3000, "x" * 500 + " " * 500, "<|endoftext|>", "\x00"]
    texts += ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60))) for _ in range(1500)]
    for text in texts:
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text), repr(text)
        assert coder.decode(ids) == text.encode()
        assert coder.decode_joined(coder.encode_joined(text)) == text.encode()


def test_memo_and_pairs_stay_bounded(coder):
    memo = bpe._Memo(coder, limit=10)
    for i in range(100):
        assert memo[f"tok{i}"] == coder.piece(f"tok{i}")
    assert len(memo) <= 10 and len(memo.old) <= 10


def test_digests_of_odd_rows(spark, odd_docs, by_id, coder, library):
    rows = by_id(bpe.token_digests(odd_docs, coder))
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    assert len(rows) == 11
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert bpe.token_digests(odd_docs.limit(0), coder).count() == 0


def test_ids_round_trip_as_tables(odd_docs, coder):
    back = bpe.decode_documents(bpe.encode_documents(odd_docs, coder), coder)
    texts = sorted((r["text"] or "").encode() for r in odd_docs.collect())
    assert sorted(bytes(r["bytes"]) for r in back.collect()) == texts


def test_edits_by_brute_force(odd_docs, by_id):
    rows = by_id(imatch.compare_with_edits(odd_docs))
    source = sorted({(r["doc_id"], r["text"] or "") for r in odd_docs.collect() if r["doc_id"] is not None})
    following = {d: source[(i + 1) % len(source)][1] for i, (d, _) in enumerate(source)}
    assert len(rows) == 11
    texts = dict(source)
    for r in rows:
        text = texts.get(r["doc_id"], "a text without an id")
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following.get(r["doc_id"], "")[:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    prints = {}
    for r in rows:
        prints.setdefault(texts.get(r["doc_id"], ""), set()).add(r["fingerprint"])
    assert all(len(p) == 1 for t, p in prints.items() if t)
    five = next(r for r in rows if r["doc_id"] == 5)
    assert five["near_next"] == 1.0  # document 6 has the same text


def test_single_document_and_no_rows(make_docs):
    one = imatch.compare_with_edits(make_docs([(3, "some words to keep here")])).collect()
    assert one[0]["near_next"] == 1.0
    assert imatch.compare_with_edits(make_docs([])).count() == 0


def test_edited_texts_are_nearer_than_other_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = imatch.compare_with_edits(docs).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)


def test_lexicon_keeps_the_band(spark, make_docs):
    docs = make_docs([(i, f"common rare{i} half{i % 2}") for i in range(40)])
    lexicon = imatch.build_lexicon(docs, 0.1, 0.6)
    _, wanted = imatch.document_terms([b"half0 half1"])
    assert set(lexicon.terms.tolist()) == set(wanted.tolist())


def test_every_term_of_the_lexicon_is_in_a_subset():
    lexicon = imatch.Lexicon(np.arange(1, 20_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert lexicon.member.any(axis=1).all()
    sizes = lexicon.member.sum(axis=0).reshape(-1, len(imatch.CHANCES)).sum(axis=0)
    assert (sizes[:-1] > 1.3 * sizes[1:]).all()  # large subsets stay larger than small ones


def test_texts_without_a_term_of_the_lexicon_are_compared_by_terms(make_docs):
    # in more than a twentieth of the documents, so in no band
    rows = [(i, "common words") for i in range(30)] + [(100, "alpha beta"), (101, "gamma delta"), (102, "delta, gamma!")]
    rows += [(200 + i, ("alpha beta ", "gamma delta ")[i % 2] + f"rare{i}") for i in range(30)]
    docs = make_docs(rows)
    got = {r["doc_id"]: r for r in imatch.compare_with_edits(docs).collect()}
    prints = [got[i]["fingerprint"] for i in (29, 100, 101, 102)]
    assert len(set(prints)) == 3 and prints[2] == prints[3]
    assert all(p.endswith(imatch.EMPTY * (imatch.PARTS - imatch.WHOLE_PARTS)) and p[0] == "0" for p in prints)
    # likeness follows from the fingerprints alone
    for r in got.values():
        assert r["near_edited"] == imatch.likeness(r["fingerprint"], r["edited_fingerprint"])
    assert got[0]["near_next"] == 1.0
    assert got[29]["near_next"] == got[100]["near_next"] == 0.0
    assert got[101]["near_next"] == 1.0


def test_fingerprints_equal_plain_python(spark):
    """Terms, parts and weights once more, word by word, on whole texts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.select("doc_id", "text").collect()}
    lexicon = imatch.build_lexicon(docs)
    place = {int(t): i for i, t in enumerate(lexicon.terms)}

    def terms_of(text):
        words = {w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text)}
        data = b" ".join(sorted(words))
        return {int(imatch.document_terms([w])[1][0]) for w in words} if data else set()

    def plain_print(text):
        terms = sorted(terms_of(text))
        parts = []
        for j in range(imatch.PARTS):
            own = [t for t in terms if t in place and lexicon.member[place[t], j]]
            digest = hashlib.blake2b(b"".join(t.to_bytes(8, "little") for t in own), digest_size=3).digest()
            parts.append(imatch.DIGITS[min(len(own), 63)] + base64.b64encode(digest).decode() if own else imatch.EMPTY)
        if terms and set(parts) == {imatch.EMPTY}:
            whole = hashlib.blake2b(b"".join(t.to_bytes(8, "little") for t in terms), digest_size=12).digest()
            parts[:4] = ["0" + base64.b64encode(whole[k : k + 3]).decode() for k in (0, 3, 6, 9)]
        return parts

    def plain_likeness(a, b):
        if a == b:
            return 1.0
        counts = [max(imatch.DIGITS.index(x[0]), imatch.DIGITS.index(y[0])) for x, y in zip(a, b)]
        total = sum(1 / n**2 for n in counts if n)
        return sum(1 / n**2 for n, x, y in zip(counts, a, b) if n and x == y) / total if total else 0.0

    order = sorted(texts)
    for r in imatch.compare_with_edits(docs).collect():
        own, after = plain_print(texts[r["doc_id"]]), texts[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        assert r["fingerprint"] == "".join(own)
        edited = imatch.edited_text(texts[r["doc_id"]].decode(), after.decode()).encode()
        assert r["edited_fingerprint"] == "".join(plain_print(edited))
        assert r["near_next"] == pytest.approx(plain_likeness(own, plain_print(after)))
        assert r["near_edited"] == pytest.approx(plain_likeness(own, plain_print(edited)))


def test_rows_of_a_repeated_id_are_spread_and_find_the_next_text(spark, make_docs, monkeypatch):
    monkeypatch.setattr(imatch, "LEAST_REPEATS", 20)
    rows = [(5, f"word{i % 90} other text {i % 7}") for i in range(300)] + [(9, f"last {i} of all texts") for i in range(200)]
    rows += [(i, f"single {i} with some text") for i in (1, 2, 6, 7)] + [(None, "no id at all")] * 3
    docs = make_docs(rows)
    hot = imatch.repeated_ids(docs)
    assert [(r.doc_id, r.following) for r in hot] == [(5, 6), (9, 1)] and all(r.salts >= 4 for r in hot)
    placed = imatch.in_ranges(docs, imatch.range_starts(docs), hot)
    assert placed.filter("shown").count() == len(rows)
    assert placed.groupBy("part").count().agg({"count": "max"}).first()[0] <= 100
    firsts = {}
    for d, t in rows:
        if d is not None:
            firsts[d] = min(t, firsts.get(d, t))
    order = sorted(firsts)
    following = {d: firsts[order[(i + 1) % len(order)]] for i, d in enumerate(order)}
    expected = []
    for d, t in rows:
        cut = len(t) // 4
        expected.append((str(d), hashlib.sha256((t[: len(t) - cut] + following.get(d, "")[:cut]).encode()).hexdigest()))
    got = [(str(r["doc_id"]), r["edited_sha256"]) for r in imatch.compare_with_edits(docs).collect()]
    assert sorted(got) == sorted(expected)


def test_no_row_waits_for_the_next_id():
    """Two texts are held, however many rows an id has: each row comes out before the next one is read."""
    taken = []

    def batches():
        for i in range(50):
            taken.append(i)
            yield pa.RecordBatch.from_pydict({"part": [0], "copy": [0], "doc_id": [3], "shown": [True], "text": [f"t{i:02}"]})

    stream = imatch.with_next(batches())
    assert next(stream)[:2] == (3, b"t00") and len(taken) == 1
