import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import graph, minhash, substrings
from demandloom.llm import textbytes as tb
from demandloom.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_groups(rows):
    """Component and set size by doc_id, comparing all pairs."""
    sets = {}
    for d, text in rows:
        words = WORD.findall(lower(text or ""))
        sets[d] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_corpus(seed=2):
    """Chains of edits, groups of near copies, passages in common, short and equal texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 6)))
    rows, passage = [], [word() for _ in range(60)]
    for group in range(14):
        base = [word() for _ in range(rng.choice([3, 6, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 8, 25])):
            own = list(base)
            for _ in range(rng.randrange(0, max(1, len(own) // 25) + 1)):
                own[rng.randrange(len(own))] = word()
            rows.append(own)
            if rng.random() < 0.3:
                base = own
    for _ in range(40):  # dominated by one passage, similar or not
        rows.append(passage + [word() for _ in range(rng.choice([2, 10, 20, 40]))])
    rng.shuffle(rows)
    return [(i * 3 + 1, " ".join(w).title() if i % 7 == 0 else " ".join(w)) for i, w in enumerate(rows)]


def test_near_duplicates_by_brute_force(make_docs):
    rows = near_corpus() + [(9001, ""), (9002, None), (9003, " \t"), (9004, "a b"), (9005, "A\nB")]
    expected = brute_groups(rows)
    got = minhash.near_duplicates(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_pairs_left_over_after_stars_are_tried(make_docs, monkeypatch):
    rows = near_corpus(5)
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 0)
    monkeypatch.setattr(minhash, "BLOCK_PARTNERS", 4)
    got = minhash.near_duplicates(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_groups(rows)


def test_near_duplicates_of_odd_rows(odd_docs, make_docs, by_id):
    rows = by_id(minhash.near_duplicates(odd_docs))
    assert len(rows) == 11
    found = {r["doc_id"]: r for r in rows}
    assert found[6]["component_id"] == 5 and not found[6]["kept"]
    assert found[8]["component_id"] == 7
    assert found[None]["component_id"] is None and found[None]["kept"]
    assert [found[i]["n_shingles"] for i in (2, 3, 4)] == [0, 0, 0]
    assert minhash.near_duplicates(make_docs([])).count() == 0


def test_intersections_of_blocks():
    rng = np.random.default_rng(3)
    left = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (0, 5, 100, 400)]
    right = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (7, 250)]
    for width in (16, 4096):
        got = minhash.common_members(left, right, width)
        assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_required_overlap_is_safe_and_useful():
    x = minhash.required_overlap(48, 75)
    assert 10 <= x <= 24
    rng = np.random.default_rng(1)
    assert (rng.binomial(48, 0.75, 200_000) >= x).all()


def test_components_of_chain_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(links, Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202)}}
    assert graph.components(links.limit(0), Scratch(spark, "t")).count() == 0


def brute_removal(rows, size=13):
    seen, out = {}, {}
    for d, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - size + 1):
            if seen.setdefault(tuple(words[i : i + size]), d) < d:
                gone.update(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[d] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substrings_by_brute_force(make_docs):
    rng = random.Random(4)
    passages = [[f"p{k}x{i}" for i in range(n)] for k, n in enumerate((12, 13, 14, 40, 200))]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += [f"u{rng.randrange(30)}" for _ in range(rng.randrange(0, 30))]
            p = rng.choice(passages)
            words += p[rng.randrange(0, 3) :]
        rows.append((i * 2, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(200, rows[0][1]), (201, None), (202, ""), (203, "é " * 13), (204, "é " * 13), (205, "w " * 40)]
    got = substrings.without_repeats(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_removal(rows)


def test_substrings_of_odd_rows(odd_docs, make_docs, by_id):
    found = {r["doc_id"]: r for r in by_id(substrings.without_repeats(odd_docs))}
    assert found[6]["n_removed"] == found[6]["n_words"] == 30_000
    assert found[5]["n_removed"] == 0 and found[1]["n_removed"] == 0 and found[None]["n_removed"] == 0
    assert substrings.without_repeats(make_docs([])).count() == 0


def test_stripping_keeps_columns_and_whole_texts(odd_docs):
    out = substrings.strip_repeats(odd_docs)
    assert out.columns == odd_docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[6]["text"] == "" and rows[6]["n_chars"] == 0
    assert rows[4]["text"] == " \n\t " and rows[2]["text"] is None and rows[2]["n_chars"] is None


@pytest.mark.parametrize("longest, lengths", [(None, {13, 26, 52, 104}), (30, {13, 26})])
def test_doubling_goes_on_until_none_survives(make_docs, spark, longest, lengths):
    shared = " ".join(f"s{i}" for i in range(110))
    docs = make_docs([(1, "a b " + shared), (2, shared + " c d"), (3, "other " + " ".join(f"s{i}" for i in range(20)))])
    scratch = Scratch(spark, "t")
    windows = substrings.repeated_windows(docs.select("doc_id", "text"), 13, scratch)
    found = substrings.extend(windows, 13, scratch, longest).groupBy("length").agg(F.count("*").alias("n")).collect()
    assert {r["length"] for r in found} == lengths
    counts = {r["length"]: r["n"] for r in found}
    assert counts[26] == 2 * (110 - 25)


def test_representatives_cover_each_window():
    words = tb.find_words([b" ".join(b"%d" % (i * 7 % 11) for i in range(100)), b"a b c", b" ".join([b"x"] * 30)])
    hashes = tb.Hasher(words.data)(words.starts, words.ends)
    starts, place = substrings.representatives(hashes, words.doc, 13)
    assert len(starts) == 88 + 18
    assert ((place >= starts) & (place <= starts + 6)).all()
