import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract
from conftest import SMALL
from demandloom.llm import ball_codes, language_id, phrases
from demandloom.verification.check import compare, duckdb_tables

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


# --- phrases ------------------------------------------------------------------------------


def plain_phrases(rows, longest=3, least=10, percent=50, best=2000):
    """The contract in plain Python, over (text, lang)."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = set()
    for lang, f in counts.items():
        found = []
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {
            p[i:j]
            for p, a in kept.items()
            for i in range(len(p))
            for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= percent * f[p[i:j]]
        }
        for p, a in kept.items():
            if p not in covered:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, l, r = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:best], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return out


def mined(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def phrase_rows(seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "é", "x y", "ß", "-", "東京"]
    gaps = [" ", "  ", "\t", ", ", ".", "\n", "\x0b", "! "]
    rows = []
    for i in range(160):
        text = "".join(rng.choice(words) + rng.choice(gaps[:1] * 6 + gaps) for _ in range(rng.randrange(0, 60)))
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", "de"), (" \t\n.", None), ("one two three " * 3000, "xx"), ("one two three", "xx")] * 2


@pytest.fixture
def phrase_docs(spark):
    def build(rows, columns="text string, lang string"):
        return spark.createDataFrame(rows, columns)

    return build


@pytest.mark.parametrize("longest, least, best", [(3, 10, 2000), (2, 3, 5), (4, 2, 7)])
def test_phrases_equal_plain_counting(phrase_docs, longest, least, best):
    rows = phrase_rows()
    found = mined(phrases.mine_phrases(phrase_docs(rows).repartition(3), longest, least, best=best))
    assert found == plain_phrases(rows, longest, least, best=best)


def test_shards_of_any_size_give_the_same_phrases(spark, phrase_docs, monkeypatch):
    rows = phrase_rows(5)
    whole = mined(phrases.mine_phrases(phrase_docs(rows).coalesce(1), least=4))
    cut = phrases.cut_shards
    monkeypatch.setattr(phrases, "cut_shards", lambda docs: cut(docs, words=20))
    assert mined(phrases.mine_phrases(phrase_docs(rows).coalesce(2), least=4)) == whole


def test_columns_of_clashing_names_and_no_rows(phrase_docs):
    columns = "text string, lang string, w0 string, n string, a int, shard int, phrase int"
    rows = [("a b " * 12, "en", "x", "y", 1, 2, 3)]
    found = mined(phrases.mine_phrases(phrase_docs(rows, columns)))
    assert found == plain_phrases([rows[0][:2]])
    assert mined(phrases.mine_phrases(phrase_docs([], columns))) == set()


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_007, 3_000_000_019, 3_000_000_021
    df = spark.createDataFrame([(a, [l, l], [r, r])], "a long, firsts array<long>, rests array<long>")
    cut = df.select(phrases.lowest_cut().alias("c")).first().c
    assert (cut.score, cut.k) == (1_000_000 * a * a // (l * r), 1)


def test_intervals_of_both_directions_agree():
    rng = np.random.default_rng(1)
    sequence = rng.integers(0, 5, 400)
    index = phrases.FmIndex(sequence, 4, 4)
    at = index.words()
    text = "".join(map(str, sequence))
    for left in (False, True, False):
        at = index.extend(at, left)
        size = at.phrases.shape[1]
        expected = Counter(text[i : i + size] for i in range(len(text) - size + 1) if "0" not in text[i : i + size])
        assert {"".join(map(str, p)): n for p, n in zip(at.phrases, at.count)} == dict(expected)


def test_phrase_query_agrees_with_sql(spark):
    con = duckdb_tables(SMALL)
    verdict, rows = compare(con, "op11_phrase_collocations", contract.queries()["op11_phrase_collocations"](spark, SMALL))
    assert verdict == "ok" and rows


# --- vector codes -------------------------------------------------------------------------


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """The contract in plain Python over (vec_id, vector, label): rows by (vec_id, q)."""
    kept = [
        (i, [math.floor(1024 * x) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[q[p * width : (p + 1) * width] for p in range(parts)] for _, q, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            for c in cut
        ]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            held = defaultdict(list)
            for c, f in zip(cut, found):
                held[f[p][1]].append(c[p])
            for k, own in held.items():
                books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        (i is None, i or 0, "".join(f"{k:02x}" for _, k in f), e, by_label[label], digest)
        for (i, _, label), f, e in zip(kept, found, errors)
    )


def coded(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def vector_rows(n, seed, grid=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.3, (n, 8)).astype(np.float32)
    if grid:  # many ties
        x = np.round(x * grid) / grid
    return [(i, [float(c) for c in v], None if i % 7 == 0 else i % 3) for i, v in enumerate(x)]


ODD = [
    (None, [0.5] * 8, 1),
    (3, [0.25] * 8, None),
    (3, [0.25] * 8, None),
    (4000, None, 1),
    (4001, [], 1),
    (4002, [0.0, None] * 4, 1),
    (4003, [0.0, float("nan")] * 4, 2),
    (4004, [float("inf")] * 8, 2),
    (4005, [0.0] * 8, 2),
    (-5, [-0.0001, 60000.0] * 4, 2),
]
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("n, grid, entries", [(700, None, 256), (500, 4, 32), (40, 2, 256)])
def test_codes_equal_plain_k_means(spark, n, grid, entries):
    rows = vector_rows(n, n, grid) + ODD
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert coded(ball_codes.vector_codes(df, entries=entries)) == plain_codes(rows, entries=entries)


def test_balls_find_the_nearest_entry_from_any_start():
    rng = np.random.default_rng(7)
    for spread in (3, 30, 1 << 20):
        x, entries = rng.integers(-spread, spread, (400, 4)), rng.integers(-spread, spread, (40, 4))
        entries[5] = entries[9]
        start = rng.integers(0, 40, 400)
        assert (ball_codes.Balls(entries).assign(x, start) == ball_codes.nearest(x, entries)).all()


def test_codes_of_no_vectors_and_of_other_lengths(spark):
    assert ball_codes.vector_codes(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(1, [0.5] * 8, 1), (2, [0.5] * 4, 1), (3, [0.25] * 8, 1)]
    clash = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS code", "2 AS q", "3 AS known", "4 AS error")
    assert sorted(r.vec_id for r in ball_codes.vector_codes(clash).collect()) == [1, 3]


def test_a_component_that_is_too_large_is_named(spark):
    df = spark.createDataFrame([(1, [1e30] * 8, 1)], VECTORS)
    with pytest.raises(Exception, match="beyond 2"):
        ball_codes.vector_codes(df).count()


# --- languages ----------------------------------------------------------------------------


def plain_model(texts, order):
    """Interpolated Kneser-Ney probabilities from plain counts; nothing is pruned."""
    grams = Counter()
    for text in texts:
        clean = re.sub(r"[^a-z]+", " ", text.lower() + " ").lstrip()
        padded = " " * (order - 1) + clean
        for i in range(len(clean)):
            grams[padded[i : i + order]] += 1
    levels, level = {}, grams
    for size in range(order, 0, -1):
        levels[size] = level
        shorter = Counter()
        for g in level:
            shorter[g[1:]] += 1
        level = shorter
    letters = len(levels[1]) + 1

    def p(gram):
        if not gram:
            return 1 / letters
        f = levels[len(gram)]
        n1, n2 = sum(c == 1 for c in f.values()), sum(c == 2 for c in f.values())
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        context = {g: c for g, c in f.items() if g[:-1] == gram[:-1]}
        if not context:
            return p(gram[1:])
        total = sum(context.values())
        return max(f.get(gram, 0) - d, 0) / total + d * len(context) / total * p(gram[1:])

    return p


def test_models_equal_plain_kneser_ney(spark, monkeypatch):
    texts = ["the cat sat on the mat", "a cat and a hat. The THE!", "", "mat tat"]
    monkeypatch.setattr(language_id, "MODEL_ENTRIES", 1 << 40)
    df = spark.createDataFrame([("en", t) for t in texts] + [("xx", "zzz zz")], "lang string, text string")
    scratch = language_id.Scratch(spark, "test")
    counts = scratch.keep("grams", language_id.count_grams(df, 3))
    models = language_id.collect_models(language_id.kneser_ney(counts, scratch, 2, 3), ["en", "xx"], 3)
    p = plain_model(texts, 3)
    read = language_id.read_grams([b"the hat ran at"], 3)
    bits = models.surprise(read.packed)[:, 0]
    clean = "  the hat ran at "
    # the alphabet is that of all languages
    plain = [p(clean[i : i + 3]) for i in range(len(clean) - 2)]
    own = len({c for t in texts for c in re.sub("[^a-z]+", " ", t.lower())})
    assert models.letters == own + 1 + 1  # z, and a place for others
    known = [i for i in range(len(clean) - 2) if all(c in "thecasonmdt " for c in clean[i : i + 3])]
    assert len(known) > 8
    assert np.allclose(2.0 ** -bits[known], np.array(plain)[known], rtol=0.02, atol=0.002)


@pytest.fixture(scope="module")
def predictions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs.select("doc_id", "lang").join(language_id.identify(docs), "doc_id").collect()


def test_held_out_texts_get_their_language(predictions):
    apart = [r for r in predictions if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in predictions)
    assert sum(r.lang == r.lang_pred for r in apart) >= 0.98 * len(apart)
    assert all(0 <= r.score <= 1 for r in predictions)
    assert sum(r.rejected for r in apart) <= 0.03 * len(apart)


def test_odd_texts(spark):
    base = [(i, t, lang, 1, "x") for i, (t, lang) in enumerate([("the cat sat on the mat " * 3, "en"), ("der hund und die katze " * 3, "de")] * 30)]
    odd = [
        (1000, None, "en"), (1001, "", "en"), (1002, "12 34 !?", "de"), (1003, "der hund", None), (None, "the cat", "en"),
        (1004, "the cat " * 40_000, None), (1005, "東京 🙂", None), (1005, "東京 🙂", None), (1006, "\u0000the\u0000cat", None),
    ]
    df = spark.createDataFrame([*base, *[(*r, 2, "y") for r in odd]], "doc_id long, text string, lang string, bits int, letters string")
    found = defaultdict(list)
    for r in language_id.identify(df).collect():
        found[r.doc_id].append(r)
    for i in (1000, 1001, 1002):
        assert (found[i][0].lang_pred, found[i][0].score, found[i][0].rejected) == ("und", 0.0, True)
    assert found[1003][0].lang_pred == "de" and found[1004][0].lang_pred == "en" and found[None][0].lang_pred == "en"
    assert found[1006][0].lang_pred == "en" and len(found[1005]) == 2 and found[1005][0] == found[1005][1]
    assert found[1005][0].lang_pred in ("de", "en")
    assert sum(map(len, found.values())) == len(base) + len(odd)


def test_languages_of_no_rows_or_without_labels(spark):
    columns = "doc_id long, text string, lang string"
    assert language_id.identify(spark.createDataFrame([], columns)).count() == 0
    r = language_id.identify(spark.createDataFrame([(1, "abc", None)], columns)).first()
    assert (r.lang_pred, r.score, r.held_out) == ("und", 0.0, zlib.crc32(b"1") % 5 == 0)


def test_models_hold_a_bounded_number_of_grams(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MODEL_ENTRIES", 64)
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b"]), "".join(rng.choice("abcdefgh ") for _ in range(200))) for _ in range(50)]
    scratch = language_id.Scratch(spark, "test")
    counts = scratch.keep("grams", language_id.count_grams(spark.createDataFrame(rows, "lang string, text string")))
    assert language_id.kneser_ney(counts, scratch, 2).filter("p IS NOT NULL").count() <= 64


def test_queries_without_sql_are_the_known_ones():
    llm = {n for n in contract.queries() if re.match(r"op\d+_", n)} | {"pipeline"}
    assert {n for n in llm if n in contract.oracle_sql()} == {"op9_source_mixing", "op11_phrase_collocations"}
    assert len(llm) == 14
