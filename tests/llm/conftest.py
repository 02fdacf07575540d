import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, __size string"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text[, source]) with extra columns whose names operators use themselves."""

    def build(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", "y", "z")
            for r in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def odd_docs(make_docs):
    """NULLs, empty and long texts, ties and repeated rows."""
    long_text = " ".join(f"w{i % 700}x{i}" for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"),
        (2, None, None),
        (3, "", "t"),
        (4, " \n\t ", None),
        (5, long_text, "t"),
        (6, long_text, "t"),
        (None, "a text without an id", None),
        (7, "one two", "u"),
        (8, "One TWO", "u"),
        (9, "naïve façade — 東京 🙂 \u00a0x", "u"),
    ]
    return make_docs(rows)


def rows_by_id(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


@pytest.fixture
def by_id():
    return rows_by_id
