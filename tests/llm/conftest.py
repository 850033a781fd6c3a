import pytest

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(f"long{i % 5000}" for i in range(30_000))
PROSE = " ".join(WORDS[:120])


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empties, ties, repeats, near copies, a very long text."""
    near = PROSE.replace("w50 ", "changed ")
    return [
        (1, PROSE), (2, near), (3, PROSE), (3, PROSE), (4, None), (5, ""), (6, " \t\n "), (7, "a b"),
        (8, "A B"), (9, LONG), (10, "x " * 80), (11, "line one here\n" * 30), (12, " ".join(WORDS[200:])),
        (13, "mail a@b.co.uk, +1 (743) 555-3824, 4111 1111 1111 1111, 10.0.0.256 and 10.0.0.7"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(i, t, "en", "s", len(t or ""), "kept?", -1) for i, t in odd_rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, score int"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
