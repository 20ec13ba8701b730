import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns named as results are."""
    long = " ".join(f"word{i * i % 7919}" for i in range(30_000))
    shared = " ".join(f"passage{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "  \n "), (None, "alone here"), (4, long), (4, long), (5, f"before {shared} after it")]
    rows += [(6, f"other {shared}"), (7, "It's  ünïcode <|endoftext|> 日本語"), (8, f"{shared} {shared}"), (9, None), (10, "one")]
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), "x", 0, 1) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, found string, shard int, key int",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
