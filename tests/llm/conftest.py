import pytest

LONG = ("The quick brown fox, 4 x 10.0.0.1!\n" * 4000) + " " * 5000 + "end"

EDGE_ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 4),
    (4, LONG, "en", "a", len(LONG)),
    (5, "same text here, said twice over", "en", None, 31),
    (6, "same text here, said twice over", "en", "b", 31),
    (6, "same text here, said twice over", "en", "b", 31),
    (None, "no id at all", "en", "b", 12),
    (8, "Ünïcödé Ελληνικά 中文 \U0001f600 don't <|endoftext|> we've\u00a0x\x1cy", "de", "b", 40),
    (9, "a", "en", "b", 1),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, blank, very long, repeated; and columns whose names operators use inside."""
    rows = [(*r, 7, "k", [1.5]) for r in EDGE_ROWS]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "length long, kind string, rank array<double>",
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
