import random

import pytest

SF = "/root/testdata/sf0.001"
WORDS = [a + b for a in ("ka", "lo", "mi", "tu", "re", "so") for b in ("n", "ra", "st", "vel", "po", "dim", "qu", "ex")]
#: Names that operators use inside themselves, and that callers' tables may hold too.
CLASHING = ("n", "row", "score", "name", "levels", "h", "sid", "kept", "spans", "length", "content", "_h", "block")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): null, empty and blank texts, repeated rows, copies, a null id, a very long text."""
    long = prose(5, 60_000)
    return [
        (1, prose(1, 60)), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, prose(1, 60)), (1, prose(1, 60)),
        (7, "one"), (8, "one two three"), (9, prose(1, 60).replace(" ", "  ")), (10, "x" * 200_000), (None, prose(2, 40)),
        (11, "Ünïcode ÀÉ <|endoftext|> 😀 words"), (12, long + " end"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    names = ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(i, t, *[f"{c}{k}" for c in CLASHING]) for k, (i, t) in enumerate(edge_rows)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {names}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def sf_docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
