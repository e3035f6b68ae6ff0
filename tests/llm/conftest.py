import pyarrow.parquet as pq
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def given():
    """(doc_id, text) of the smallest documents."""
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(*(c.to_pylist() for c in table.columns), strict=True))


@pytest.fixture
def documents(spark):
    """Rows with the columns of ``documents`` and some whose names the operators use themselves."""
    clashing = ("document", "words", "votes", "n", "doc", "key", "_text", "lines", "quality", "component", "n_words")

    def build(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"{c} string" for c in clashing
        )
        full = [(i, t, None, "s", len(t or ""), *("x" for _ in clashing)) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return build


PASSAGE = " ".join(f"word{j}" for j in range(60))
EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b "),
    (4, "One"),
    (5, "one"),
    (6, PASSAGE),
    (7, "before " + PASSAGE + " after"),
    (7, "before " + PASSAGE + " after"),
    (8, "Is onhe. " * 3000),
    (9, "  Shared line of some length\nown one\n\n"),
    (10, "shared LINE of some length \n\nshared line of some length"),
    (11, "shared line of some length"),
    (12, "<|endoftext|> tab\tand  spaces\r\n<|endoftext|><|endoftext|> ünïcödé 日本語 ࢏\U00010940 🙂"),
    (13, PASSAGE.replace("word30 ", "")),
    (None, PASSAGE),
    (None, "shared line of some length"),
    (14, "Ä" * 40 + "\n" + "ä" * 40),
    (15, "word1 word2 " * 40),
]


@pytest.fixture
def edges():
    return EDGES
