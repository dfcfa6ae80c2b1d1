import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, bits int, row int"
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, repeated rows, and columns with names the operators use."""
    prose = "the cat sat on the mat and looked at the moon over the quiet harbour of the town. "
    long_line = "Every reader has seen this very same line before"
    rows = [
        (1, None, None, None),
        (2, "", "en", None),
        (3, " \t\r\n\x0b ", None, "a"),
        (4, prose * 400, "en", "a"),
        (5, f"{long_line}\nown words of five", "en", "a"),
        (6, f"{long_line}\n  {long_line.upper()}  \nown words of six", "en", None),
        (7, f"{long_line}\nown words of seven", "en", "b"),
        (7, f"{long_line}\nown words of seven", "en", "b"),
        (None, f"{long_line}\nno id", None, "b"),
        (8, "le chat noir est assis sur la chaise près de la fenêtre", "fr", "b"),
        (9, "12345 678 !!! ---", "fr", "b"),
        (10, "Ünïcode ÀÉ KK \U0001f600 words\x00here", "fr", "b"),
        (11, "x" * 50_000, "en", "c"),
    ]
    return spark.createDataFrame([(a, b, c, d, None, 1, 2) for a, b, c, d in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture
def as_table(tmp_path):
    """Write a frame as the documents of a folder of tables."""

    def write(df, **others):
        for name, table in {"documents": df, **others}.items():
            table.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
