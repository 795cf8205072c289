import pytest

#: Null and empty texts, ties, repeated rows, null identifiers and sources, and columns whose
#: names the operators use themselves.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, `row` int, "
    "key string, size int, mark string, label int, nth int, `a.b` string"
)


def row(doc_id, text, source="s"):
    return (doc_id, text, "en", source, len(text or ""), "d", 1, "k", -1, "m", 7, 3, "dot")


LONG = " ".join(f"word{i % 977} and{i}" for i in range(20_000))
ROWS = [
    row(1, None), row(2, ""), row(3, " \n\t "), row(4, "One two THREE four five six"),
    row(5, "one two three four five six", None), row(6, "one two three four five siX", "t"),
    row(7, "É one"), row(8, "é one"), row(9, LONG), row(10, LONG + " more"), row(11, "solo"),
    row(12, "same row"), row(12, "same row"), row(13, "same id a", None), row(13, "same id b"),
    row(None, "no id"), row(None, "no id"), row(None, "same row"), row(14, "x" * 5000), row(15, "日本語 text"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
