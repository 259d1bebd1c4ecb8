import pytest

ODD = [
    (1, "plain words here"), (2, None), (3, ""), (4, "  \t\n "), (None, "no id"), (1, "plain words here"),
    (5, "x" * 60_000), (6, "word " * 20_000), (7, "Ünïcode ſ 漢字 🎉 \x1c\x85 ­ é"),
]


@pytest.fixture()
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and columns with clashing names."""
    rows = [(i, t, "n", 1, "d", 2) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, uid string, n int, digest string, `a.b c` int")


@pytest.fixture()
def none(odd):
    return odd.limit(0)


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
