import pytest

IDS = [None, 1, 1, 2, 3, 4, 5, 5]
TEXTS = ["lone words here", "same line\nsame line", "same line\nsame line", None, "", " \n\t", "x " * 3000, "y" * 3000]


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, repeated ids with other
    texts, and extra columns whose names the operators use themselves."""
    rows = [(i, t, None, "s", 1, "clash", "clash", "clash") for i, t in zip(IDS, TEXTS, strict=True)]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, k string, score string, size string"
    return spark.createDataFrame(rows, ddl)


@pytest.fixture
def none(odd):
    return odd.where("false")
