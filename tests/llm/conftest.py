import pytest


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, an empty and a long text, ties, repeated rows and columns of clashing names."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
    rows = [
        (0, None, "en"),
        (1, "", "en"),
        (2, "one two three four five six seven", None),
        (2, "one two three four five six seven", None),
        (3, "ONE two three FOUR five six seven", "en"),
        (4, " \t\n ", "en"),
        (5, long, "en"),
        (6, "ünï çödé ▁ \U0001f600 \x00 end", "fr"),
        (7, "no", "fr"),
        (8, "x" * 30_000, None),
        (None, "no id here but some words to read", "en"),
        (9, "12 34 56", "de"),
        (10, "a  b \n\n c\td ", "de"),
    ]
    clash = [(*r, "a", "b", "c", 1, 2, 3.0) for r in rows]
    schema = "doc_id long, text string, lang string, row string, _text string, lang_pred string, n long, cls long, score double"
    return spark.createDataFrame(clash, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
