import pytest

LONG = "the quick brown fox, jumps over the lazy dog\n" * 3000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, and extra columns of clashing names."""
    rows = [
        (1, "The cat and the dog are in the house with the man.", "en"),
        (1, "The cat and the dog are in the house with the man.", "en"),
        (2, "The cat and the dog are in the house with the man.", "en"),
        (3, None, "en"),
        (None, "Le chat et le chien sont dans la maison avec un homme.", "fr"),
        (None, None, None),
        (4, "", "fr"),
        (5, "   \n\t ", None),
        (6, LONG, "en"),
        (7, "1234 5678 !!", "de"),
        (8, "ÉTÉ 😀 naïve", "fr"),
        (9, "Le chat et le chien sont dans la maison avec un homme.", "fr"),
    ]
    names = "fp node root spans blob_id w lines base pairs ids n_tokens score x text_key pos h k source n_chars".split()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def items(spark):
    rows = [
        (10, "one two three four five six seven eight nine ten eleven twelve"),
        (2, "Lazy DOG"),
        (3, "the cat and the dog are in the house with"),
        (4, ""),
        (5, None),
        (None, "quick"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")
