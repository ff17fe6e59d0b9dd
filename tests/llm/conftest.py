import pytest

SAME = "The same plain words stand here in every copy of this short text, again and again."


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties and copies, and clashing names."""
    long_words = " ".join(f"word{i % 997} and" for i in range(20_000))
    rows = [
        (None, "A text whose id is missing, in plain words.", "en", "a", 1),
        (1, None, None, None, None),
        (2, "", "en", None, 0),
        (3, " \n\t ", "en", "a", 4),
        (4, SAME, "en", "a", 9),
        (4, SAME, "en", "a", 9),
        (5, SAME, "en", "b", 9),
        (6, long_words, "en", "a", 9),
        (7, "x" * 100_000, "en", "a", 9),
        (8, "12 34 -- !!", "en", "a", 9),
        (9, "one", "en", "a", 3),
        (10, "ONE", None, "a", 3),
        (11, "Über die Brücke führt der Weg nach Hause, été 你好 \U0001f600.", "de", "a", 3),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clashing = ["key", "rep", "n", "label", "statistics", "bits", "hub", "part", "segment", "piece", "length", "_words", "_bucket", "slot", "_id"]
    frame = spark.createDataFrame(rows, schema)
    for name in clashing:
        frame = frame.selectExpr("*", f"cast(null as string) AS `{name}`")
    return frame.cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
