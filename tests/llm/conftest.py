import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with awkward names."""
    long_text = " ".join(f"word{i % 977} the and" for i in range(9000))
    passage = "\n".join(["one fine line of text here", "and a second one follows", "then a third ends it"])
    rows = [
        (1, passage, "en", "a", 70),
        (2, "start of it\n" + passage + "\nend of it", "en", "a", 90),
        (2, "another text under one number", "en", None, None),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, "   \n\n\n\n ", None, "b", 7),
        (6, long_text, "en", "b", len(long_text)),
        (7, passage, "en", "a", 70),
        (7, passage, "en", "a", 70),
        (None, "a text without a number", "en", "a", 20),
        (None, None, None, None, None),
        (8, "12 345 !!! ###", "de", "c", 14),
        (9, "a", "fr", "c", 1),
        (10, "Zeilen\r\nmit <|endoftext|> und  zwei  Blanks\t é 北京 \U0001f600", "de", "c", 40),
    ]
    rows = [(*r, "x", 1, k) for k, r in enumerate(rows)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, part int, `n_lines` int"
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
