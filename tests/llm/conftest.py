import pytest


@pytest.fixture(scope="session")
def texts():
    """Texts that every operator must take: null, empty, spaces, ties, repeats, very long, not ASCII."""
    long = " ".join(f"word{i % 997}" for i in range(40_000))
    return [None, "", "  \n\t", "One two three.", "One two three.", "ÉTÉ ça Straße ПРИВЕТ 世界", "a", long, "x" * 50_000, "password=abcdef1 and mail me@x.org +1 (988) 555-2485", "\x1cA\x1d<|endoftext|> b\x00"]


@pytest.fixture(scope="session")
def documents(spark, texts):
    """Those texts with a repeated row, a null id and columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", len(t or ""), "k", 1) for i, t in enumerate(texts)] + [(3, "One two three.", "en", None, 14, None, 2), (None, "One two three.", None, "s", None, "k", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, word string, digest long")
