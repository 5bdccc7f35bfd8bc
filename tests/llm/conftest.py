import pytest

WORDS = "the lake under a cold moon was still and no wind moved over it while boats lay along both shores".split()


def sentence(start, n):
    """Words of a fixed list, from a place on."""
    return " ".join(WORDS[(start * 7 + i * (start % 5 + 1)) % len(WORDS)] + str((start + i) % 9) for i in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with the odd cases: null, empty, blank, one word, long, repeated, other scripts, control strings."""
    long = " ".join(sentence(i, 40) + "." for i in range(120))
    return [
        None,
        "",
        " \n\t ",
        "word",
        sentence(1, 30) + ".",
        sentence(1, 30) + ".",
        sentence(2, 60) + ".\n" + sentence(3, 20) + ".",
        long,
        "déjà vu — 中文 текст 😀\u0000 ▁ <|endoftext|> <s>\r\nend",
        "  two  spaces \n and  tabs\t\there   ",
        "x" * 3000,
        "same " * 50,
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """One row a text, and columns whose names clash with those of results."""
    rows = [(i, t, "en", None if i % 4 == 3 else f"s{i % 3}", len(t or ""), -1, 0.5, True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, score double, kept boolean")
