import pytest

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, sig int, line_no int"


def _text(seed: int, words: int = 80) -> list[str]:
    return [f"w{(seed * 7919 + i * 104729) % 5003}" for i in range(words)]


@pytest.fixture
def documents(spark):
    """Documents with gaps, copies, near copies, ties and columns named like inner ones."""
    base = _text(1)
    near = base[:40] + ["changed"] + base[41:]
    texts = {
        1: " ".join(base),
        2: " ".join(near),
        3: " ".join(base),
        4: None,
        5: "",
        6: " \n\t\n ",
        7: "one two",
        8: "One Two",
        9: LONG,
        10: " ".join(_text(2)) + "\n" + " ".join(base),
        11: " ".join(_text(3)) + "   <|endoftext|> <|im_start|> É́ " + "x" * 500,
        12: "a b c a b c\na b c\n\n| # $ %",
    }
    rows = [(i, t, "en" if i % 2 else None, None, None, "w", 1, 2) for i, t in texts.items()]
    rows += [rows[0], (None, " ".join(_text(4)), None, None, 3, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
