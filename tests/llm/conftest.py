import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = SCHEMA + ", size long, grp string, key long, node long, component string, kept int, label string, score string, m int, print int, h int"


def prose(seed, n, words=None):
    draw = random.Random(seed)
    words = words or [a + b for a in ("ba", "co", "di", "fu", "ga", "he", "jo", "ki") for b in ("n", "ra", "st", "lo", "me", "p")]
    return " ".join(draw.choice(words) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and odd texts, a very long text, ties and repeated rows."""
    long_text = "\n".join(prose(i, 400) for i in range(150))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "b", 4), (4, "one", "de", "b", 3), (5, prose(5, 80), "en", None, 9),
        (None, prose(6, 60), None, None, None), (7, long_text, "en", "a", len(long_text)), (8, prose(5, 80), "de", "c", 9),
        (9, prose(9, 70), "en", "c", 9), (9, prose(9, 70), "en", "c", 9), (10, "日本語 テキスト です。 ещё текст ✓", "ja", "d", 5),
        (11, "…" * 200, None, "d", 200), (12, "### *** | <> &&& %%% " * 30, "en", "a", 1), (13, "\x00 \x1f   x", "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    return spark.createDataFrame([r + (1, "g", 2, 3, "c", 4, "l", "s", 5, 6, 7) for r in edge_rows()], CLASHING)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
