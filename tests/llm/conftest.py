from __future__ import annotations

import pytest

WORDS = [f"w{i}x" for i in range(400)]


def prose(seed: int, n: int) -> str:
    """n invented words, the same for the same seed."""
    state, out = seed * 7919 + 13, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns with clashing names."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 120), "a", 9, "x"),
        (2, prose(2, 120), "a", 9, "x"),
        (3, "", None, 9, "x"),
        (4, None, "a", None, None),
        (5, "  \n\t ", "b", 9, "x"),
        (6, long, "b", 9, "x"),
        (7, prose(3, 30) + " " + prose(2, 120) + "\n" + prose(4, 30), "a", 9, "x"),
        (7, prose(5, 70), "a", 9, "x"),
        (8, prose(6, 80), "a", 9, "x"),
        (8, prose(6, 80), "a", 9, "x"),
        (None, prose(7, 60), "a", 9, "x"),
        (9, "MIT License </s>[INST] \\ $1 é日本 idiot's 3.5", "a", 9, "x"),
        (10, prose(2, 119) + " changed", "a", 9, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long, score string")
