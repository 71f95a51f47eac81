from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def odd_texts() -> list[str | None]:
    """Null, empty, white, short, very long, repeated and mixed-script texts."""
    draw = random.Random(5)
    words = "alpha Beta gamma. delta, épée straße 東京 données 42 o'clock it's we'll x_y # | $".split()
    prose = [" ".join(draw.choices(words, k=draw.randint(1, 80))) for _ in range(30)]
    passage = " ".join(f"w{i}" for i in range(70))
    return [
        None, "", " \t\n\r\x0b\x0c ", "one", "one two", "a b c", "THE THE THE " * 60, passage, f"Lead {passage} tail", passage.replace("w30 ", "changed "),
        "x" * 30_000, "long words " * 20_000, "line one here\nline one here\n\nother\n", *prose, prose[0], prose[0], prose[1] + " " + prose[2] + " " + prose[1],
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The texts with ids, one null id, one repeated row, and extra columns named like results."""
    rows = [(i if i != 9 else None, t, f"kept{i % 3}", i) for i, t in enumerate(odd_texts)]
    return spark.createDataFrame([*rows, rows[13]], "doc_id long, text string, kept string, n_words long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
