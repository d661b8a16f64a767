from __future__ import annotations

import pytest

# ties, repeats, NULLs, empty and short texts, and a column that clashes with results
BASE = (
    "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak "
    "tree and wonder whether the morning will bring rain or sun to the quiet valley below them"
)


@pytest.fixture(scope="session")
def odd(spark):
    rows = [
        (1, BASE, "en", "a", 1),
        (2, BASE.upper(), "en", "a", 2),
        (3, BASE.replace("quiet", "silent"), "en", "b", 3),
        (4, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \t\n ", "de", None, 3),
        (7, "one two", "de", "b", 7),
        (8, "ONE  two", "de", "b", 8),
        (9, "Licensed under the Apache License, Version 2.0.\nmail bob@x.co or ann (at) y [dot] org", "en", "b", 9),
        (9, "Licensed under the Apache License, Version 2.0.\nmail bob@x.co or ann (at) y [dot] org", "en", "b", 9),
        (None, "a row without an id but with some more words", "en", "a", 5),
        (11, "Übergröße naïve café " * 3000, "fr", "c", 60000),
        (12, "don't we'll it's 3.5 a--b ... end", "en", "c", 4),
    ]
    schema = "doc_id long, text string, lang string, source string, kept long"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
