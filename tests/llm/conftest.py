import random

import pytest

#: Columns beyond those of documents, named like the operators' own.
CLASHING = ["row", "id", "body", "kept", "score", "rate", "_n", "_p", "component", "first", "held_out"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def frame(spark, rows):
    """(doc_id, text[, lang]) rows as a documents table with clashing columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None, *CLASHING) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(vocabulary)]
    return [r.choice(names) for _ in range(n)]


ODD = [(None, "the same text here for all"), (7, None), (8, ""), (9, " \t\n "), (10, "one"), (11, "one"), (11, "one"),
       (12, "ONE  \n two"), (13, "one two"), (None, None), (14, "the same text here for all"), (15, "é ü — 漢字 \u00a0x"),
       (16, " ".join(prose(1, 30_000))), (17, "a" * 50_000)]


@pytest.fixture()
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture()
def empty(spark):
    return frame(spark, [])
