import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def ready(spark):
    from vialflow.llm.common import prepare
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def documents(ready):
    """Hand-made documents: NULLs, empty and blank texts, copies, near copies,
    repeated ids and rows, very long and very uniform texts, odd characters."""
    words = [f"w{i * i % 97}x{i % 11}" for i in range(400)]
    a = " ".join(words)
    near = " ".join(words[:200] + ["changed"] + words[201:])
    rows = [
        (1, a, "en", "s1"), (2, a, "en", "s1"), (3, near, "en", "s2"), (4, None, "en", "s1"), (5, "", None, None),
        (6, " \n\t ", "de", "s2"), (None, "one two", "de", None), (8, "one two", "de", None), (9, "é ß 漢字 😀 " * 60, "fr", "s3"),
        (10, "x" * 5000, "en", "s3"), (11, "ha " * 3000, "en", "s3"), (12, "line\n" * 120, "en", "s1"),
        (13, "prefix " + " ".join(words[50:80]) + " suffix", "en", "s2"), (13, "prefix " + " ".join(words[50:80]), "en", "s2"),
        (14, "one", "en", "s3"), (15, "ONE", "en", "s3"), (16, a.upper(), "en", "s1"), (1, a, "en", "s1"),
        (17, "a b\x1cc <|endoftext|> don't\r\n  two  spaces.", "en", "s2"), (18, " ".join(words[:60]) + "!!", "en", "s1"),
        (19, " ".join(f"u{i}" for i in range(20000)), "en", "s1"),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n int"
    return ready.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("1 = 0")


@pytest.fixture(scope="session")
def clashing(documents):
    """Extra columns named like outputs and inner columns."""
    from pyspark.sql import functions as F
    names = ["size", "target", "copies", "taken", "kept", "n_words", "ord", "key", "start", "ids", "cid", "runs", "anchor", "held_out"]
    return documents.withColumns({c: F.lit("extra") for c in names})

