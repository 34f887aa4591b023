import random

import pytest


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, score double, node long, words string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "er", "th", "on", "re", "st", "in", "é"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def row(number, text):
    """A document with columns whose names the operators might use inside."""
    return (number, text, "en", "src", len(text or ""), 7, 0.5, 3, "x")


@pytest.fixture(scope="session")
def messy():
    """Nulls, empty and long texts, repeated rows and texts, near copies, shared passages, odd white space."""
    base, passage = prose(1, 300), prose(2, 60)
    words = base.split(" ")
    near = " ".join(words[:150] + ["changed"] + words[151:])
    nearer = " ".join(words[:40] + ["other"] + words[41:150] + ["changed"] + words[151:])
    rows = [
        row(1, base), row(2, base), row(2, base), row(3, near), row(4, nearer), row(5, None), row(6, ""), row(7, "  \n\t "),
        row(8, "one"), row(9, "One"), row(10, "one two three"), row(None, prose(3, 50)), row(None, None),
        row(11, prose(4, 80) + " " + passage + " " + prose(5, 80)), row(12, prose(6, 30) + " " + passage + "\n" + prose(7, 200)),
        row(13, prose(8, 40_000)), row(14, "ab" * 2_000), row(15, "A B  c\x1cd e <|endoftext|> 12,5 don't\n\nx "),
        row(16, "line\nline\nline\nReleased under the MIT License.\n#$%"), row(17, prose(9, 25)),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, messy):
    return spark.createDataFrame(messy, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
