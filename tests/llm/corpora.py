"""Small made-up tables for the corpus operators."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def word(rng: random.Random) -> str:
    return "".join(rng.choice(["ba", "ri", "to", "len", "su", "mok", "fi", "dra"]) for _ in range(rng.randint(1, 4)))


def prose(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = word(rng) + "x"
    return " ".join(words)


def docs_frame(spark, texts, first=0):
    rows = [(first + i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_docs(spark):
    """Nulls in every column, empty and blank and very long texts, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    same = prose(rng, 40)
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, None, 4),
        (4, same, "en", "a", len(same)),
        (5, same, "en", "a", len(same)),
        (5, same, "en", "a", len(same)),
        (None, same, "en", "a", len(same)),
        (6, long, "en", "a", len(long)),
        (7, "x" * 100_000, "en", "a", 100_000),
        (8, "one", "en", "a", 3),
        (9, "12 34 !! ??", "en", "a", 11),
        (10, "mail jo.doe@host.example.com or 4111 1111 1111 1111", "en", "a", 51),
    ]
    extra = "score double, predicted int, id bigint, kept boolean, n_shingles bigint, text_hash bigint, later string, piece int, item string"
    return spark.createDataFrame([(*r, 0.5, 9, 7, False, 3, 4, "l", 2, "i") for r in rows], f"{DOCS}, {extra}")


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
